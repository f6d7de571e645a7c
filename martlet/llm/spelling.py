"""Spelling variants: words that differ by one character from a much more frequent one.

Words are counted over all texts in Spark. Near words come from bidirectional FM-indexes
(``fmindex``) over parts of the vocabulary, searched with both search schemes. A word of length L
and one that is one edit away share the first or the last ``least(L, L') // 2`` characters, so
the vocabulary is dealt by (side, length, that many characters): each word is indexed once per
side, and looked up once per side and length in reach. Keys are dealt to groups of a bounded
number of rows; a key with more words than a group holds is cut into pieces of words and pieces of
queries, each of which meets each, so no pair is lost and no group outgrows a task.

A word's form is its near word of largest count, if that is ``ratio`` times its own or more; forms
are followed to the last by joins that double the distance each round, so the rounds grow with
the logarithm of the longest chain.

Defined results: a null text has no words; a null id is the empty string in what is hashed. Repeated
rows count one by one. Of near words with equal counts the first in code-point order is the form.
Words of any length are searched whole. An empty table gives no rows, other columns take no part.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import lower_ascii
from martlet.llm.fmindex import DELETE, INSERT, REPLACE, BidirectionalIndex
from martlet.session import materialise, scratch

LETTERS = "a-zÀ-ÿ"
GROUP_ROWS = 40_000
CROWD = 10_000


def slipped(run: Column, key: Column, one_in: int = 199) -> Column:
    """The run, or at one of ``one_in`` hashes of (key, run) the run without one character.

    Stands for typing slips in texts that have none: the place is the hash modulo the length.
    """
    code = F.crc32(F.concat_ws(":", F.coalesce(key.cast("string"), F.lit("")), run))
    at = F.pmod(code, F.char_length(run)).cast("int")
    without = F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))
    return F.when(code % one_in == 0, without).otherwise(run)


def count_words(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_length: int = 6,
    least_count: int = 5,
    slips: int | None = None,
) -> DataFrame:
    """``word, n`` of all words of the texts that are long and frequent enough."""
    runs = F.regexp_extract_all(lower_ascii(F.col(text_col)), F.lit(f"[{LETTERS}]+"), F.lit(0))
    each = docs.select(F.col(id_col).alias("id"), F.explode(runs).alias("word"))
    each = each.where(F.char_length("word") >= least_length)  # a slip only makes a run shorter
    if slips:
        each = each.select(slipped(F.col("word"), F.col("id"), slips).alias("word"))
        each = each.where(F.char_length("word") >= least_length)
    counts = each.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= least_count)


def _keys(length: Column, least_length: int) -> list[Column]:
    """Both ends that the word shares with a near word of ``length``: (side, long, end).

    The shorter of two near words has half its length before its middle, and more behind it.
    """
    half = F.floor(F.greatest(length - 1, F.lit(least_length)) / 2).cast("int")
    ends = F.substr("word", F.lit(1), half), F.substr("word", -half, half)
    names = F.lit(0), F.lit(1)
    return [
        F.struct(side.alias("side"), length.alias("long"), end.alias("end"))
        for side, end in zip(names, ends, strict=True)
    ]


def _lookups(words: DataFrame, least_length: int) -> DataFrame:
    """``word, n, indexed, edits, key``: where a word is held, and what is looked up there.

    Words are held with those of their own length, and look up replacements there; insertions
    they look up among the words longer by one. Deletions are insertions seen from the other word.
    """
    length = F.char_length("word")
    rows = [
        F.struct(F.lit(indexed).alias("indexed"), F.lit(edits).alias("edits"), key.alias("key"))
        for indexed, edits, long in ((True, REPLACE, length), (False, INSERT, length + 1))
        for key in _keys(long, least_length)
    ]
    return words.select("word", "n", F.explode(F.array(*rows)).alias("_row")).select(
        "word", "n", "_row.*"
    )


def _dealt(lookups: DataFrame, groups: int, crowd: int) -> DataFrame:
    """``group, word, n, indexed, edits`` (0: no query); crowded keys are cut into pieces."""
    crowded = (
        lookups.groupBy("key")
        .agg(
            F.ceil(F.count_if("indexed") / crowd).cast("int").alias("word_pieces"),
            F.ceil(F.count(F.lit(1)) / crowd).cast("int").alias("query_pieces"),
        )
        .where("word_pieces > 1 OR query_pieces > 4")
    )
    turn = F.xxhash64(F.lit(7), "word")
    word_piece = F.pmod(turn, F.col("word_pieces")).cast("int")
    query_piece = F.pmod(turn, F.col("query_pieces")).cast("int")

    def place(word_piece, query_piece, indexed, edits):
        return F.struct(
            word_piece.alias("word_piece"),
            query_piece.alias("query_piece"),
            indexed.alias("indexed"),
            edits.alias("edits"),
        )

    no, none = F.lit(False), F.lit(0)
    whole = F.array(place(none, none, F.col("indexed"), F.col("edits")))
    held = F.transform(
        F.sequence(none, F.col("query_pieces") - 1), lambda i: place(word_piece, i, ~no, none)
    )
    asked = F.transform(
        F.sequence(none, F.col("word_pieces") - 1), lambda i: place(i, query_piece, no, F.col("edits"))
    )
    # A key without words has nothing to find.
    cut = F.when(F.col("word_pieces") == 0, F.filter(whole, lambda _: no)).otherwise(
        F.when(F.col("indexed"), F.concat(held, asked)).otherwise(asked)
    )
    places = F.when(F.col("word_pieces").isNull(), whole).otherwise(cut)
    dealt = lookups.join(crowded, "key", "left").select(
        "word", "n", "key", F.explode(places).alias("_place")
    )
    group = F.pmod(F.xxhash64("key", "_place.word_piece", "_place.query_piece"), F.lit(groups))
    return dealt.select(
        group.alias("group"), "word", "n", "_place.indexed", "_place.edits"
    )


def _search(rows: pd.DataFrame) -> pd.DataFrame:
    """``word, near, near_n`` of the near words within one group, in both directions."""
    held = rows.loc[rows["indexed"], ["word", "n"]].drop_duplicates("word")
    held = dict(sorted(zip(held["word"], held["n"], strict=True)))
    asked = rows.loc[rows["edits"] > 0].drop_duplicates(["word", "edits"])
    words, counts = np.array(list(held), object), np.array(list(held.values()), np.int64)
    queries, own = asked["word"].to_numpy(object), asked["n"].to_numpy(np.int64)
    parts = [pd.DataFrame({"word": [], "near": [], "near_n": []})]
    index = BidirectionalIndex(list(words))
    for query, found in index.near(list(queries), asked["edits"].to_numpy(np.int64)):
        parts.append(
            pd.DataFrame({"word": queries[query], "near": words[found], "near_n": counts[found]})
        )
        grown = asked["edits"].to_numpy()[query] == INSERT
        query, found = query[grown], found[grown]
        parts.append(
            pd.DataFrame({"word": words[found], "near": queries[query], "near_n": own[query]})
        )
    return pd.concat(parts, ignore_index=True).astype({"near_n": np.int64})


def near_words(
    words: DataFrame, *, least_length: int = 2, group_rows: int = GROUP_ROWS, crowd: int = CROWD
) -> DataFrame:
    """``word, near, near_n`` for all pairs of words at edit distance one, in both directions.

    ``words`` holds distinct ``word, n`` of at least ``least_length`` characters, two or more, and
    is read several times. Words of the length ``least_length`` need no shorter ones.
    """
    groups = max(1, math.ceil(4 * words.count() / group_rows))
    dealt = _dealt(_lookups(words, least_length), groups, crowd)
    pairs = dealt.groupBy("group").applyInPandas(_search, "word string, near string, near_n long")
    # The two sides find some pairs twice.
    return pairs.groupBy("word", "near").agg(F.max("near_n").alias("near_n"))


def last_forms(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form`` without cycles: forms followed to the last."""
    with scratch(forms.sparkSession) as held:
        held.append(materialise(forms.select("word", F.col("form").alias("root"))))
        while True:
            known = held[-1].select(F.col("word").alias("root"), F.col("root").alias("further"))
            step = held[-1].join(known, "root", "left").select(
                "word",
                F.coalesce("further", "root").alias("root"),
                F.col("further").isNotNull().alias("moved"),
            )
            held.append(materialise(step))
            if held[-1].where("moved").isEmpty():
                return materialise(held[-1].select("word", "root"))


def spelling_groups(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_length: int = 6,
    least_count: int = 5,
    ratio: int = 5,
    slips: int | None = None,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the texts."""
    if least_length < 2:
        raise ValueError("words of one character have no half to match")
    with scratch(docs.sparkSession) as held:
        counted = count_words(
            docs,
            id_col=id_col,
            text_col=text_col,
            least_length=least_length,
            least_count=least_count,
            slips=slips,
        )
        held.append(words := materialise(counted))
        best = F.min(F.struct(-F.col("near_n"), F.col("near")))
        near = near_words(words, least_length=least_length).groupBy("word").agg(
            F.count(F.lit(1)).alias("n_near"), best.alias("best")
        )
        most, own = -F.col("best.col1"), F.col("n")
        strong = most >= ratio * own
        found = words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(strong, F.col("best.near")).alias("form"),
            F.when(strong, most).alias("form_n"),
        )
        held.append(found := materialise(found))
        held.append(roots := last_forms(found.where("form IS NOT NULL").select("word", "form")))
        root = F.coalesce("root", "word").alias("root")
        whole = found.join(roots, "word", "left")
        return materialise(whole.select("word", "form", root, "n", "n_near", "form_n"))
