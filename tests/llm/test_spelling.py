from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from martlet.llm import spelling
from martlet.llm.common import UPPER

LOWER = str.maketrans(UPPER, UPPER.lower())


def counted(rows, slips=None):
    """n by word: all runs, each possibly with a slip."""
    n = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            code = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if slips and code % slips == 0:
                at = code % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += 1
    return n


def near_of(words):
    """Near words by word, by leaving out each character."""
    gaps, near = {}, {w: set() for w in words}
    for w in words:
        for i in range(len(w)):
            gaps.setdefault((w[:i], w[i + 1 :]), set()).add(w)
    for w in words:
        for i in range(len(w)):
            near[w] |= gaps[w[:i], w[i + 1 :]] - {w}
            if (short := w[:i] + w[i + 1 :]) in near:
                near[w].add(short)
                near[short].add(w)
    return near


def expected(rows, slips=None, length=6, least=5, ratio=5):
    n = {w: c for w, c in counted(rows, slips).items() if len(w) >= length and c >= least}
    near = near_of(n)
    best = {w: min(near[w], key=lambda x: (-n[x], x), default=None) for w in n}
    form = {w: b if b and n[b] >= ratio * n[w] else None for w, b in best.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], len(near[w]), form[w] and n[form[w]]) for w in n}


def got(docs, **options):
    return [tuple(r) for r in spelling.spelling_groups(docs, **options).collect()]


def test_given_documents(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    found = got(documents, slips=199)
    assert set(found) == expected(rows, slips=199) and len(found) == len(set(found))


def test_slips_are_found_again(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.limit(300).collect()]
    some = documents.limit(300)
    assert set(got(some, slips=3, least_count=1)) == expected(rows, slips=3, least=1)


def test_chains_ties_and_edges(texts):
    def many(word, n):
        return [(i, word) for i in range(n)]

    chain = ["abcdef", "abcdeg", "abcdhg", "abcihg", "kbcihg"]
    rows = [(1, None), (2, ""), (3, " ,.12 "), (None, "without id " * 5), (7, "short")]
    for step, word in enumerate(chain):
        rows += many(word, 2 * 3**step)
    rows += many("tiemea", 1) + many("tiemeb", 4) + many("tiemec", 4)  # ties: the first in order
    rows += many("ÀÉÎõüx ÀÉÎõü×x ÀÉÎõüx" * 2, 3) + [(9, "Z" * 5_000), (9, "Z" * 5_001)]
    docs = texts(*rows).withColumn("word", F.lit("mine")).withColumn("n", F.lit("mine"))
    options = {"least_count": 1, "ratio": 3}
    found = got(docs, **options)
    assert set(found) == expected(rows, least=1, ratio=3) and len(found) == len(set(found))
    roots = {r[0]: r[2] for r in found}
    assert roots["abcdef"] == "kbcihg" and roots["tiemea"] == "tiemeb"
    assert got(texts()) == []


@pytest.mark.parametrize("crowd", [1, 3, 1000])
def test_crowded_keys_lose_no_pair(frame, crowd):
    rng = random.Random(5)
    words = {"same" + "".join(rng.choice("ab") for _ in range(rng.randrange(2, 6))) for _ in range(90)}
    words |= {w[::-1] for w in words}
    table = frame("word string, n long", *[(w, i) for i, w in enumerate(sorted(words))])
    pairs = spelling.near_words(table, least_length=6, group_rows=40, crowd=crowd).collect()
    near = near_of(words)
    assert {(r["word"], r["near"]) for r in pairs} == {(w, x) for w in words for x in near[w]}
    assert len(pairs) == sum(map(len, near.values()))


def test_short_words_need_a_half(texts):
    with pytest.raises(ValueError):
        spelling.spelling_groups(texts(), least_length=1)
    rows = [(1, "ab ac abc abcd a")]
    assert set(got(texts(*rows), least_length=2, least_count=1)) == expected(rows, length=2, least=1)
