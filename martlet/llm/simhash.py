"""Near-duplicate documents by SimHash fingerprints and pigeonhole blocks.

A fingerprint has 64 bits; a bit is 1 if over half of the shingles' XXH64 values have it set.
Fingerprints are linked if at most ``max_bits`` differ, and groups are the components of links.

Two linked fingerprints that are cut into k blocks agree in at least k - max_bits of them. So
every choice of that many blocks is a key, and linked fingerprints meet under one of the keys;
a join on it proposes pairs and the Hamming distance verifies them. Distinct fingerprints take
part once, whatever number of documents has them.

A key that many fingerprints share (a large group of near copies) would propose all pairs. Its
bits that are still free are cut again, until few enough are left to bound a bucket by the
number of their values. Such a bucket is searched by one task, which returns a spanning forest
of its links: the components are the same, and there are fewer links than fingerprints.

Defined results: words are runs of bytes other than blanks and controls 9-13, A-Z in lower case.
Fewer words than a shingle has make one shingle; a null text and one without words have
fingerprint zero, which is linked like any other. Texts are read whole, in chunks. Repeated rows
each get a row. A null ``doc_id`` is never the smallest of a component unless all are null; an
empty table gives no rows. Other columns take no part.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import fresh, own_columns
from martlet.llm.components import connected_components
from martlet.session import materialise

BITS = 64
SEED = 42
CROWD = 64
_CHUNK = 1 << 16


def fingerprint(data: bytes | None, shingle: int = 3) -> int:
    """The fingerprint of a UTF-8 text as a signed 64-bit number."""
    words = (data or b"").lower().split()
    if not words:
        return 0
    shingle = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    total = len(words) - shingle + 1
    spans = list(zip(starts[:total].tolist(), ends[shingle - 1 :].tolist(), strict=True))
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for at in range(0, total, _CHUNK):
        hashes = [digest(joined[a:b], SEED) for a, b in spans[at : at + _CHUNK]]
        octets = np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total).view(">i8")[0])


def fingerprints(text: Column, shingle: int = 3) -> Column:
    """Fingerprints of a text column."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([fingerprint(data, shingle) for data in batch], dtype="int64")

    return of.asNondeterministic()(text.cast("binary"))


def block_masks(free: int, blocks: int, max_bits: int) -> list[int]:
    """Masks of every choice of ``blocks - max_bits`` blocks of the free bits, as signed numbers."""
    places = [i for i in range(BITS) if free >> i & 1]
    cuts = np.array_split(np.array(places), blocks)
    parts = [sum(1 << int(i) for i in cut) for cut in cuts]
    chosen = [sum(some) for some in combinations(parts, blocks - max_bits)]
    return [_signed(mask) for mask in chosen]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> BITS - 1 else value


def _keys(masks: list[int]) -> Column:
    """One row for each mask: its number and the fingerprint's bits under it."""
    return F.explode(
        F.array(
            *[
                F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("part"))
                for i, m in enumerate(masks)
            ]
        )
    )


def _near(a: str, b: str, max_bits: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= max_bits


def near_links(prints: DataFrame, max_bits: int = 3, crowd: int = CROWD) -> DataFrame:
    """Links ``a, b`` with the components of all links between the distinct ``fp``."""
    blocks = 2 * max_bits
    masks = block_masks((1 << BITS) - 1, blocks, max_bits) if max_bits else [-1]
    keyed = prints.select("fp", _keys(masks).alias("key")).select("fp", "key.mask", "key.part")
    sizes = keyed.groupBy("mask", "part").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = materialise(keyed.join(sizes, ["mask", "part"]))
    few = shared.where(F.col("size") <= crowd)
    pairs = (
        few.select("mask", "part", F.col("fp").alias("a"))
        .join(few.select("mask", "part", F.col("fp").alias("b")), ["mask", "part"])
        .where((F.col("a") < F.col("b")) & _near("a", "b", max_bits))
        .select("a", "b")
    )
    return pairs.union(_crowded(shared.where(F.col("size") > crowd), masks, max_bits)).distinct()


def _crowded(crowds: DataFrame, masks: list[int], max_bits: int) -> DataFrame:
    """Links within keys that many fingerprints share, by cutting the bits still free again."""
    full = (1 << BITS) - 1
    finer = [block_masks(~mask & full, max_bits + 5, max_bits) if ~mask & full else [] for mask in masks]
    # One literal: spelled out as expressions, the masks made a plan of 100,000 nodes.
    table = F.from_json(F.lit(json.dumps(finer)), "array<array<bigint>>")
    own = F.element_at(table, F.col("mask") + 1)
    met = crowds.select("mask", "part", "fp", F.posexplode(own).alias("mask2", "bits"))
    again = met.withColumn("part2", F.col("fp").bitwiseAND(F.col("bits")))
    # A bucket holds distinct values of the 12 or 13 bits that are left: 8,192 at most.
    buckets = (
        again.groupBy("mask", "part", "mask2", "part2")
        .agg(F.collect_list("fp").alias("fps"))
        .where(F.size("fps") > 1)
    )

    @F.pandas_udf("array<struct<a: bigint, b: bigint>>")
    def forest(groups: pd.Series) -> pd.Series:
        return pd.Series([_forest(np.asarray(fps), max_bits) for fps in groups], dtype=object)

    links = buckets.select(F.explode(forest("fps")).alias("link"))
    return links.select("link.a", "link.b")


def _forest(fps: np.ndarray, max_bits: int) -> list[dict]:
    """A spanning forest of the links between distinct fingerprints."""
    rest, links = np.sort(fps), []
    while len(rest):
        reached, rest = [rest[0]], rest[1:]
        while reached and len(rest):
            at = reached.pop()
            near = np.bitwise_count((rest ^ at).view(np.uint64)) <= max_bits
            for other in rest[near]:
                links.append({"a": int(min(at, other)), "b": int(max(at, other))})
            reached.extend(rest[near])
            rest = rest[~near]
    return links


def _grouped(prints: DataFrame, max_bits: int) -> DataFrame:
    """``fp, label`` of every distinct fingerprint of more than one-member components."""
    return connected_components(near_links(prints.select("fp").distinct(), max_bits))


def near_duplicates(
    docs: DataFrame,
    *,
    shingle: int = 3,
    max_bits: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every document."""
    prints = materialise(
        docs.select(F.col(id_col).alias("id"), fingerprints(F.col(text_col), shingle).alias("fp"))
    )
    first = prints.groupBy("fp").agg(F.min("id").alias("first"))
    labels = _grouped(prints, max_bits).withColumnRenamed("node", "fp")
    known = first.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    smallest = known.groupBy("label").agg(F.min("first").alias("component_id"))
    of_print = known.select("fp", "label").join(smallest, "label").drop("label")
    return prints.join(of_print, "fp").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def drop_near_duplicates(
    docs: DataFrame,
    *,
    shingle: int = 3,
    max_bits: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The row with the smallest id of each component, with all its columns."""
    text_hash = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    prints = materialise(
        docs.select(
            F.col(id_col).alias("id"),
            text_hash.alias("text_hash"),
            fingerprints(F.col(text_col), shingle).alias("fp"),
        )
    )
    # A null id comes last; the hash tells apart rows that repeat an id.
    rank = F.struct(F.col("id").isNull().alias("without"), "id", "text_hash")
    first = prints.groupBy("fp").agg(F.min(rank).alias("first"))
    labels = _grouped(prints, max_bits).withColumnRenamed("node", "fp")
    known = first.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    stay = known.groupBy("label").agg(F.min("first").alias("stay"))
    own, stay_id, stay_hash = fresh(docs, "_own_hash", "_stay_id", "_stay_hash")
    stay = stay.select(F.col("stay.id").alias(stay_id), F.col("stay.text_hash").alias(stay_hash))
    same = F.col(id_col).eqNullSafe(F.col(stay_id)) & (F.col(own) == F.col(stay_hash))
    kept = docs.withColumn(own, text_hash).join(stay, same, "left_semi")
    return kept.dropDuplicates([id_col, own]).select(*own_columns(docs))
