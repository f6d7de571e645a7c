from __future__ import annotations

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from martlet.llm import simhash
from martlet.llm.components import connected_components


def brute_print(text, shingle=3):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    n = min(shingle, len(words))
    hashes = [
        xxhash.xxh64_intdigest(" ".join(words[i : i + n]).encode(), 42)
        for i in range(len(words) - n + 1)
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(items, prints, bits=3):
    parent = {i: i for i in items}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, i in enumerate(items):
        for j in items[:k]:
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in items}


def near_copies(documents):
    """Some of the given documents and, for a few, many copies with one word more."""
    some = documents.where("doc_id < 150").select("doc_id", "text")
    number = F.explode(F.sequence(F.lit(0), F.lit(5)))
    copies = some.where("doc_id % 20 = 3").withColumn("n", number).select(
        (F.col("doc_id") * 100 + F.col("n") + 100_000).alias("doc_id"),
        F.concat("text", F.lit(" tail"), F.col("n").cast("string")).alias("text"),
    )
    return some.union(copies)


def components_of(spark, prints, bits=3, crowd=simhash.CROWD):
    """The smallest position of each distinct fingerprint's component, in the given order."""
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    links = simhash.near_links(frame, bits, crowd=crowd).collect()
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        i, j = sorted((root(signed.index(a)), root(signed.index(b))))
        parent[j] = i
    return {i: root(i) for i in range(len(prints))}


def test_equals_brute_force(documents):
    docs = near_copies(documents)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    prints = {i: brute_print(t) for i, t in texts.items()}
    want = brute_components(sorted(texts), prints)
    assert len(set(want.values())) < len(want) - 20
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert {i: r["fingerprint"] for i, r in got.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    kept = sorted(r["doc_id"] for r in simhash.drop_near_duplicates(docs).collect())
    assert kept == sorted(set(want.values()))


@pytest.mark.parametrize(("bits", "crowd"), [(0, 64), (1, 64), (3, 64), (3, 1)])
def test_links_have_the_components_of_all_pairs(spark, bits, crowd):
    """With a crowd of 1, every shared key takes the way of the crowded ones."""
    rng = random.Random(4)
    prints = [rng.getrandbits(64)]
    for _ in range(200):
        value = rng.choice(prints) if rng.random() < 0.7 else rng.getrandbits(64)
        for _ in range(rng.randrange(5)):
            value ^= 1 << rng.randrange(64)
        prints.append(value)
    prints = sorted(set(prints))
    want = brute_components(list(range(len(prints))), prints, bits)
    assert components_of(spark, prints, bits, crowd) == want


def test_buckets_of_crowds_are_bounded():
    """After the second cut, few enough bits are free to bound a bucket."""
    every = (1 << 64) - 1
    for mask in simhash.block_masks(every, 6, 3):
        free = ~mask & every
        for finer in simhash.block_masks(free, 8, 3):
            assert (free & ~finer).bit_count() <= 13


def test_the_plan_of_crowds_is_small(spark):
    """The finer masks are data: as expressions they filled the driver's memory."""
    crowds = spark.sql("SELECT 0 AS mask, 1L AS part, 2L AS fp")
    links = simhash._crowded(crowds, simhash.block_masks((1 << 64) - 1, 6, 3), 3)
    assert links._jdf.queryExecution().analyzed().toString().count("struct(") < 50
    assert links.collect() == []


def test_edge_cases(texts):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (5, "ONE"), (None, "one"),
            (6, "two words"), (7, "w " * 150_000)]
    docs = texts(*rows).withColumn("fp", F.lit("x")).withColumn("_own_hash", F.lit("mine"))
    got = sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=str)
    want = []
    for i, text in rows:
        component = {0: 1}.get(brute_print(text), 4 if text and text.lower() == "one" else i)
        want.append((i, f"{brute_print(text):016x}", component))
    assert got == sorted(want, key=str)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 4, 6, 7]
    assert {r["_own_hash"] for r in kept.collect()} == {"mine"}
    assert simhash.near_duplicates(texts()).count() == 0
    assert simhash.drop_near_duplicates(texts()).count() == 0


def test_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(900, 901)], "a long, b long")
    got = {r["node"]: r["label"] for r in connected_components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {900: 900, 901: 900}
