from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from martlet.llm import convtrie
from martlet.llm.queries import op11_conversation_trie

DATA = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rebuilt(rows):
    """The turns of every conversation, with the heads shared."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn, role or "", text or ""))

    def place(t):
        digest = hashlib.sha256(f"{len(t[1])}:{t[1]}{t[2]}".encode()).hexdigest()
        return t[0] is not None, t[0] or 0, digest

    own = {c: [t[1:] for t in sorted(turns, key=place)] for c, turns in own.items()}
    heads = {c: zlib.crc32(str(c).encode()) % 4 for c in own}
    return {c: (*own.get(c - c % 20, [])[: heads[c]], *t[heads[c] :]) for c, t in own.items()}


def nodes(found):
    """All nodes of the trie, by the definition."""
    members, children, leaves, saved = {}, {}, {}, {}
    for conv, turns in found.items():
        for depth in range(len(turns) + 1):
            members.setdefault(turns[:depth], []).append(conv)
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[c] for c in below) or 1
        again = (len(members[node]) - 1) * len(WORD.findall(node[-1][1])) if node else 0
        saved[node] = again + sum(saved[c] for c in below)
    result = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(found[c]) == len(node))
        result.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
            len(children.get(node, [])), leaves[node], saved[node],
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(result, key=str)


def trie(messages, **options):
    heads = F.crc32(F.col("conv_id").cast("string")) % 4
    found = convtrie.with_shared_heads(convtrie.sequences(messages), 20, heads, most=3)
    return sorted(map(tuple, convtrie.conversation_trie(found, **options).collect()), key=str)


def test_given_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/conversations.parquet").collect()]
    got = sorted(map(tuple, op11_conversation_trie(spark, DATA).collect()), key=str)
    assert got == nodes(rebuilt(rows))


@pytest.mark.parametrize("block, chunk", [(1, 1), (2, 3), (3, 10), (64, 1000)])
def test_random_conversations(spark, frame, block, chunk):
    rng = random.Random(block)
    rows = [
        (conv, turn, rng.choice(["u", "a"]), rng.choice(["x", "y  z", ""]))
        for conv in range(150)
        for turn in range(rng.randrange(9))
    ]
    options = {"block": block, "chunk_rows": chunk, "chunk_cells": 10 * chunk}
    assert trie(frame(SCHEMA, *rows), **options) == nodes(rebuilt(rows))


def test_one_conversation_repeated_over_shards(frame):
    """Equal sequences, a hot first turn, and a prefix that ends where others go on."""
    rows = [(c, t, "u", f"word {t}") for c in range(100, 400) for t in range(3 if c % 3 else 5)]
    rows += [(c, 0, "u", f"own {c % 7}") for c in range(1000, 1100)]
    assert trie(frame(SCHEMA, *rows), chunk_rows=20) == nodes(rebuilt(rows))


def test_deep_and_long(frame):
    rows = [(c, t, "u", "w " * (t % 3)) for c in (3, 4, 5, 6) for t in range(200 + 37 * c)]
    rows += [(50, 0, "u", "long " * 50_000)]
    assert trie(frame(SCHEMA, *rows), block=16) == nodes(rebuilt(rows))


def test_edges(frame):
    rows = [
        (None, 0, "u", "nobody's"), (1, None, None, None), (1, 0, "u", "a\x0bb"), (1, 0, "u", "a\x0bb"),
        (1, 0, "u", "c"), (25, 1, "user", "only"), (26, 1, "us", "eronly"), (20, 7, "", ""),
        (7, 0, None, "x"), (7, 1, "", "x"), (8, 0, "", "x"), (-3, 0, "u", "below"),
    ]
    docs = frame(SCHEMA, *rows)
    want = nodes(rebuilt([r for r in rows if r[0] != -3]))
    assert trie(docs.where("conv_id >= 0 OR conv_id IS NULL")) == want
    extra = docs.withColumn("turns", F.lit("mine")).withColumn("ids", F.lit("mine"))
    assert trie(extra.where("conv_id >= 0")) == want
    assert trie(docs)[0] is not None
    assert trie(frame(SCHEMA)) == []


def test_node_starts_of_a_padded_matrix():
    rng = np.random.default_rng(4)
    for block in (1, 2, 5, 64):
        length = rng.integers(0, 9, 60)
        ids = rng.integers(1, 3, length.sum())
        order, new = convtrie.node_starts(ids, length, block)
        start = np.cumsum(length) - length
        found = [tuple(ids[start[r] : start[r] + length[r]]) for r in order]
        assert found == sorted(found)
        seen = set()
        for r, turns in zip(order, found):
            for depth in range(len(turns)):
                first = turns[: depth + 1] not in seen
                assert new[start[r] + depth] == first
                seen.add(turns[: depth + 1])
