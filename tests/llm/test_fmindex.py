from __future__ import annotations

import random

import numpy as np
import pytest

from martlet.llm.fmindex import DELETE, INSERT, REPLACE, BidirectionalIndex


def kind(query, word):
    """The edit that leads from the query to the word, if one does."""
    if len(query) == len(word):
        return REPLACE if sum(a != b for a, b in zip(query, word)) == 1 else 0
    short, long = sorted((query, word), key=len)
    cut = {long[:i] + long[i + 1 :] for i in range(len(long))}
    if short not in cut:
        return 0
    return INSERT if len(word) > len(query) else DELETE


def found(index, queries, edits, batch=16):
    pairs = index.near(queries, np.full(len(queries), edits), batch)
    return [(int(a), int(b)) for q, w in pairs for a, b in zip(q, w)]


@pytest.mark.parametrize("letters", ["ab", "abcdé"])
def test_equals_brute_force(letters):
    rng = random.Random(3)

    def draw(letters):
        return "".join(rng.choice(letters) for _ in range(rng.randrange(2, 9)))

    for _ in range(40):
        words = sorted({draw(letters) for _ in range(rng.randrange(1, 60))})
        queries = [draw(letters + "z") for _ in range(20)] + words
        index = BidirectionalIndex(words)
        for edits in (REPLACE | INSERT | DELETE, REPLACE, INSERT, DELETE):
            got = found(index, queries, edits)
            want = [
                (i, j)
                for i, query in enumerate(queries)
                for j, word in enumerate(words)
                if kind(query, word) & edits
            ]
            assert sorted(got) == want and len(set(got)) == len(got)


def test_both_intervals_stay_in_step():
    words = sorted({"banana", "bandana", "ananas", "nab", "abba"})
    index = BidirectionalIndex(words)
    text = "\0" + "\0".join(words)
    ring = text * 2

    def rank(pattern, ring):
        turns = sorted(ring[i : i + len(text)] for i in range(len(text)))
        held = [i for i, turn in enumerate(turns) if turn.startswith(pattern)]
        return (held[0], len(held)) if held else None

    code = {chr(p): i for i, p in enumerate(index.alphabet)}
    for pattern in ("ana", "an", "\0ban", "na\0", "bb"):
        low, back, size = (np.array([v]) for v in (0, 0, len(text)))
        middle = len(pattern) // 2
        for char in reversed(pattern[:middle]):
            low, size, smaller = index.left.extend(low, size, np.array([code[char]]))
            back = back + smaller
        for char in pattern[middle:]:
            back, size, smaller = index.right.extend(back, size, np.array([code[char]]))
            low = low + smaller
        assert (low[0], size[0]) == rank(pattern, ring)
        assert (back[0], size[0]) == rank(pattern[::-1], ring[::-1])


def test_edges():
    assert list(BidirectionalIndex([]).near(["ab"], np.array([REPLACE]))) == []
    one = BidirectionalIndex(["ab"])
    assert found(one, ["ab", "abb", "a" * 5000, "ac"], 7) == [(1, 0), (3, 0)]
    long = "x" * 3000
    index = BidirectionalIndex([long, long + "x", long + "y"])
    got = found(index, [long, "x" * 2999 + "z"], 7)
    assert sorted(got) == [(0, 1), (0, 2), (1, 0)]
