from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from martlet.llm import ann

SCHEMA = "vec_id long, embedding array<float>"


def brute(ids, vectors, queries, k):
    units = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    found = {}
    for q in queries:
        cosines = units @ units[ids.index(q)]
        order = sorted((-round(c, 12), i) for c, i in zip(cosines, ids, strict=True) if i != q)
        found[q] = [i for _, i in order[:k]]
    return found


def recall(got, want):
    hits = sum(len(set(got.get(q, [])) & set(ids)) for q, ids in want.items())
    return hits / sum(map(len, want.values()))


def by_query(rows):
    found = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append(r["vec_id"])
        assert r["rank"] == len(found[r["query_id"]])
    return found


@pytest.mark.parametrize("cell_rows", [8192, 40])
def test_recall_on_the_given_vectors(spark, cell_rows):
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = vectors.collect()
    ids, given = [r["vec_id"] for r in rows], np.array([r["embedding"] for r in rows], float)
    asks = F.pmod(F.col("vec_id"), F.lit(50)) == 0
    got = ann.nearest_neighbours(vectors, asks, cell_rows=cell_rows, query_rows=3).collect()
    want = brute(ids, given, [i for i in ids if i % 50 == 0], 5)
    assert recall(by_query(got), want) >= 0.9
    for r in got:
        a, b = given[ids.index(r["query_id"])], given[ids.index(r["vec_id"])]
        cosine = a @ b / math.sqrt((a @ a) * (b @ b))
        assert r["score"] == pytest.approx(cosine, abs=1e-12)


def clustered(rng, rows=4000, length=64):
    centres = rng.normal(size=(50, length))
    return centres[rng.integers(0, 50, rows)] + 0.5 * rng.normal(size=(rows, length))


@pytest.mark.parametrize("kind", ["given", "clustered"])
def test_under_half_of_the_rows_are_verified(spark, kind):
    """At a recall over 0.9; of clustered vectors, far fewer."""
    if kind == "given":
        rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
        given = np.array([r["embedding"] for r in rows], float)
    else:
        given = clustered(np.random.default_rng(3))
    ids, rng = list(range(len(given))), np.random.default_rng(5)
    points = given / np.linalg.norm(given, axis=1)[:, None] @ rng.normal(size=(given.shape[1], ann.LOW))
    index = ann.LeafIndex(np.array(ids), given, points)
    reach = ann.chi_square_bound(ann.CONFIDENCE, ann.LOW)
    asked = ids[::20]
    got = {
        q: [i for _, i in index.nearest(given[q], points[q], 6, float("-inf"), reach) if i != q][:5]
        for q in asked
    }
    assert recall(got, brute(ids, given, asked, 5)) >= 0.9
    assert index.verified / (len(asked) * len(ids)) < (0.5 if kind == "given" else 0.1)


def test_only_crowded_cuts_are_copied(spark):
    """Every row is dealt to a task once per chunk of the queries that visit its own cut."""
    rng = np.random.default_rng(2)
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(clustered(rng, 600, 16))]
    frame = spark.createDataFrame(rows, SCHEMA)
    few = ann.nearest_neighbours(frame, F.col("vec_id") % 50 == 0, cell_rows=64, query_rows=5)
    many = ann.nearest_neighbours(frame, F.col("vec_id") % 50 == 0, cell_rows=64, query_rows=10_000)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))


def test_ties_and_copies(spark):
    """A vector that most rows share: the smallest ids come first, a row is not its neighbour."""
    rows = [(i, [1.0, 2.0, 0.0]) for i in range(200)] + [(500 + i, [float(i), 1.0, 1.0]) for i in range(20)]
    frame = spark.createDataFrame(rows, SCHEMA)
    asks = F.col("vec_id").isin(0, 3, 150, 505)
    got = by_query(ann.nearest_neighbours(frame, asks, k=3, cell_rows=8).collect())
    ids, given = [i for i, _ in rows], np.array([v for _, v in rows])
    assert got == brute(ids, given, [0, 3, 150, 505], 3)


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0]), (3, [0.0, 0.0]), (4, [nan, 1.0]),
            (5, [inf, 1.0]), (6, None), (7, []), (8, [None, 1.0]), (9, [1.0, 2.0, 3.0]), (None, [1.0, 0.0]),
            (10, [-1.0, 0.0])]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("vector", F.lit("mine"))
    got = by_query(ann.nearest_neighbours(frame, F.lit(True)).collect())
    assert got == {1: [2, 10], 2: [1, 10], 10: [2, 1]}
    assert ann.nearest_neighbours(frame.limit(0), F.lit(True)).count() == 0
    assert ann.nearest_neighbours(frame, F.lit(False)).count() == 0
    assert ann.nearest_neighbours(frame.where("vec_id = 1"), F.lit(True)).count() == 0


def test_chi_square_bound():
    assert ann.chi_square_bound(0.95, 6) == pytest.approx(12.5916, abs=1e-3)
    assert ann.chi_square_bound(0.99, 2) == pytest.approx(9.2103, abs=1e-3)


def test_cells_hold_their_points():
    points = np.random.default_rng(1).normal(size=(500, 6))
    cells = ann.fit_cells(points, 16)
    own = cells.of(points)
    assert set(own) == set(range(16))
    for point, cell in zip(points, own, strict=True):
        assert cells.distances(point)[cell] == 0
