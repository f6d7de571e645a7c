"""Approximate nearest neighbours by cosine: stable projections, a kd-tree, a chi-square stop.

Vectors are scaled to unit length, where the largest cosine is the smallest distance, and are
projected to a few dimensions by Gaussian (2-stable) numbers. For two vectors at distance d, the
squared projected distance over d^2 follows a chi-square law with as many degrees of freedom. A
query therefore takes projected neighbours from the kd-tree's boxes in their order, verifies on
the original vectors those that the stopping test still asks for, and stops as soon as the law
says that a neighbour as near as the k-th found so far would have come by now with probability
``confidence``. More dimensions make the law sharper, so fewer rows are verified; the default is
chosen so that on vectors whose nearest are not much nearer than the rest (cosines of 0.45
against 0) well under half are, at a recall over 0.9.

The tree has two levels. Its upper splits are fitted on a bounded sample and deal all vectors
out to cells; a cell with many rows is cut by a hash of the id. In each cut a task builds the
lower tree over its rows. A query first searches one cut of its own cell; the bound found there,
by the same stopping test, names the other cells that it has to visit, and holds in all of them.
A cut that very many queries visit is searched by several tasks, each with a chunk of the
queries; only such cuts are copied.

Of equal vectors, only the k+1 smallest ids can ever be among anyone's k nearest, as ties go to
the smaller id. The others are set aside before the search, and equal queries are searched once;
a vector that a third of all rows share costs no more than any other.

Defined results: ids or vectors that are null, and vectors that are zero, empty or hold a null
or a number that is not finite, take no part, nor do vectors of another length than most have
(the smaller of equally frequent lengths). Of rows that repeat an id the one with the smallest
vector counts. A query's own id is no candidate. With fewer candidates than k, all of them are
returned; an empty table gives no rows. Other columns take no part.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from martlet.session import materialise

LOW = 32
CONFIDENCE = 0.85
CELL_ROWS = 8192
SAMPLE_ROWS = 16_384
QUERY_ROWS = 16_384
_LEAF = 32
_NONE = float("-inf")


def chi_square_bound(probability: float, degrees: int) -> float:
    """The value that a chi-square number of an even count of degrees stays below."""
    if degrees % 2:
        raise ValueError("an even number of projected dimensions is needed")

    def below(x: float) -> float:
        return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(degrees // 2))

    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < probability else (low, middle)
    return high


def _stacked(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64)


def _norms(vectors: np.ndarray) -> np.ndarray:
    scale = np.abs(vectors).max(axis=1)
    return scale * np.sqrt(((vectors / scale[:, None]) ** 2).sum(axis=1))


def projected(vector: Column, length: int, low: int, seed: int) -> Column:
    """Projection of the unit vector, ``array<double>``."""
    numbers = np.random.default_rng(seed).normal(size=(length, low))

    @F.pandas_udf("array<double>")
    def project(vectors: pd.Series) -> pd.Series:
        given = _stacked(vectors) if len(vectors) else np.zeros((0, length))
        units = given / _norms(given)[:, None]
        # Row by row, so that equal vectors get equal projections wherever they stand.
        return pd.Series(list(np.einsum("ij,jk->ik", units, numbers)), dtype=object)

    return project(vector)


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


@dataclass(frozen=True)
class Cells:
    """The upper tree: splits in heap order, and each cell's box."""

    axes: np.ndarray
    values: np.ndarray
    lows: np.ndarray
    highs: np.ndarray

    def of(self, points: np.ndarray) -> np.ndarray:
        at = np.zeros(len(points), np.int64)
        for _ in range(int(math.log2(len(self.lows)))):
            right = points[np.arange(len(points)), self.axes[at]] >= self.values[at]
            at = 2 * at + 1 + right
        return at - len(self.axes)

    def distances(self, point: np.ndarray) -> np.ndarray:
        """Squared distances to the boxes of all cells."""
        return _box_distances(self.lows, self.highs, point)


def _box_distances(lows: np.ndarray, highs: np.ndarray, point: np.ndarray) -> np.ndarray:
    outside = np.maximum(lows - point, 0) + np.maximum(point - highs, 0)
    return (outside**2).sum(axis=1)


def fit_cells(sample: np.ndarray, cells: int) -> Cells:
    """Split the widest axis at its median until there are ``cells`` cells, a power of two."""
    low = sample.shape[1]
    axes, values = np.zeros(cells - 1, np.int64), np.zeros(cells - 1)
    boxes = {0: (sample, np.full(low, -np.inf), np.full(low, np.inf))}
    for node in range(cells - 1):
        rows, lows, highs = boxes.pop(node)
        axis = int(np.argmax(np.ptp(rows, axis=0))) if len(rows) else 0
        value = float(np.median(rows[:, axis])) if len(rows) else 0.0
        axes[node], values[node] = axis, value
        left, right = highs.copy(), lows.copy()
        left[axis] = right[axis] = value
        boxes[2 * node + 1] = (rows[rows[:, axis] < value], lows, left)
        boxes[2 * node + 2] = (rows[rows[:, axis] >= value], right, highs)
    kept = [boxes[node] for node in range(cells - 1, 2 * cells - 1)]
    return Cells(axes, values, np.array([b[1] for b in kept]), np.array([b[2] for b in kept]))


class LeafIndex:
    """The lower tree over one task's rows: leaves of near points with their boxes."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, points: np.ndarray) -> None:
        leaves, stack = [], [np.arange(len(ids))]
        while stack:
            rows = stack.pop()
            if len(rows) <= _LEAF:
                leaves.append(rows)
                continue
            axis = int(np.argmax(np.ptp(points[rows], axis=0)))
            rows = rows[np.argsort(points[rows, axis], kind="stable")]
            stack += [rows[: len(rows) // 2], rows[len(rows) // 2 :]]
        self.lows = np.array([points[rows].min(axis=0) for rows in leaves])
        self.highs = np.array([points[rows].max(axis=0) for rows in leaves])
        # Rows in the order of the leaves, so that a leaf is a slice.
        order = np.concatenate(leaves)
        self.ids, self.vectors, self.points = ids[order], vectors[order], points[order]
        self.verified = 0
        self.norms = _norms(self.vectors)
        self.ends = np.cumsum([len(rows) for rows in leaves])
        self.starts = self.ends - [len(rows) for rows in leaves]

    def nearest(
        self, vector: np.ndarray, point: np.ndarray, most: int, bound: float, reach: float
    ) -> list[tuple[float, int]]:
        """The best (cosine, id), best first; ``bound`` is a cosine already reached ``most`` times.

        Leaves come in the order of their boxes' distance, a few at a time and then more, and
        after each lot the stopping test tells whether the next one is still needed.
        """
        own = _norms(vector[None, :])[0]
        found: list[tuple[float, int]] = []
        boxes = _box_distances(self.lows, self.highs, point)
        order = np.argsort(boxes, kind="stable")
        boxes, at, lot = boxes[order], 0, 4
        while at < len(order):
            limit = reach * max(0.0, 2 - 2 * bound) + 1e-9
            within = int(np.searchsorted(boxes, limit, side="right"))
            if at >= within:
                break
            taken = order[at : min(at + lot, within)]
            at, lot = at + lot, 2 * lot
            rows = np.concatenate([np.arange(self.starts[i], self.ends[i]) for i in taken])
            rows = rows[((self.points[rows] - point) ** 2).sum(axis=1) <= limit]
            if not len(rows):
                continue
            self.verified += len(rows)
            # Row by row, so that equal vectors get equal cosines wherever they stand.
            cosines = np.einsum("ij,j->i", self.vectors[rows], vector) / (self.norms[rows] * own)
            good = np.flatnonzero(cosines >= bound)
            if len(good) > most:
                least = np.partition(cosines[good], len(good) - most)[len(good) - most]
                good = good[cosines[good] >= least]
            found += zip((-cosines[good]).tolist(), self.ids[rows[good]].tolist(), strict=True)
            found.sort()
            del found[most:]
            if len(found) == most:
                bound = max(bound, -found[-1][0])
        return [(-cosine, i) for cosine, i in found]


def nearest_neighbours(
    vectors: DataFrame,
    is_query: Column,
    *,
    k: int = 5,
    confidence: float = CONFIDENCE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    low: int = LOW,
    cell_rows: int = CELL_ROWS,
    sample_rows: int = SAMPLE_ROWS,
    query_rows: int = QUERY_ROWS,
    seed: int = 5,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` nearest, nearest first."""
    vector = F.col(vector_col)
    given = vectors.select(
        F.col(id_col).cast("long").alias("id"), vector.alias("vector"), is_query.alias("asks")
    ).where(F.col("id").isNotNull() & usable(F.col("vector")))
    lengths = given.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n")
    length = (lengths.first() or [0])[0]
    rows = given.where(F.size("vector") == length).groupBy("id").agg(
        F.min("vector").alias("vector"), F.max("asks").alias("asks")
    )
    # Of equal vectors, the smallest ids; the first of them stands for all in the search.
    place = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    first = rows.withColumn("place", place).where(F.col("place") <= k + 1)
    points = materialise(
        first.withColumn("point", projected(F.col("vector"), length, low, seed))
    )
    asking = rows.where("asks").groupBy("vector").agg(F.min("id").alias("query"))
    queries = materialise(
        asking.withColumn("point", projected(F.col("vector"), length, low, seed))
    )
    cells, cuts = _cells_for(points, low, cell_rows, sample_rows)
    reach = chi_square_bound(confidence, low)

    dealt = points.select("id", "vector", "point", _cell(cells)("point").alias("cell"))
    pieces = F.lit(1)
    for cell, cut in enumerate(cuts):
        pieces = F.when(F.col("cell") == cell, cut).otherwise(pieces) if cut > 1 else pieces
    dealt = materialise(dealt.withColumn("cut", F.pmod(F.xxhash64("id"), pieces).cast("int")))

    def search(asked: DataFrame) -> DataFrame:
        return materialise(_search(dealt, asked, k + 1, reach, query_rows))

    begin = queries.withColumn("bound", F.lit(_NONE))
    near = search(begin.withColumn("visits", _visits(cells, cuts, reach, own=True)("point", "bound")))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    worst = near.withColumn("place", F.row_number().over(order)).where(F.col("place") == k + 1)
    bounds = worst.select("query", F.col("score").alias("bound"))
    begin = queries.join(bounds, "query", "left").withColumn("bound", F.coalesce("bound", F.lit(_NONE)))
    far = search(begin.withColumn("visits", _visits(cells, cuts, reach, own=False)("point", "bound")))

    best = near.union(far).withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    askers = rows.where("asks").join(asking, "vector").select(F.col("id").alias("query_id"), "query")
    each = askers.join(best, "query").where(F.col("id") != F.col("query_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return each.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", "rank", F.col("id").alias("vec_id"), "score"
    )


def _cells_for(
    points: DataFrame, low: int, cell_rows: int, sample_rows: int
) -> tuple[Cells, list[int]]:
    """The upper tree, and into how many cuts each cell goes."""
    count = points.count()
    share = min(1.0, sample_rows / max(1, count))
    drawn = points.where(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 30)) < share * (1 << 30))
    sample = drawn.select("id", "point").orderBy("id").limit(2 * sample_rows).toPandas()
    given = _stacked(sample["point"]) if len(sample) else np.zeros((0, low))
    wanted = min(max(1, count / cell_rows), max(1, len(sample) / 8))
    cells = fit_cells(given, 1 << math.ceil(math.log2(wanted)))
    sizes = dict(points.groupBy(_cell(cells)("point").alias("cell")).count().collect())
    return cells, [max(1, math.ceil(sizes.get(i, 0) / (2 * cell_rows))) for i in range(len(cells.lows))]


def _cell(cells: Cells):
    @F.pandas_udf("int")
    def cell(points: pd.Series) -> pd.Series:
        found = cells.of(_stacked(points)) if len(points) else np.zeros(0)
        return pd.Series(found, dtype="int32")

    return cell


def _visits(cells: Cells, cuts: list[int], reach: float, own: bool):
    """The cuts that a query visits: one of its own cell, or all others within reach."""

    @F.pandas_udf("array<struct<cell: int, cut: int>>")
    def visits(points: pd.Series, bounds: pd.Series) -> pd.Series:
        found = []
        for point, bound in zip(points, bounds, strict=True):
            home = int(cells.of(point[None, :])[0])
            first = home, zlib.crc32(point.tobytes()) % cuts[home]
            if own:
                wanted = [first]
            else:
                within = cells.distances(point) <= reach * max(0.0, 2 - 2 * bound) + 1e-9
                within[home] = True
                wanted = [(int(c), i) for c in np.flatnonzero(within) for i in range(cuts[c])]
                wanted.remove(first)
            found.append([{"cell": c, "cut": i} for c, i in wanted])
        return pd.Series(found, dtype=object)

    return visits


def _search(
    dealt: DataFrame, asked: DataFrame, most: int, reach: float, query_rows: int
) -> DataFrame:
    """Search every visited cut: ``query, id, score``."""
    visits = materialise(
        asked.select("query", "vector", "point", "bound", F.explode("visits").alias("visit")).select(
            "query", "vector", "point", "bound", "visit.cell", "visit.cut"
        )
    )
    chunks = F.ceil(F.count(F.lit(1)) / query_rows).cast("int").alias("chunks")
    crowds = visits.groupBy("cell", "cut").agg(chunks)
    numbers = F.sequence(F.lit(0), F.col("chunks") - 1)
    indexed = dealt.join(crowds, ["cell", "cut"]).withColumn("chunk", F.explode(numbers))
    visits = visits.join(crowds, ["cell", "cut"]).withColumn(
        "chunk", F.pmod(F.xxhash64("query"), F.col("chunks")).cast("int")
    )

    def search(points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(points) and len(queries):
            index = LeafIndex(
                points["id"].to_numpy(), _stacked(points["vector"]), _stacked(points["point"])
            )
            rows = queries[["query", "vector", "point", "bound"]].itertuples(index=False)
            for query, vector, point, bound in rows:
                given = np.asarray(vector, np.float64)
                for cosine, i in index.nearest(given, point, most, bound, reach):
                    found.append((query, i, cosine))
        return pd.DataFrame(found, columns=["query", "id", "score"])

    key = ["cell", "cut", "chunk"]
    result = StructType(
        [StructField("query", LongType()), StructField("id", LongType())]
    ).add("score", "double")
    indexed, visits = indexed.drop("chunks"), visits.drop("chunks")
    return indexed.groupBy(*key).cogroup(visits.groupBy(*key)).applyInPandas(search, result)
