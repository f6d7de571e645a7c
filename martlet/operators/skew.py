"""Work over groups of any size, in one lazy plan whatever the size.

A window over one key sorts the whole key in one task. Maxima are aggregates that merge on the
map side; numbering works on pieces of a key's order and adds the sizes of the pieces before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_COPIES = 10_000
_CROWD = 4_000
_STEP = 100_000


def with_group_max(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """``max(value) over (partition by key)`` as a new column; null is a key like any other.

    The join has no window, so adaptive execution can split a key with very many rows.
    """
    peaks = df.groupBy(F.col(key).alias("_key")).agg(F.max(value).alias(name))
    return df.join(peaks, F.col(key).eqNullSafe(F.col("_key"))).drop("_key")


def _coarse(df: DataFrame, column: str) -> Column:
    """A coarser value that never falls while ``column`` rises, so that it cuts the order."""
    kind, value = df.schema[column].dataType, F.col(column)
    if isinstance(kind, T.IntegralType):
        return F.floor(value / _STEP)
    if isinstance(kind, (T.DecimalType, T.FractionalType)):
        return F.floor(value.cast("double") / _STEP)
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.to_date(value)
    if isinstance(kind, T.StringType):
        return F.substring(value, 1, 8)
    return F.lit(0)


def with_row_number(df: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """``row_number() over (partition by key order by order)`` as a new BIGINT column.

    Ties of ``order`` are broken by the remaining columns, so the result is the same each run.
    Equal rows are counted first, so that any number of copies is one entry. A key of few entries
    is one piece. For the others, of which there are few, the whole order is cut at three depths:
    by ranges of its first column; within them by the first column and ranges of the second; within
    those by the first two and ranges of the third. Entries are numbered in the finest pieces, and
    the sizes of the pieces before are added up depth by depth, over counts alone. So a key is
    numbered by as many tasks as it has pieces, whatever its order begins with.
    """
    whole = order + [c for c in df.columns if c not in order and c != key]
    entries = df.groupBy(key, *whole).agg(F.count(F.lit(1)).alias("_copies"))
    ahead = (Window.unboundedPreceding, -1)
    none = F.lit(0).cast("bigint")
    sizes = entries.groupBy(key).agg(F.count(F.lit(1)).alias("_size"))
    crowded = sizes.where(F.col("_size") > _CROWD)
    crowds = crowded.select(F.col(key).alias("_key"), F.lit(True).alias("_crowd"))
    of_key = F.col(key).eqNullSafe(F.col("_key"))
    entries = entries.join(F.broadcast(crowds), of_key, "left")
    depths: list[list[str]] = []
    for depth, column in enumerate(whole[:3]):
        entries = entries.withColumn(f"_range{depth}", _coarse(df, column))
        depths.append([*whole[max(0, depth - 1) : depth], f"_range{depth}"])
    piece = [name for columns in depths for name in columns]

    def before(rows: DataFrame, group: list[str], by: list[str], size: str) -> Column:
        window = Window.partitionBy(*group).orderBy(*by).rowsBetween(*ahead)
        return F.coalesce(F.sum(size).over(window), none)

    counts = entries.where("_crowd").groupBy(key, *piece).agg(F.sum("_copies").alias("_size"))
    offsets = counts.withColumn("_offset", none)
    for depth, columns in enumerate(depths):
        # What lies before a piece of this depth within the piece around it.
        around = [key, *[name for outer in depths[:depth] for name in outer]]
        here = [*around, *columns]
        sizes = counts.groupBy(*here).agg(F.sum("_size").alias("_size"))
        ahead_of = sizes.select(
            *[F.col(c).alias(f"_of{i}") for i, c in enumerate(here)],
            before(sizes, around, columns, "_size").alias("_ahead"),
        )
        joined = offsets.join(ahead_of, _same(here))
        added = F.col("_offset") + F.col("_ahead")
        offsets = joined.withColumn("_offset", added).select(key, *piece, "_offset")
    # A struct is never null, so the window and the join below share one shuffle of the rows.
    named = [F.col(c).alias(f"p{i}") for i, c in enumerate([key, *piece])]
    of = offsets.select(F.struct(*named).alias("_of"), "_offset")
    cut = [F.when(F.col("_crowd"), F.col(c)).alias(f"p{i}") for i, c in enumerate(piece, 1)]
    entries = entries.withColumn("_piece", F.struct(named[0], *cut))
    entries = entries.select(*df.columns, "_copies", "_piece")
    inside = before(entries, ["_piece"], whole, "_copies")
    numbered = entries.withColumn("_inside", inside)
    placed = numbered.join(of.hint("merge"), F.col("_piece") == F.col("_of"), "left")

    # Very many copies are spelled out lot by lot, so that no row holds all of their numbers.
    ahead_of_piece = F.coalesce("_offset", none)
    first, lot = ahead_of_piece + F.col("_inside") + 1, F.lit(_COPIES).cast("bigint")
    placed = placed.select(*df.columns, first.alias("_first"), (first + F.col("_copies") - 1).alias("_last"))
    lots = placed.withColumn("_lot", F.explode(F.sequence("_first", "_last", lot)))
    numbers = F.sequence("_lot", F.least(F.col("_lot") + lot - 1, "_last"))
    return lots.select(*df.columns, F.explode(numbers).alias(name))


def _same(columns: list[str]) -> Column:
    """The columns equal their copies ``_of0, _of1, ...``; nulls equal each other."""
    same = F.lit(True)
    for i, column in enumerate(columns):
        same = same & F.col(column).eqNullSafe(F.col(f"_of{i}"))
    return same


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the smallest ``order`` for each key; other columns break ties.

    The minimum of a struct that carries the row merges on the map side, so a key with any
    number of copies sends one row per task through the shuffle, where ``row_number`` would
    send and sort them all.
    """
    others = [c for c in order if c not in keys]
    others += [c for c in df.columns if c not in keys and c not in others]
    if not others:
        return df.distinct()
    maps = {f.name for f in df.schema if isinstance(f.dataType, T.MapType)}

    def packed(column: str) -> Column:
        # A map has no order; its sorted entries do.
        entries = F.array_sort(F.map_entries(column)).alias(column)
        return entries if column in maps else F.col(column)

    def unpacked(column: str) -> Column:
        value = F.col(f"_row.{column}")
        return F.map_from_entries(value).alias(column) if column in maps else value

    first = df.groupBy(*keys).agg(F.min(F.struct(*[packed(c) for c in others])).alias("_row"))
    return first.select(*[F.col(c) if c in keys else unpacked(c) for c in df.columns])
