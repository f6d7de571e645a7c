"""As-of lookups: the version of a record that was valid at a time.

Neither a range join nor a window over a whole key is needed. What a lookup finds depends on the
key and the instant alone, so only the distinct instants take part; they and the versions are cut
into days, within which a running window carries the last version on. A day's last version is
then carried over the days of its key, one row each. Both windows are bounded by the clock (the
instants of a day, the days there are), whatever share of the rows one key has; the rows themselves
meet the result in a join of equals, which adaptive execution splits for a hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_VERSION, _INSTANT = 0, 1


def _latest_per_instant(versions: DataFrame, key: str, time: str, columns: list[str]) -> DataFrame:
    """One version per key and time: of several, the one with the largest columns in their order."""
    known = versions.where(F.col(key).isNotNull() & F.col(time).isNotNull())
    return known.groupBy(F.col(key).alias("_key"), F.col(time).alias("_time")).agg(
        F.max(F.struct(F.col(time).alias("_since"), *columns)).alias("_version")
    )


def with_version_at(
    rows: DataFrame,
    versions: DataFrame,
    *,
    key: str,
    time: str,
    valid_from: str,
    columns: list[str],
    since: str = "valid_from",
    strict: bool = False,
) -> DataFrame:
    """``rows`` with ``columns`` of the version valid at their ``time``, and ``since`` when it was.

    That is the key's version with the largest ``valid_from`` up to the time, or, if ``strict``,
    before it. Every row stays once; the columns are null for a row before the first version,
    without a key or time, or of a key without versions. Versions without a key or time are
    valid never. Of versions that begin at the same time the largest by ``columns`` is valid.
    Rows and versions are read twice; equal rows are told apart nowhere.
    """
    instants = rows.select(F.col(key).alias("_key"), F.col(time).alias("_time")).dropna().distinct()
    found = _latest_per_instant(versions, key, valid_from, columns)
    version = found.schema["_version"].dataType
    # A lookup comes behind the versions of its instant, or before them if it must not see them.
    events = found.withColumn("_turn", F.lit(_VERSION)).unionByName(
        instants.withColumns(
            {"_version": F.lit(None).cast(version), "_turn": F.lit(-1 if strict else _INSTANT)}
        )
    )
    events = events.withColumn("_day", F.to_date("_time"))
    in_day = Window.partitionBy("_key", "_day").orderBy("_time", "_turn")
    seen = events.withColumn("_seen", F.last("_version", ignorenulls=True).over(in_day))
    looked_up = seen.where(F.col("_turn") != _VERSION).select("_key", "_day", "_time", "_seen")

    days = events.groupBy(F.col("_key").alias("_of"), F.col("_day").alias("_on")).agg(
        F.max("_version").alias("_last")
    )
    before = Window.partitionBy("_of").orderBy("_on").rowsBetween(Window.unboundedPreceding, -1)
    carried = days.select(
        "_of", "_on", F.last("_last", ignorenulls=True).over(before).alias("_carried")
    )
    same_day = (F.col("_key") == F.col("_of")) & (F.col("_day") == F.col("_on"))
    valid = looked_up.join(carried, same_day, "left").select(
        "_key", "_time", F.coalesce("_seen", "_carried").alias("_valid")
    )
    valid = valid.where(F.col("_valid").isNotNull())

    def field(name: str, source: str) -> Column:
        return F.col(f"_valid.{source}").alias(name)

    same = (F.col(key) == F.col("_key")) & (F.col(time) == F.col("_time"))
    return rows.join(valid, same, "left").select(
        *rows.columns, *[field(c, c) for c in columns], field(since, "_since")
    )
