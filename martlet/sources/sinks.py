"""Writers. A table is a folder of Parquet files that is replaced as a whole or by partition."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.operators.sales import forget, next_watermark, purge, since
from martlet.schemas import table
from martlet.session import materialise, remove_folder
from martlet.sources.tables import table_or_empty


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace a table. CSV gets a header; JSON lines leave out null fields."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def write_partitioned(
    df: DataFrame, path: str, keys: list[str], only_present: bool = False
) -> None:
    """Replace a table, one folder per key value.

    A full load replaces the whole table, so nothing stays of rows that left the source. With
    ``only_present`` the partitions that do not occur in ``df`` are left as they are.

    The rebalance brings the rows of a partition together so it gets few files, and splits a
    partition that is too large for one task, so a month with most of the sales is written by
    many tasks.
    """
    (
        df.hint("rebalance", *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if only_present else "static")
        .partitionBy(*keys)
        .parquet(path)
    )


def append_ticks(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("header", False).csv(path)


def write_quality_log(report: DataFrame, path: str, run_ts: str) -> None:
    """Replace the log of the last run: a Parquet table and readable text lines."""
    stamped = report.withColumn("run_ts", F.lit(run_ts).cast("timestamp_ntz"))
    folder = f"{path}/quality_report"
    stamped.select("run_ts", "source", "check", "action", "affected").write.mode(
        "overwrite"
    ).parquet(folder)
    # The text comes from the table, so the checks run once. Files follow the order of lines.
    lines = quality_lines(report.sparkSession.read.parquet(folder), run_ts)
    lines.orderBy("position", "value").select("value").write.mode("overwrite").text(
        f"{path}/quality_report_text"
    )


def quality_lines(report: DataFrame, run_ts: str) -> DataFrame:
    """``[time] source: check -> action (n rows)`` between a first and a last line."""
    stamp = F.lit(f"[{run_ts}] ")
    checks = report.select(
        F.lit(1).alias("position"),
        F.concat(
            stamp,
            F.col("source"),
            F.lit(": "),
            F.col("check"),
            F.lit(" -> "),
            F.col("action"),
            F.format_string(" (%d rows)", "affected"),
        ).alias("value"),
    )
    ends = F.array(
        F.struct(F.lit(0).alias("position"), F.concat(stamp, F.lit("Run started.")).alias("value")),
        F.struct(F.lit(2).alias("position"), F.concat(stamp, F.lit("Run completed.")).alias("value")),
    )
    return checks.unionByName(report.sparkSession.range(1).select(F.inline(ends)))


def read_watermark(spark: SparkSession, path: str):
    """The largest value loaded so far; null before the first load."""
    stored = table_or_empty(spark, path, table("watermark TIMESTAMP"), "parquet")
    return stored.agg(F.max("watermark")).first()[0]


def append_since(
    df: DataFrame,
    path: str,
    column: str,
    keys: list[str],
    watermark_path: str,
    *,
    look_back: timedelta | None = None,
    identity: list[str] | None = None,
) -> None:
    """Load what came after the last load: add it to the table, then move the watermark.

    The new rows go to a folder named by the watermark they start from and the number of loads
    before, so a load that broke off is replaced by its repetition and not added twice. Rows that
    are not newer than the watermark are late. With ``look_back``, those up to so much older are
    loaded too, if the table has no row of the same ``identity`` (columns that name a row) in
    that time; each arrives once, however often the load runs. Older ones are not loaded. Rows
    without a value in ``column`` have no place in the order: no load takes them, and all of the
    source stand in ``{path}_undated``.
    """
    spark = df.sparkSession
    mark = read_watermark(spark, watermark_path)
    write_table(df.where(F.col(column).isNull()), f"{path}_undated")
    dated = df.where(F.col(column).isNotNull())
    new = dated if mark is None else since(dated, column, mark)
    load = "first"
    if mark is not None:
        loads = table_or_empty(spark, watermark_path, table("watermark TIMESTAMP"), "parquet").count()
        load = f"{mark.strftime('%Y%m%dT%H%M%S%f')}-{loads}"
    if mark is not None and look_back is not None:
        if not identity:
            raise ValueError("late rows need columns that tell whether they are there already")
        until = F.col(column) <= F.lit(mark.isoformat()).cast("timestamp_ntz")
        late = since(dated, column, mark - look_back).where(until)
        held = since(spark.read.parquet(path).where(F.col("load") != load), column, mark - look_back)
        known = held.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(identity)])
        same = F.lit(True)
        for i, name in enumerate(identity):
            same = same & late[name].eqNullSafe(known[f"_{i}"])
        once = late.join(known, same, "left_anti").dropDuplicates(identity)
        new = new.unionByName(once)
    labelled = new.withColumn("load", F.lit(load))
    write_partitioned(labelled, path, [*keys, "load"], only_present=True)
    written = spark.read.schema(labelled.schema).parquet(path).where(F.col("load") == load)
    moved = next_watermark(written, column)
    if mark is not None:  # late rows alone do not move it back
        moved = moved.select(
            F.greatest("watermark", F.lit(mark.isoformat()).cast("timestamp_ntz")).alias("watermark")
        )
    moved.coalesce(1).write.mode("append").parquet(watermark_path)


def compact_loads(spark: SparkSession, path: str, target: str, keys: list[str]) -> None:
    """Write an incrementally loaded table to ``target`` with one folder per key, not per load."""
    merged = spark.read.parquet(path).withColumn("load", F.lit("compacted"))
    write_partitioned(merged, target, [*keys, "load"])


def retain(spark: SparkSession, path: str, day: str, as_of: date, days: int = 90) -> list[str]:
    """Drop the day folders that retention does not keep; returns the days that went.

    The table is laid out by ``day``, so nothing is rewritten and only names are read.
    """
    present = spark.read.parquet(path).select(day).distinct()
    old = present.subtract(purge(present, day, as_of, days)).orderBy(day).collect()
    for row in old:
        remove_folder(spark, f"{path}/{day}={row[0]}")
    return [str(row[0]) for row in old]


def forget_rows(
    spark: SparkSession, path: str, ids: DataFrame, keys: list[str], key: str = "customer_id"
) -> None:
    """Take customers out of a table laid out by ``keys``; only partitions that hold them change.

    What stays of those partitions is first written beside the table and then put in place
    partition by partition, so a run that breaks off leaves rows twice nowhere and loses none.
    The partition of rows without a value is one like any other. Folders are known by the files
    in them, as their names are not the values' texts. A table without ``keys`` is rewritten.
    """
    stored = spark.read.parquet(path)
    # A partition column without any value is read without a type, and cannot be written so.
    untyped = [f.name for f in stored.schema if f.dataType.typeName() == "void"]
    stored = stored.withColumns({name: F.col(name).cast("string") for name in untyped})
    known = ids.select(key).distinct()
    beside = f"{path}_rest"
    if not keys:
        write_table(forget(stored, known, key), beside)
        write_table(spark.read.schema(stored.schema).parquet(beside), path)
        remove_folder(spark, beside)
        return
    folder = F.regexp_extract(F.col("_metadata.file_path"), "^(.*)/[^/]*$", 1)
    located = stored.select("*", folder.alias("_folder"))
    hit = materialise(located.join(known, key, "left_semi").select("_folder").distinct())
    rest = forget(located.join(hit, "_folder", "left_semi"), known, key)
    held = materialise(rest.select("_folder").distinct())
    write_partitioned(rest.drop("_folder"), beside, keys)
    left = spark.read.schema(stored.schema).parquet(beside)
    emptied = hit.join(held, "_folder", "left_anti").collect()
    write_partitioned(left, path, keys, only_present=True)
    for row in emptied:
        remove_folder(spark, row[0], encoded=True)
    remove_folder(spark, beside)


# The tables of the hub that hold customers, and the columns they are laid out by.
CUSTOMER_TABLES = {
    "dim_customers": [],
    "fact_sales": ["year", "month"],
    "fact_web_events": ["event_date"],
    "quarantine_sales": [],
    "quarantine_web_events": [],
}
_NAMED = r'"customer_id"\s*:\s*"?(-?\d+)(?:\.0+)?(?!\d)'


def forget_in_hub(spark: SparkSession, hub: str, ids: DataFrame, key: str = "customer_id") -> None:
    """Take customers out of every table of the hub, those of faulty rows and lines included."""
    for name, keys in CUSTOMER_TABLES.items():
        if _exists(spark, f"{hub}/{name}"):
            forget_rows(spark, f"{hub}/{name}", ids, keys, key)
    path = f"{hub}/quarantine_web_lines"
    if _exists(spark, path):
        lines = spark.read.parquet(path)
        named = lines.select("value", F.explode(F.regexp_extract_all("value", F.lit(_NAMED))).alias(key))
        texts = ids.select(F.col(key).cast("string")).distinct()
        theirs = named.join(texts, key, "left_semi").select("value").distinct()
        beside = f"{path}_rest"
        write_table(lines.join(theirs, "value", "left_anti"), beside)
        write_table(spark.read.schema(lines.schema).parquet(beside), path)
        remove_folder(spark, beside)


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return False
    return True


def append_audit(
    spark: SparkSession, path: str, at: str, user_id: str, query_text: str, view_accessed: str
) -> None:
    """Record one query in the audit table."""
    row = spark.range(1).select(
        F.lit(at).cast("timestamp_ntz").alias("timestamp"),
        F.lit(user_id).alias("user_id"),
        F.lit(query_text).alias("query_text"),
        F.lit(view_accessed).alias("view_accessed"),
    )
    row.coalesce(1).write.mode("append").parquet(path)
