"""Live sales ticks: the newest rows and the series for the chart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martlet.schemas import RAW_TICKS, table
from martlet.session import run_id
from martlet.sources.growing import follow_lines
from martlet.sources.sinks import write_partitioned
from martlet.sources.tables import parse_ticks, table_or_empty

_TIES = ["store_id", "sales", "inventory"]
_STORED = table(
    "tick_ts TIMESTAMP, sales INT, inventory INT, store_id STRING, arrived_at TIMESTAMP, "
    "batch_id BIGINT, run_id STRING, slot INT"
)


def live_latest(ticks: DataFrame, n: int = 15) -> DataFrame:
    """The newest ``n`` ticks; recency 1 is the current value."""
    order = [F.desc("tick_ts"), *_TIES]
    newest = ticks.orderBy(*order).limit(n)
    return newest.withColumn("recency", F.row_number().over(Window.orderBy(*order)))


def live_panel(latest: DataFrame, log_rows: int = 5) -> DataFrame:
    """Current sales as text, and which of the newest ticks the log shows."""
    return latest.select(
        "tick_ts",
        "sales",
        "inventory",
        "store_id",
        F.when(F.col("recency") == 1, F.concat(F.lit("₹"), F.col("sales"))).alias("current_sales"),
        (F.col("recency") <= log_rows).alias("in_log"),
    )


def tick_series(ticks: DataFrame) -> DataFrame:
    return ticks.select("tick_ts", "sales")


def follow_ticks(spark: SparkSession, file: str) -> DataFrame:
    """Ticks of one file that a writer appends to, line by line; a half line waits."""
    row = F.from_csv("value", RAW_TICKS.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "))
    return parse_ticks(follow_lines(spark, file).select(row.alias("row")).select("row.*"))


def _tick_stream(spark: SparkSession, source: str, growing: bool) -> DataFrame:
    if growing:
        return follow_ticks(spark, source)
    return parse_ticks(spark.readStream.schema(RAW_TICKS).csv(source))


def _newest(ticks: DataFrame, n: int) -> DataFrame:
    return ticks.orderBy(F.desc("arrived_at"), F.desc("tick_ts"), *_TIES).limit(n)


def _merge_batch(ticks: DataFrame, batch_id: int, out_dir: str, run: str, n: int) -> None:
    """Newest ``n`` of this run's stored and new ticks, by arrival and then time.

    Two slots of the run take turns, so a batch reads what the one before wrote and may run
    again. Other runs have slots of their own.
    """
    stored = table_or_empty(ticks.sparkSession, f"{out_dir}/latest", _STORED, "parquet")
    before = stored.where(
        (F.col("run_id") == run)
        & (F.col("slot") == (batch_id + 1) % 2)
        & (F.col("batch_id") < batch_id)
    ).drop("run_id", "slot", "batch_id")
    new = ticks.withColumn("arrived_at", F.current_timestamp().cast("timestamp_ntz"))
    merged = _newest(before.unionByName(new), n).withColumns(
        {
            "batch_id": F.lit(batch_id).cast("bigint"),
            "run_id": F.lit(run),
            "slot": F.lit(batch_id % 2),
        }
    )
    write_partitioned(merged, f"{out_dir}/latest", ["run_id", "slot"], only_present=True)


def read_live_latest(spark: SparkSession, out_dir: str, n: int = 15) -> DataFrame:
    """The newest ticks over all runs, each as its last batch left it."""
    stored = table_or_empty(spark, f"{out_dir}/latest", _STORED, "parquet")
    last = stored.groupBy("run_id").agg(F.max("batch_id").alias("batch_id"))
    columns = ["tick_ts", "sales", "inventory", "store_id"]
    return _newest(stored.join(last, ["run_id", "batch_id"], "left_semi"), n).select(*columns)


def stream_live_ticks(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    checkpoint: str,
    trigger: dict | None = None,
    n: int = 15,
    growing: bool = False,
) -> StreamingQuery:
    """Keep the newest ``n`` ticks of the files in ``in_dir``, refreshed every second.

    If ``growing``, ``in_dir`` names the one file that the ticks are appended to.
    """

    def write(ticks: DataFrame, batch_id: int) -> None:
        _merge_batch(ticks, batch_id, out_dir, run_id(ticks.sparkSession, checkpoint), n)

    return (
        _tick_stream(spark, in_dir, growing)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )


def stream_tick_series(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    checkpoint: str,
    trigger: dict | None = None,
    growing: bool = False,
) -> StreamingQuery:
    """Append time and sales of every tick, for the chart; see ``stream_live_ticks``."""
    return (
        tick_series(_tick_stream(spark, in_dir, growing))
        .writeStream.format("parquet")
        .option("path", f"{out_dir}/series")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )
