"""Web events as a stream of JSON-lines files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from martlet.operators import quality, web
from martlet.schemas import HUB_TABLES, WEB_EVENT_KEY, table
from martlet.session import run_id
from martlet.sources.sinks import write_partitioned
from martlet.sources.tables import arrival_columns, table_or_empty

_STORED = StructType(
    [
        *HUB_TABLES["fact_web_events"].fields,
        *table("timestamp_text STRING, run_id STRING, batch_id BIGINT").fields,
    ]
)
_OWNER = ["run_id", "batch_id"]


def dedup_stream(events: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """One event per key with bounded state: a copy is known for ``delay`` of event time.

    For streams that only feed live views. Which copy stays is not fixed, and events later
    than ``delay`` are not kept; the hub is fed by ``stream_web_events``, which keeps them.
    """
    timed = events.withColumn("_event_time", F.col("timestamp").cast("timestamp"))
    return (
        timed.withWatermark("_event_time", delay)
        .dropDuplicates([*WEB_EVENT_KEY, "_event_time"])
        .drop("_event_time")
    )


def read_stream_events(spark: SparkSession, out_dir: str) -> DataFrame:
    return table_or_empty(spark, f"{out_dir}/fact_web_events", _STORED, "parquet")


def read_stream_quality(spark: SparkSession, out_dir: str) -> DataFrame:
    return spark.read.parquet(f"{out_dir}/quality_report")


def _not_yet_stored(events: DataFrame, stored: DataFrame, dedup: str) -> DataFrame:
    keys = web.event_key(dedup, "timestamp_text")
    new = events.select("*", *[k.alias(f"_k{i}") for i, k in enumerate(keys)]).alias("n")
    old = stored.select(*[k.alias(f"_k{i}") for i, k in enumerate(keys)]).alias("o")
    same = F.lit(True)
    for i in range(len(keys)):
        same = same & F.col(f"n._k{i}").eqNullSafe(F.col(f"o._k{i}"))
    return new.join(old, same, "left_anti").select(*[f"n.{c}" for c in events.columns])


def _write_batch(lines: DataFrame, batch_id: int, out_dir: str, run: str, dedup: str) -> None:
    """Add one batch to the hub: the first event of each key the hub does not have yet.

    Each batch owns its sub-partitions, named by the run that its checkpoint stands for and by
    its number. So a batch that is run again replaces its own files, and another stream or a
    new checkpoint replaces nothing. What is no dated event goes to the quarantine tables.
    """
    spark = lines.sparkSession
    placed = lines.withColumn("_position", F.monotonically_increasing_id())
    split = web.split_lines(placed).persist()
    try:
        events = web.events_of(split).withColumns(
            {"timestamp_text": F.col("timestamp"), "source_file": F.col("_file")}
        )
        cleaned = web.clean_web_events(events, arrival_columns(), dedup)
        dated = web.dated_events(cleaned).drop("source_file")

        # The days of this batch, so that the scan of the hub reads their folders and no others.
        days = [row[0] for row in dated.select("event_date").distinct().collect()]
        own = (F.col("run_id") == run) & (F.col("batch_id") == batch_id)
        stored = read_stream_events(spark, out_dir).where(F.col("event_date").isin(days) & ~own)

        def write(df: DataFrame, name: str, *keys: str) -> None:
            owned = df.withColumns({"run_id": F.lit(run), "batch_id": F.lit(batch_id).cast("bigint")})
            write_partitioned(owned, f"{out_dir}/{name}", [*keys, *_OWNER], only_present=True)

        write(_not_yet_stored(dated, stored, dedup), "fact_web_events", "event_date")
        undated = web.undated_events(cleaned).drop("timestamp", "event_date")
        write(undated, "quarantine_web_events")
        write(web.bad_of(split).select("value", "_file"), "quarantine_web_lines")
        saved = read_stream_events(spark, out_dir).where(own)
        write(_batch_quality(split, events, dated, saved), "quality_report")
    finally:
        split.unpersist()


def _batch_quality(split: DataFrame, events: DataFrame, dated: DataFrame, saved: DataFrame) -> DataFrame:
    """The checks of the batch run, and how many events were new to the hub."""
    report = quality.quality_report(
        events=events, bad_lines=web.bad_of(split), unfit=web.unfit_values_of(split)
    )
    one, none = F.lit(1), F.lit(0)
    counts = (
        dated.select(one.alias("all"), none.alias("new"))
        .union(saved.select(none, one))
        .agg(F.coalesce(F.sum("all"), none).alias("all"), F.coalesce(F.sum("new"), none).alias("new"))
    )
    stored = F.array(
        F.struct(
            F.lit("fact_web_events").alias("source"),
            F.lit("events in hub").alias("check"),
            F.lit("save").alias("action"),
            F.col("new").alias("affected"),
        ),
        F.struct(
            F.lit("fact_web_events").alias("source"),
            F.lit("event already in hub").alias("check"),
            F.lit("keep first").alias("action"),
            (F.col("all") - F.col("new")).alias("affected"),
        ),
    )
    return report.unionByName(counts.select(F.inline(stored)))


def compact_stream_events(spark: SparkSession, out_dir: str, target: str) -> None:
    """Write the stored events to ``target`` with few files per day instead of one per batch.

    The copy reads like the original; put it in its place while no stream runs.
    """
    merged = read_stream_events(spark, out_dir).withColumns(
        {"run_id": F.lit("compacted"), "batch_id": F.lit(0).cast("bigint")}
    )
    write_partitioned(merged, f"{target}/fact_web_events", ["event_date", *_OWNER])


def stream_web_events(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    checkpoint: str,
    trigger: dict | None = None,
    dedup: str = "exact",
) -> StreamingQuery:
    """Clean new files of ``in_dir`` into the hub every 30 seconds, as the batch run would.

    ``checkpoint`` is a lasting folder of this stream alone. A file that cannot be read stops
    the stream; nothing is skipped.
    """
    files = (
        spark.readStream.format("text")
        .option("pathGlobFilter", "*.json")
        .load(in_dir)
        .select(
            "value",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
        )
    )

    def write(lines: DataFrame, batch_id: int) -> None:
        _write_batch(lines, batch_id, out_dir, run_id(lines.sparkSession, checkpoint), dedup)

    return (
        files.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "30 seconds"}))
        .start()
    )
