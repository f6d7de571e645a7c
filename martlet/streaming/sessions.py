"""Visits and store windows as streams: each row is written once, when its time has passed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from martlet import schemas
from martlet.operators import web
from martlet.operators.sales import clean_sales, parse_sale_dates
from martlet.operators.sessions import store_windows, web_sessions, with_event_time


def _append(rows: DataFrame, out_dir: str, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    """Write rows as they are final. The sink's log makes a batch that is run again count once."""
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "30 seconds"}))
        .start()
    )


def stream_web_sessions(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    checkpoint: str,
    trigger: dict | None = None,
    gap: str = "30 minutes",
    delay: str = "10 minutes",
) -> StreamingQuery:
    """Visits of the event files in ``in_dir``; events over ``delay`` late are not counted.

    A visit is written when the watermark is ``gap`` behind its last event. Copies of an event
    are known for ``delay`` of event time.
    """
    lines = (
        spark.readStream.format("text").option("pathGlobFilter", "*.json").load(in_dir)
    ).select("value")
    events = web.parse_event_time(web.parse_events(lines))
    timed = with_event_time(events, "timestamp", delay)
    once = timed.dropDuplicates(["customer_id", "session_id", "event_type", "event_time"])
    return _append(web_sessions(once, gap), out_dir, checkpoint, trigger)


def stream_store_windows(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    checkpoint: str,
    trigger: dict | None = None,
    length: str = "1 hour",
    slide: str | None = None,
    delay: str = "10 minutes",
) -> StreamingQuery:
    """Store windows over the raw sales files (CSV with a header) in ``in_dir``."""
    raw = spark.readStream.schema(schemas.RAW_SALES).option("header", True).csv(in_dir)
    sales = clean_sales(parse_sale_dates(raw))
    timed = with_event_time(sales, "transaction_date", delay)
    return _append(store_windows(timed, length, slide), out_dir, checkpoint, trigger)
