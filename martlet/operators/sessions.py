"""Sessions and windows of event time, the same for tables and for streams.

A stream needs a watermark (``with_event_time``): its state for a session or window goes when
the watermark has passed, and only then is the row given out, once. Rows later than that are
not counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.operators.sales import revenue

# The steps of the funnel, in order.
FUNNEL = ["page_view", "add_to_cart", "checkout_start", "checkout_completed"]


def with_event_time(rows: DataFrame, time: str, delay: str | None = None) -> DataFrame:
    """The rows with ``event_time`` as Spark's windows want it; ``delay`` sets a watermark.

    Wall clock times are read in the session's time zone; rows without a time go.
    """
    timed = rows.withColumn("event_time", F.col(time).cast("timestamp"))
    timed = timed.where(F.col("event_time").isNotNull())
    return timed.withWatermark("event_time", delay) if delay else timed


def web_sessions(events: DataFrame, gap: str = "30 minutes", by: str = "customer_id") -> DataFrame:
    """One row per visit: events of one ``by``, each at most ``gap`` after the one before it.

    ``started, ended`` (of its first and last event), ``events``, the events of each step of the
    funnel, the ``furthest`` step (null if none), and ``revenue``, the values of completed
    checkouts. Events without ``by`` belong to no visit. ``events`` has ``event_time``.
    """
    kind = F.col("event_type")
    steps = {step: F.count_if(kind == step) for step in FUNNEL}
    reached = F.max(
        F.coalesce(*[F.when(kind == step, F.lit(place)) for place, step in enumerate(FUNNEL, 1)])
    )
    sold = F.when(kind == FUNNEL[-1], F.col("total_value"))
    visits = (
        events.where(F.col(by).isNotNull())
        .groupBy(by, F.session_window("event_time", gap).alias("_session"))
        .agg(
            F.min("event_time").alias("started"),
            F.max("event_time").alias("ended"),
            F.count(F.lit(1)).alias("events"),
            *[count.alias(step) for step, count in steps.items()],
            reached.alias("_reached"),
            F.coalesce(F.sum(sold), F.lit(0.0)).alias("revenue"),
        )
    )
    furthest = F.when(
        F.col("_reached").isNotNull(),
        F.element_at(F.array(*map(F.lit, FUNNEL)), F.col("_reached")),
    )
    return visits.select(
        by, "started", "ended", "events", *FUNNEL, furthest.alias("furthest"), "revenue"
    )


def session_funnel(sessions: DataFrame) -> DataFrame:
    """Per step of the funnel: visits that had it, and their share of the visits of step one."""
    counts = sessions.agg(*[F.count_if(F.col(step) > 0).alias(step) for step in FUNNEL])
    rows = F.array(
        *[
            F.struct(
                F.lit(place).alias("place"),
                F.lit(step).alias("step"),
                F.col(step).alias("sessions"),
                F.try_divide(F.col(step), F.col(FUNNEL[0])).alias("conversion"),
            )
            for place, step in enumerate(FUNNEL, 1)
        ]
    )
    return counts.select(F.inline(rows))


def store_windows(sales: DataFrame, length: str = "1 day", slide: str | None = None) -> DataFrame:
    """Sales per store and window of event time: ``window_start, window_end, lines, units, revenue``.

    Windows tumble, or follow each other by ``slide`` and overlap; they are counted from
    1970-01-01. ``sales`` has ``event_time``.
    """
    return (
        sales.groupBy("store_id", F.window("event_time", length, slide).alias("_window"))
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.sum("quantity").alias("units"),
            F.sum(revenue()).alias("revenue"),
        )
        .select(
            "store_id",
            F.col("_window.start").alias("window_start"),
            F.col("_window.end").alias("window_end"),
            "lines",
            "units",
            "revenue",
        )
    )
