"""The batch run: raw files → cleaned hub → quality report."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.functions import parse_timestamp
from martlet.operators import customers, quality, sales, web
from martlet.schemas import HUB_TABLES
from martlet.session import materialise, scratch
from martlet.sources.sinks import write_partitioned, write_quality_log, write_table
from martlet.sources.tables import arrival_columns, load_star, table_or_empty
from martlet.sources.web import no_web_lines, read_web_lines, unreadable_files

_SOLD_AT = "_sold_at"
_READ_AGAIN = ["dim_customers", "fact_sales", "fact_inventory"]


def process_dimensions(raw: dict[str, DataFrame], hub: str) -> None:
    """Stores and products as they are; customers with their history flags."""
    flagged = customers.scd2_flag(customers.parse_updates(raw["dim_customers"]))
    ordered = flagged.orderBy("customer_id", F.desc("update_timestamp"))
    side_by_side(
        flagged.sparkSession,
        lambda: write_table(raw["dim_stores"], f"{hub}/dim_stores"),
        lambda: write_table(raw["dim_products"], f"{hub}/dim_products"),
        lambda: write_table(ordered, f"{hub}/dim_customers"),
    )


def process_facts(raw: dict[str, DataFrame], hub: str) -> None:
    """Sales by year and month, inventory with no negative stock, shipments as they are.

    Sales whose date cannot be read go to ``quarantine_sales``.
    """
    lines = raw["fact_sales"]
    if _SOLD_AT not in lines.columns:
        lines = with_sale_times(lines)
    cleaned = sales.clean_sales(lines)
    dated = cleaned.where(F.col(_SOLD_AT).isNotNull())
    times = dated.withColumn("transaction_date", F.col(_SOLD_AT)).drop(_SOLD_AT)
    undated = cleaned.where(F.col(_SOLD_AT).isNull()).drop(_SOLD_AT)

    def day(column: str):
        return F.to_date(parse_timestamp(F.col(column)))

    stock = sales.floor_inventory(raw["fact_inventory"])
    restocked = stock.withColumn("last_restock_date", day("last_restock_date"))
    shipped = raw["fact_shipments"].withColumn("shipment_date", day("shipment_date"))
    side_by_side(
        lines.sparkSession,
        lambda: write_partitioned(
            sales.with_partition_keys(times), f"{hub}/fact_sales", ["year", "month"]
        ),
        lambda: write_table(undated, f"{hub}/quarantine_sales"),
        lambda: write_table(restocked, f"{hub}/fact_inventory"),
        lambda: write_table(shipped, f"{hub}/fact_shipments"),
    )


def with_sale_times(raw_sales: DataFrame) -> DataFrame:
    """Raw sales with their parsed time beside the text, null where it cannot be read."""
    return raw_sales.withColumn(_SOLD_AT, parse_timestamp(F.col("transaction_date")))


def side_by_side(spark: SparkSession, *steps: Callable[[], object]) -> list:
    """Run steps that do not need each other at the same time, so that none waits for a slow task.

    The first fault is raised once all have ended. The session is given, as a thread that such a
    step runs in has no active one.
    """
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inherit(step)) for step in steps]
    return [step.result() for step in running]


def process_web_logs(split: DataFrame, hub: str, dedup: str = "exact") -> None:
    """Events by day; unreadable timestamps and bad lines go to quarantine as they came.

    Every line is then an event, a copy of one, an event without customer, or in quarantine.
    """
    events = web.events_of(split).withColumns(
        {"timestamp_text": F.col("timestamp"), "source_file": F.col("_file")}
    )
    cleaned = web.clean_web_events(events, arrival_columns(), dedup)
    dated = web.dated_events(cleaned).drop("timestamp_text", "source_file")
    undated = web.undated_events(cleaned).drop("timestamp", "event_date")
    bad = web.bad_of(split).select("value", "_file")
    side_by_side(
        split.sparkSession,
        lambda: write_partitioned(dated, f"{hub}/fact_web_events", ["event_date"]),
        lambda: write_table(undated, f"{hub}/quarantine_web_events"),
        lambda: write_table(bad, f"{hub}/quarantine_web_lines"),
    )


def split_web_logs(spark: SparkSession, path: str, hub: str) -> tuple[DataFrame, list[str]]:
    """Lines of all files that can be read, parsed once, and the paths of the other files.

    Nothing of a damaged file is taken, as what is missing of it cannot be known; its path goes
    to ``quarantine_web_files``.
    """
    lost: list[str] = []
    try:
        split = materialise(web.split_lines(read_web_lines(spark, path)))
    except (PySparkException, Py4JJavaError):
        readable, lost = unreadable_files(spark, path)
        if not lost:
            raise
        lines = read_web_lines(spark, readable) if readable else no_web_lines(spark)
        split = materialise(web.split_lines(lines))
    files = spark.createDataFrame([(name,) for name in lost], "path STRING")
    write_table(files, f"{hub}/quarantine_web_files")
    return split, lost


def run_etl(
    spark: SparkSession, raw_dir: str, hub: str, log_dir: str, run_ts: str
) -> DataFrame:
    """The whole run; returns the quality report, which is also written to ``log_dir``.

    Text files that several steps read are parsed once and go on as Parquet, sale times included.
    """
    raw, orphans = load_star(spark, raw_dir)
    raw["fact_sales"] = with_sale_times(raw["fact_sales"])
    with scratch(spark) as held:
        (split, lost), *read = side_by_side(
            spark,
            lambda: split_web_logs(spark, f"{raw_dir}/stream/*.json*", hub),
            *[partial(materialise, raw[name]) for name in _READ_AGAIN],
        )
        held += [split, *read]
        raw |= zip(_READ_AGAIN, read)
        side_by_side(
            spark,
            lambda: process_dimensions(raw, hub),
            lambda: process_facts(raw, hub),
            lambda: process_web_logs(split, hub),
        )
        events = web.events_of(split)
        report = (
            quality.quality_report(
                customers=spark.read.parquet(f"{hub}/dim_customers"),
                sales=raw["fact_sales"],
                inventory=raw["fact_inventory"],
                events=events,
                bad_lines=web.bad_of(split),
                unfit=web.unfit_values_of(split),
                unreadable_files=len(lost),
            )
            .unionByName(orphan_rows(orphans))
            .unionByName(new_field_rows(split))
            .unionByName(web_run_rows(split, events, hub))
        )
        write_quality_log(report, log_dir, run_ts)
    return spark.read.parquet(f"{log_dir}/quality_report")


def orphan_rows(orphans: DataFrame) -> DataFrame:
    """The orphans of the sales as rows of the quality report."""
    return orphans.select(
        F.lit("fact_sales").alias("source"),
        F.col("check_type").alias("check"),
        F.lit("keep row").alias("action"),
        F.col("count").alias("affected"),
    )


def web_run_rows(lines: DataFrame, events: DataFrame, hub: str) -> DataFrame:
    """What became of the web logs: the events saved, or why there are none."""
    seen = (
        lines.select(F.lit(1).alias("_line"))
        .unionByName(events.select(F.lit(1).alias("_event")), allowMissingColumns=True)
        .agg(F.count("_line").alias("_lines"), F.count("_event").alias("_events"))
    )
    saved = table_or_empty(
        lines.sparkSession, f"{hub}/fact_web_events", HUB_TABLES["fact_web_events"], "parquet"
    ).agg(F.count(F.lit(1)).alias("affected"))

    def row(counted: DataFrame, check, action) -> DataFrame:
        return counted.select(
            F.lit("fact_web_events").alias("source"),
            check.alias("check"),
            action.alias("action"),
            "affected",
        )

    reason = F.when(F.col("_lines") == 0, "no web log files found").when(
        F.col("_events") == 0, "no valid web events"
    )
    nothing = seen.where(reason.isNotNull()).withColumn("affected", F.lit(0).cast("bigint"))
    return row(saved, F.lit("events in hub"), F.lit("save")).unionByName(
        row(nothing, reason, F.lit("skip step"))
    )


def new_field_rows(split: DataFrame) -> DataFrame:
    """One report row per undeclared field."""
    return web.new_fields_of(split).select(
        F.lit("fact_web_events").alias("source"),
        F.concat(F.lit("unexpected field "), F.col("field")).alias("check"),
        F.lit("keep in extra").alias("action"),
        F.lit(0).cast("bigint").alias("affected"),
    )
