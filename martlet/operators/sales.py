"""Sales and inventory facts: cleaning, keys, periods, incremental loads, retention."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.functions import parse_timestamp


def clean_sales(raw: DataFrame) -> DataFrame:
    """Keep lines with a positive quantity and price; a missing value is not positive."""
    return raw.where((F.col("quantity") > 0) & (F.col("unit_price") > 0))


def sales_dropped(raw: DataFrame) -> DataFrame:
    """How many lines cleaning keeps and drops, counted in one pass."""
    kept = F.count_if((F.col("quantity") > 0) & (F.col("unit_price") > 0))
    return raw.agg(F.count(F.lit(1)).alias("initial_rows"), kept.alias("kept_rows")).withColumn(
        "dropped_rows", F.col("initial_rows") - F.col("kept_rows")
    )


def parse_sale_dates(raw: DataFrame) -> DataFrame:
    return raw.withColumn("transaction_date", parse_timestamp(F.col("transaction_date")))


def with_partition_keys(sales: DataFrame) -> DataFrame:
    """Year and month of the sale, the layout keys of the fact table."""
    return sales.withColumn("year", F.year("transaction_date")).withColumn(
        "month", F.month("transaction_date")
    )


def floor_inventory(raw: DataFrame) -> DataFrame:
    """Negative stock becomes 0; unknown stock stays unknown."""
    stock = F.col("stock_on_hand")
    return raw.withColumn("stock_on_hand", F.when(stock < 0, F.lit(0)).otherwise(stock))


def revenue() -> Column:
    return F.col("quantity") * F.col("unit_price")


def in_period(
    sales: DataFrame, start: date, end: date, end_inclusive_day: bool = False
) -> DataFrame:
    """Sales from ``start`` to ``end``.

    ``end`` means midnight at its start, so of the last day only 00:00:00 counts unless
    ``end_inclusive_day``. On a table laid out by year and month the period also bounds those
    keys, which lets the scan skip whole directories.
    """
    ts = F.col("transaction_date")
    low = F.lit(start).cast("timestamp_ntz")
    if end_inclusive_day:
        inside = (ts >= low) & (ts < F.lit(end + timedelta(days=1)).cast("timestamp_ntz"))
    else:
        inside = ts.between(low, F.lit(end).cast("timestamp_ntz"))
    if {"year", "month"} <= set(sales.columns):
        months = F.col("year") * 12 + F.col("month")
        inside = inside & months.between(
            start.year * 12 + start.month, end.year * 12 + end.month
        )
    return sales.where(inside)


def since(df: DataFrame, column: str, watermark: datetime) -> DataFrame:
    """Rows that came after the last load; on a table by year and month, of those folders only."""
    new = F.col(column) > F.lit(watermark.isoformat()).cast("timestamp_ntz")
    if column == "transaction_date" and {"year", "month"} <= set(df.columns):
        new = new & (F.col("year") * 12 + F.col("month") >= watermark.year * 12 + watermark.month)
    return df.where(new)


def next_watermark(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.max(column).alias("watermark"))


def purge(df: DataFrame, column: str, as_of: date, days: int = 90) -> DataFrame:
    """Rows that retention keeps: not older than ``days`` before ``as_of``; undated rows stay."""
    limit = F.lit(as_of - timedelta(days=days))
    return df.where(F.col(column).isNull() | (F.col(column) >= limit))


def forget(df: DataFrame, ids: DataFrame, key: str = "customer_id") -> DataFrame:
    """All rows but those of the customers to forget."""
    return df.join(ids.select(key).distinct(), key, "left_anti")
