"""Readers of the raw files. Schemas are declared; bad values never fail a load."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from martlet import schemas
from martlet.functions import parse_timestamp
from martlet.operators.quality import orphan_report

_CORRUPT = "_corrupt_record"
_ARRIVAL = ["_file", "_block", "_position"]


def read_table(
    spark: SparkSession, path: str | list[str], schema: StructType, fmt: str = "csv"
) -> DataFrame:
    """A typed table from CSV with a header, or from Parquet or JSON lines."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)


def table_or_empty(spark: SparkSession, path: str, schema: StructType, fmt: str) -> DataFrame:
    """The table, or no rows of its schema where nothing was written yet."""
    try:
        return read_table(spark, path, schema, fmt)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def with_arrival(df: DataFrame) -> DataFrame:
    """Order of arrival of rows read from files: file, block in the file, position in the block."""
    return df.withColumns(
        {
            "_file": F.col("_metadata.file_path"),
            "_block": F.col("_metadata.file_block_start"),
            "_position": F.monotonically_increasing_id(),
        }
    )


def arrival_columns() -> list[str]:
    return list(_ARRIVAL)


def read_raw_retail(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Invoice lines from a CSV of any quality: (all lines, the damaged ones).

    Values that do not fit are null, short lines are filled with nulls and long ones cut. The
    damaged lines are also returned as they stood, for quarantine.
    """
    schema = StructType([*schemas.RAW_RETAIL.fields, StructField(_CORRUPT, StringType())])
    lines = (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .csv(path)
    )
    rows = with_arrival(lines).select(
        F.col("InvoiceNo").alias("invoice_no"),
        F.col("StockCode").alias("stock_code"),
        F.col("Description").alias("description"),
        F.col("Quantity").alias("quantity"),
        parse_timestamp(F.col("InvoiceDate")).alias("invoice_date"),
        F.col("UnitPrice").alias("unit_price"),
        F.col("CustomerID").alias("customer_id"),
        F.col("Country").alias("country"),
        *_ARRIVAL,
    )
    # Spark only sees damage in columns it parses, so the filter reads them all.
    every_column = F.concat_ws(",", *[F.col(f.name).cast("string") for f in schemas.RAW_RETAIL])
    damaged = lines.where(F.col(_CORRUPT).isNotNull() & (F.length(every_column) >= 0))
    return rows, damaged


# Load order, dimensions before the facts that refer to them.
_RAW_FILES = {
    "dim_customers": schemas.RAW_CUSTOMERS,
    "dim_products": schemas.HUB_TABLES["dim_products"],
    "dim_stores": schemas.HUB_TABLES["dim_stores"],
    "fact_sales": schemas.RAW_SALES,
    "fact_inventory": schemas.RAW_INVENTORY,
    "fact_shipments": schemas.RAW_SHIPMENTS,
}


def load_star(spark: SparkSession, folder: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """The raw star schema from one CSV per table, and its orphan report."""
    tables = {
        name: table_or_empty(spark, f"{folder}/{name}.csv", schema, "csv")
        for name, schema in _RAW_FILES.items()
    }
    report = orphan_report(
        tables["fact_sales"], tables["dim_customers"], tables["dim_products"], tables["dim_stores"]
    )
    return tables, report


def read_ticks(spark: SparkSession, path: str) -> DataFrame:
    """Live ticks: no header is expected, and a header line is dropped as not numeric."""
    raw = spark.read.schema(schemas.RAW_TICKS).csv(path)
    return parse_ticks(raw)


def parse_ticks(raw: DataFrame) -> DataFrame:
    """Typed ticks. The file has a time of day only, so it is read as a time of 1970-01-01."""
    clock = F.col("timestamp")
    dated = F.when(clock.rlike(r"^\d{1,2}:\d{2}:\d{2}$"), F.concat(F.lit("1970-01-01 "), clock))
    sales = F.col("sales").try_cast("int")
    return raw.where(sales.isNotNull()).select(
        F.coalesce(dated, clock).try_cast("timestamp_ntz").alias("tick_ts"),
        sales.alias("sales"),
        F.col("inventory").try_cast("int").alias("inventory"),
        "store_id",
    )
