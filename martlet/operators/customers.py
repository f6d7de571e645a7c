"""Customer history: slowly changing dimension, type 2."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlet.functions import parse_timestamp
from martlet.operators.asof import with_version_at
from martlet.operators.skew import with_group_max

ATTRIBUTES = ["name", "email", "city"]


def parse_updates(raw: DataFrame) -> DataFrame:
    return raw.withColumn("update_timestamp", parse_timestamp(F.col("update_timestamp")))


def scd2_flag(customers: DataFrame) -> DataFrame:
    """Add is_current and valid_from.

    A version is current when its timestamp equals the customer's latest one, so versions
    that tie are all current, and a version without a timestamp has no flag.
    """
    latest = with_group_max(customers, "customer_id", "update_timestamp", "_latest")
    return (
        latest.withColumn("is_current", F.col("update_timestamp") == F.col("_latest"))
        .withColumn("valid_from", F.col("update_timestamp"))
        .drop("_latest")
    )


def scd2_history_count(flagged: DataFrame) -> DataFrame:
    """Number of historical versions; a version without a flag is not counted."""
    return flagged.agg(F.count_if(~F.col("is_current")).alias("historical_records"))


def scd2_current(flagged: DataFrame) -> DataFrame:
    return flagged.where("is_current")


def scd2_history(flagged: DataFrame, customer_id=None) -> DataFrame:
    """Versions newest first, of one customer or, without an id, of each customer."""
    if customer_id is not None:
        flagged = flagged.where(F.col("customer_id") == F.lit(customer_id))
    return flagged.orderBy("customer_id", F.desc("update_timestamp"))


def scd2_versions(customers: DataFrame) -> DataFrame:
    """Customers with more than one version."""
    return (
        customers.groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("versions"))
        .where("versions > 1")
    )


def scd2_check(flagged: DataFrame) -> DataFrame:
    """Current rows against distinct customers; ties make the check fail."""
    return flagged.agg(
        F.count_if("is_current").alias("current_rows"),
        F.count_distinct("customer_id").alias("customers"),
    ).withColumn("ok", F.col("current_rows") == F.col("customers"))


def scd2_merge(flagged: DataFrame, incoming: DataFrame) -> DataFrame:
    """Put changed records into the history in the order of their time.

    ``incoming`` has customer_id, name, email, city and update_timestamp, in any number per
    customer and in any order. A record that equals the version before it changes nothing, so
    a move, a move back and a repeated feed come out right; stored versions always stay. Every
    version ends where the customer's next later one begins. As in ``scd2_flag``, versions that
    tie for the latest time are all current, and one without a time has no flag.
    """
    columns = ["customer_id", *ATTRIBUTES, "update_timestamp"]
    marked = [
        df.select(*columns, F.lit(stored).alias("_stored"))
        for df, stored in ((flagged, True), (incoming, False))
    ]
    records = marked[0].unionByName(marked[1]).groupBy(*columns).agg(F.max("_stored").alias("_stored"))
    history = Window.partitionBy("customer_id").orderBy(
        "update_timestamp", F.desc("_stored"), *ATTRIBUTES
    )
    attributes = F.struct(*ATTRIBUTES)
    changed = ~attributes.eqNullSafe(F.lag(attributes).over(history))
    versions = records.withColumn("_keep", F.col("_stored") | changed).where("_keep")
    # Of versions that share a time, the last one sees when the next time begins.
    following = F.lead("update_timestamp").over(history)
    later = F.when(following > F.col("update_timestamp"), following)
    tied = Window.partitionBy("customer_id", "update_timestamp")
    latest = F.max("update_timestamp").over(Window.partitionBy("customer_id"))
    return (
        versions.withColumn("_next", later)
        .withColumn("valid_to", F.max("_next").over(tied))
        .withColumn("is_current", F.col("update_timestamp") == latest)
        .select(*columns, F.col("update_timestamp").alias("valid_from"), "valid_to", "is_current")
    )


def customer_at_sale(sales: DataFrame, versions: DataFrame) -> DataFrame:
    """Every sale with the name, email and city that its customer had at that time.

    They are null for sales before the customer's first version.
    """
    return with_version_at(
        sales,
        versions,
        key="customer_id",
        time="transaction_date",
        valid_from="update_timestamp",
        columns=ATTRIBUTES,
    )
