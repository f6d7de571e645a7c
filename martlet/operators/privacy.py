"""Masked views and who sees which view. A convenience for analysts, not a security boundary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.functions import mask_email, mask_name

# View name prefixes each role may read.
ROLE_PREFIXES = {
    "analyst": ("secure_", "analytics_"),
    "admin": ("raw_", "secure_", "analytics_"),
}


def secure_customers(customers: DataFrame, strict: bool = False) -> DataFrame:
    return customers.select(
        "customer_id",
        "name",
        "city",
        "update_timestamp",
        "is_current",
        mask_email(F.col("email"), strict).alias("email"),
        F.lit("MASKED").alias("privacy_status"),
    )


def secure_customers_extended(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id",
        mask_name(F.col("name")).alias("name"),
        "city",
        mask_email(F.col("email")).alias("email"),
    )


def preview(view: DataFrame, n: int = 3) -> DataFrame:
    """A look at who is in a customer view, as the role that reads it sees them."""
    return view.select("customer_id", "name", "email").orderBy("customer_id", "name", "email").limit(n)


def visible_views(role: str, views: dict[str, DataFrame]) -> dict[str, DataFrame]:
    if role not in ROLE_PREFIXES:
        raise ValueError(f"unknown role: {role}")
    return {name: df for name, df in views.items() if name.startswith(ROLE_PREFIXES[role])}
