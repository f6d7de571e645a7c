"""The hub: cleaned tables on disk, and the views that name them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martlet.operators.privacy import secure_customers, visible_views
from martlet.plans.metrics import sales_performance, web_engagement
from martlet.schemas import HUB_TABLES
from martlet.sources.sinks import append_audit
from martlet.sources.tables import table_or_empty

# The six raw views and the hub tables behind them.
RAW_VIEWS = {
    "raw_customers": "dim_customers",
    "raw_products": "dim_products",
    "raw_stores": "dim_stores",
    "raw_sales": "fact_sales",
    "raw_inventory": "fact_inventory",
    "raw_web_events": "fact_web_events",
}


def hub_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All hub tables; one that is missing is empty but has its columns."""
    return {
        name: table_or_empty(spark, f"{folder}/{name}", schema, "parquet")
        for name, schema in HUB_TABLES.items()
    }


def register(views: dict[str, DataFrame]) -> None:
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def register_hub(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Hub tables as views, replaced when called again."""
    tables = hub_tables(spark, folder)
    register(tables)
    return tables


def raw_views(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {view: tables[table] for view, table in RAW_VIEWS.items()}


def gold_views(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Masked and analytics views over the hub tables."""
    return {
        "secure_customers": secure_customers(tables["dim_customers"]),
        "analytics_sales_performance": sales_performance(
            tables["fact_sales"], tables["dim_products"], tables["dim_stores"]
        ),
        "analytics_web_engagement": web_engagement(
            tables["fact_web_events"], tables["dim_products"]
        ),
    }


def register_raw_views(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    views = raw_views(hub_tables(spark, folder))
    register(views)
    return views


def views_for(spark: SparkSession, role: str, folder: str) -> SparkSession:
    """A session in which only the views of ``role`` are registered."""
    session = spark.newSession()
    tables = hub_tables(session, folder)
    register(visible_views(role, {**raw_views(tables), **gold_views(tables)}))
    return session


def audited_query(
    spark: SparkSession, role: str, folder: str, query: str, user_id: str, audit: str, at: str
) -> DataFrame:
    """Run a query on the views of ``role`` and record each view that it reads.

    The record is written before the result is returned; a query on views the role does not
    see fails and leaves none.
    """
    result = views_for(spark, role, folder).sql(query)
    for view in views_read(result):
        append_audit(spark, audit, at, user_id, query, view)
    return result


def views_read(df: DataFrame) -> list[str]:
    """Names of the views in the analysed plan, those behind other views included.

    What only stands in a literal, an alias or a comment is in no plan; views in subqueries and
    common table expressions are.
    """
    found, open_nodes = set(), [df._jdf.queryExecution().analyzed()]
    while open_nodes:
        node = open_nodes.pop()
        if node.nodeName() == "View":
            found.add(node.desc().identifier().table())
        for below in (node.children(), node.subqueries()):
            open_nodes += [below.apply(i) for i in range(below.size())]
    return sorted(found)


def list_tables(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW TABLES")
