"""Every operator as a named query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from martlet.checks.bindings import ARRIVAL, END, START, Tables
from martlet.operators import customers as cust
from martlet.operators import privacy, quality, retail, sales, web
from martlet.operators.customers import customer_at_sale
from martlet.operators.sessions import session_funnel, store_windows, web_sessions, with_event_time
from martlet.plans import basket, metrics
from martlet.schemas import SHIPMENT_STATES_DOCUMENTED
from martlet.session import materialise
from martlet.sources.hub import gold_views, raw_views
from martlet.streaming.ticks import live_latest, live_panel

# Parameters of the registered queries; the check's SQL has the lists a second time.
KEYWORDS = [("ring", "Jewellery"), ("bolt", "Hardware"), ("gear", "Hardware"), ("gizmo", "Toys")]
SUPPLIERS = {"Jewellery": "SUP001", "Hardware": "SUP002", "Toys": "SUP003", "Other": "SUP004"}
CITIES = {"NATION_0": "Mumbai", "NATION_1": "Delhi", "NATION_2": "Ahmedabad", "NATION_3": "Pune"}
RUN_TS = "2024-09-01 00:00:00"
WATERMARK = datetime(1998, 1, 1)
RETENTION_DAY = date(2024, 4, 15)
DELTA = (date(1998, 1, 1), date(1998, 12, 31))
MIN_SUPPORT = 0.002


def exact(df: DataFrame, digits: dict[str, int] | None = None) -> DataFrame:
    """Decimals as DOUBLE, and the named quotients rounded: what two engines can agree on."""
    digits = digits or {}
    columns = {
        field.name: F.col(field.name).cast("double")
        for field in df.schema
        if isinstance(field.dataType, DecimalType)
    }
    columns |= {name: F.round(name, places) for name, places in digits.items()}
    return df.withColumns(columns) if columns else df


def _event_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "session_id",
        "customer_id",
        "event_type",
        "timestamp",
        "device_type",
        "referrer",
        "product_id",
        "duration_seconds",
        "promo_code",
        "quantity",
        "transaction_id",
        "total_value",
    )


def _itemsets(t: Tables) -> DataFrame:
    return basket.frequent_itemsets(basket.basket_pairs(t.sales, t.brands), MIN_SUPPORT)


def _rules(t: Tables, metric: str = "lift", threshold: float = 1.0) -> DataFrame:
    return basket.rules_table(basket.association_rules(_itemsets(t), metric, threshold))


def _business(t: Tables) -> DataFrame:
    return basket.business_rules(_rules(t))


RULE_DIGITS = {"support": 9, "confidence": 9, "lift": 9}


def _role_views(t: Tables) -> DataFrame:
    views = {**raw_views(t.star), **gold_views(t.star)}
    parts = [
        metrics.table_counts(privacy.visible_views(role, views)).withColumn("role", F.lit(role))
        for role in privacy.ROLE_PREFIXES
    ]
    return parts[0].unionByName(parts[1])


def _parsed_event_times(t: Tables) -> DataFrame:
    events = web.parse_event_time(web.parse_events(t.web_lines))
    return events.select("event_id", "seq", "session_id", "timestamp", "event_date")


def _schema_evolution(t: Tables) -> DataFrame:
    extra = F.col("extra")
    return web.parse_events(t.web_lines).select(
        "event_id",
        "seq",
        "promo_code",
        F.try_element_at(extra, F.lit("campaign")).alias("campaign"),
        F.try_element_at(extra, F.lit("ab_test")).alias("ab_test"),
    )


def _quality(t: Tables) -> DataFrame:
    """The lines are parsed once, as in the batch run."""
    split = materialise(web.split_lines(t.web_lines))
    return quality.quality_report(
        t.customers,
        t.raw_sales,
        t.raw_inventory,
        web.events_of(split),
        web.bad_of(split),
        web.unfit_values_of(split),
    )


def _full_web(t: Tables) -> DataFrame:
    cleaned = web.clean_web_events(web.parse_events(t.web_lines), ARRIVAL)
    return web.dated_events(cleaned).drop("extra")


def _visits(t: Tables) -> DataFrame:
    return web_sessions(with_event_time(t.web_events, "timestamp"), "6 hours")


def _store_windows(t: Tables, *windows: str) -> DataFrame:
    found = exact(store_windows(with_event_time(t.sales, "transaction_date"), *windows))
    ends = {name: F.col(name).cast("timestamp_ntz") for name in ("window_start", "window_end")}
    return found.withColumns(ends)


def _names(t: Tables) -> DataFrame:
    name = F.replace("name", F.lit("#"), F.lit(" ")).alias("name")
    return t.first_customers.select("customer_id", name, F.col("city").alias("country"))


Query = Callable[[Tables], DataFrame]

QUERIES: dict[str, Query] = {
    # Sources and views
    "web_events_parse": lambda t: _event_columns(web.parse_events(t.web_lines)),
    "web_bad_lines": lambda t: web.bad_lines(t.web_lines).groupBy("value").agg(
        F.count(F.lit(1)).alias("bad_lines")
    ),
    "web_events_schema": _schema_evolution,
    "web_new_fields": lambda t: web.new_fields(t.web_lines),
    "raw_views_count": lambda t: metrics.table_counts(raw_views(t.star)),
    "quality_report": _quality,
    # Raw retail to star schema
    "retail_drop_null_customer": lambda t: exact(retail.drop_null_customers(t.retail)),
    "derive_dim_products": lambda t: exact(
        retail.derive_products(t.retail, ["invoice_date", "invoice_no", "line_no"])
    ),
    "derive_dim_customers": lambda t: retail.derive_customers(retail.drop_null_customers(t.retail)),
    "derive_fact_sales": lambda t: exact(
        retail.map_sales(retail.drop_null_customers(t.retail))
    ),
    "derive_shipment_keys": lambda t: retail.derive_shipments(t.raw_sales),
    "derive_shipment_texts": lambda t: retail.derive_shipments(t.invoice_texts),
    "line_transaction_id": lambda t: exact(
        retail.line_transaction_ids(t.retail, ["line_no", "stock_code", "quantity"])
    ),
    "retail_clean": lambda t: exact(retail.retail_clean(t.retail)),
    "standardize_description": lambda t: exact(
        retail.standardize_description(
            retail.derive_products(t.retail, ["invoice_date", "invoice_no", "line_no"])
        )
    ),
    "categorize_products": lambda t: exact(retail.categorize(t.products, KEYWORDS, SUPPLIERS)),
    "customer_enrich": lambda t: retail.enrich_customers(_names(t), CITIES, RUN_TS),
    "dedup_pk": lambda t: exact(
        retail.dedup_pk(
            t.raw_sales,
            ["transaction_id", "product_id"],
            ["quantity", "store_id", "customer_id", "unit_price"],
        )
    ),
    "customer_sample": lambda t: retail.sample_rows(t.raw_customers, 0.05, key="customer_id"),
    "product_sample": lambda t: exact(retail.sample_n(t.products, 100, ["product_id"])),
    "product_sample_by_category": lambda t: exact(
        retail.sample_n(t.products, 2, ["product_id"], by="category")
    ),
    # Customer history
    "scd2_customers": lambda t: t.customers,
    "scd2_history_count": lambda t: cust.scd2_history_count(t.customers),
    "scd2_current": lambda t: cust.scd2_current(t.customers),
    "scd2_history": lambda t: cust.scd2_history(t.customers),
    "scd2_versions": lambda t: cust.scd2_versions(t.raw_customers),
    "scd2_check": lambda t: cust.scd2_check(t.customers),
    "scd2_merge": lambda t: cust.scd2_merge(cust.scd2_flag(t.first_customers), t.customer_feed),
    # Facts
    "sales_clean": lambda t: exact(t.sales),
    "sales_dropped": lambda t: sales.sales_dropped(t.raw_sales),
    "sales_partition_keys": lambda t: exact(sales.with_partition_keys(t.sales)),
    "inventory_clean": lambda t: t.inventory,
    "web_null_customer": lambda t: _event_columns(web.drop_null_customers(t.raw_web_events)),
    "web_dedup": lambda t: _event_columns(web.dedup_events(t.raw_web_events, ARRIVAL)),
    "web_dedup_second": lambda t: _event_columns(
        web.dedup_events(t.raw_web_events, ARRIVAL, "second")
    ),
    "web_event_date": _parsed_event_times,
    "fact_web_events": _full_web,
    "web_sessions": lambda t: _visits(t).withColumns(
        {
            "started": F.col("started").cast("timestamp_ntz"),
            "ended": F.col("ended").cast("timestamp_ntz"),
            "revenue": F.round("revenue", 4),
        }
    ),
    "session_funnel": lambda t: exact(session_funnel(_visits(t)), {"conversion": 9}),
    "store_windows": lambda t: _store_windows(t, "7 days"),
    "store_windows_sliding": lambda t: _store_windows(t, "30 days", "10 days"),
    "incremental_sales": lambda t: exact(
        sales.since(sales.with_partition_keys(t.sales), "transaction_date", WATERMARK)
    ),
    "web_retention": lambda t: sales.purge(t.web_events, "event_date", RETENTION_DAY),
    "forget_customers": lambda t: exact(
        sales.forget(t.sales, cust.scd2_versions(t.raw_customers))
    ),
    # Business queries
    "kpi_summary": lambda t: exact(
        metrics.kpi_summary(t.sales, START, END), {"avg_order_val": 6}
    ),
    "kpi_summary_whole_days": lambda t: exact(
        metrics.kpi_summary(t.sales, START, END, end_inclusive_day=True), {"avg_order_val": 6}
    ),
    "kpi_delta": lambda t: metrics.kpi_delta(t.sales, *DELTA),
    "kpi_cards": lambda t: metrics.kpi_cards(
        metrics.kpi_summary(t.sales, START, END), metrics.avg_delivery_days(t.shipments)
    ),
    "avg_delivery_days": lambda t: exact(
        metrics.avg_delivery_days(t.shipments), {"avg_days": 6}
    ),
    "daily_revenue": lambda t: exact(metrics.daily_revenue(t.sales, START, END)),
    "monthly_revenue": lambda t: exact(metrics.monthly_revenue(t.sales, START, END)),
    "seasonal_demand": lambda t: exact(metrics.seasonal_demand(t.sales, START, END)),
    "city_sales": lambda t: exact(metrics.city_sales(t.sales, t.customers, START, END)),
    "city_sales_current": lambda t: exact(
        metrics.city_sales(t.sales, t.customers, START, END, current_only=True)
    ),
    "sales_asof_customer": lambda t: exact(customer_at_sale(t.sales, t.customer_history)),
    "city_sales_asof": lambda t: exact(
        metrics.city_sales_asof(t.sales, t.customer_history, START, END)
    ),
    "shopper_type": lambda t: metrics.shopper_type(t.sales, START, END),
    "top_products_revenue": lambda t: exact(
        metrics.top_products(t.sales, t.products, START, END)
    ),
    "top_products_units": lambda t: exact(
        metrics.top_products(t.sales, t.products, START, END, n=25, by="units")
    ),
    "top_products_table": lambda t: metrics.top_products_table(
        metrics.top_products(t.sales, t.products, START, END)
    ),
    "customer_clv": lambda t: exact(
        metrics.customer_clv(t.sales, t.customers, START, END), {"clv_score": 4}
    ),
    "customer_clv_current": lambda t: exact(
        metrics.customer_clv(t.sales, t.customers, START, END, current_only=True),
        {"clv_score": 4},
    ),
    "clv_leaderboard": lambda t: exact(
        metrics.clv_leaderboard(metrics.customer_clv(t.sales, t.customers, START, END)),
        {"clv_score": 4},
    ),
    "analytics_sales_performance": lambda t: exact(
        metrics.sales_performance(t.sales, t.products, t.stores)
    ),
    "analytics_web_engagement": lambda t: metrics.web_engagement(t.web_events, t.products),
    "revenue_validation": lambda t: exact(
        metrics.revenue_validation(t.sales), {"avg_transaction_value": 6}
    ),
    "inventory_turnover": lambda t: exact(
        metrics.inventory_turnover(t.sales, t.inventory, START, END), {"turnover_ratio": 6}
    ),
    "category_distribution": lambda t: exact(
        metrics.category_distribution(t.products), {"avg_price": 6}
    ),
    "inventory_by_store": lambda t: exact(
        metrics.inventory_by_store(t.inventory), {"avg_stock_per_product": 6}
    ),
    "table_counts": lambda t: metrics.table_counts(t.star),
    "profile_sales": lambda t: exact(
        metrics.profile(t.raw_sales, ["quantity", "unit_price"]), {"mean": 6, "stddev": 6}
    ),
    "profile_sales_table": lambda t: exact(
        metrics.profile_table(t.raw_sales), {"mean": 4, "stddev": 4}
    ),
    # Validation
    "orphan_report": lambda t: quality.orphan_report(
        t.raw_sales, cust.scd2_versions(t.raw_customers), t.products, t.stores
    ),
    "sales_quality": lambda t: quality.sales_quality(t.raw_sales),
    "sales_date_range": lambda t: quality.sales_date_range(t.sales),
    "constraint_report": lambda t: quality.star_constraint_report(
        {**t.star, "fact_sales": t.raw_sales, "dim_customers": t.raw_customers}
    ),
    "web_optional_counts": lambda t: quality.web_optional_counts(t.web_events),
    "shipment_status_check": lambda t: quality.shipment_status_check(
        t.shipments, SHIPMENT_STATES_DOCUMENTED
    ),
    # Privacy
    "secure_customers": lambda t: privacy.secure_customers(t.customers),
    "secure_customers_strict": lambda t: privacy.secure_customers(t.customers, strict=True),
    "secure_customers_extended": lambda t: privacy.secure_customers_extended(t.customers),
    "secure_preview": lambda t: privacy.preview(privacy.secure_customers(t.customers)),
    "role_views": _role_views,
    # Live ticks
    "live_latest": lambda t: live_latest(t.ticks),
    "live_panel": lambda t: live_panel(live_latest(t.ticks)),
    # Market basket
    "basket_pairs": lambda t: basket.basket_pairs(t.sales, t.products),
    "baskets": lambda t: basket.baskets(basket.basket_pairs(t.sales, t.products)).select(
        "transaction_id", F.array_join("items", ", ").alias("items")
    ),
    "frequent_itemsets": lambda t: exact(
        _itemsets(t).withColumn("items", F.array_join("items", ", ")), {"support": 9}
    ),
    "association_rules": lambda t: exact(_rules(t), RULE_DIGITS),
    "association_rules_confidence": lambda t: exact(_rules(t, "confidence", 0.1), RULE_DIGITS),
    "business_rules": lambda t: exact(_business(t), RULE_DIGITS),
    "rule_insights": lambda t: basket.rule_insights(_business(t)),
    "rule_recommendations": lambda t: basket.recommendations(_business(t)),
    "pairing_list": lambda t: basket.pairing_list(_business(t)),
}
