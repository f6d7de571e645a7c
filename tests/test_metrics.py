from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martlet.plans import metrics

START, END = date(2024, 1, 1), date(2024, 12, 31)
SALE = (
    "transaction_id STRING, customer_id BIGINT, product_id STRING, quantity INT, "
    "unit_price DECIMAL(10,2), store_id STRING, transaction_date TIMESTAMP_NTZ"
)


def sale(transaction, customer, product, quantity, price, when=datetime(2024, 3, 5, 9), store="s1"):
    return (transaction, customer, product, quantity, Decimal(price), store, when)


@pytest.fixture
def sales(frame):
    return frame(
        SALE,
        sale("t1", 1, "p1", 2, "10.00"),
        sale("t1", 1, "p2", 1, "5.00"),
        sale("t2", 1, "p1", 1, "10.00", datetime(2024, 4, 1)),
        sale("t3", 2, "p3", 4, "2.50", datetime(2023, 3, 1)),
        sale("t4", 2, "p3", 4, "2.50"),
        sale("t5", None, "p4", 1, "1.00", store="s9"),
        sale("t6", None, "p4", 1, "1.00"),
        sale("t7", 3, "p4", 1, "7.00", datetime(2024, 12, 31, 10)),
    )


@pytest.fixture
def customers(frame):
    return frame(
        "customer_id BIGINT, name STRING, city STRING, is_current BOOLEAN",
        (1, "Asha", "Pune", False),
        (1, "Asha", "Goa", True),
        (2, "Ravi", "Goa", True),
        (4, "Nobody", "Agra", True),
    )


@pytest.fixture
def products(frame):
    return frame(
        "product_id STRING, description STRING, base_price DECIMAL(10,2), category STRING",
        ("p1", "lamp", Decimal(10), "home"),
        ("p2", "cup", Decimal(5), "home"),
        ("p3", "lamp", Decimal(3), "home"),
        ("p4", None, Decimal(1), "toys"),
    )


def test_kpis(sales, rows):
    got = metrics.kpi_summary(sales, START, END).first()
    assert (got.total_rev, got.total_orders) == (Decimal("47.00"), 5)
    assert got.avg_order_val == pytest.approx(47 / 6)
    assert metrics.kpi_summary(sales, START, END, end_inclusive_day=True).first().total_orders == 6
    empty = date(2030, 1, 1)
    assert rows(metrics.kpi_summary(sales, empty, empty)) == [(None, 0, None)]


def test_kpi_delta(sales):
    got = metrics.kpi_delta(sales, date(2024, 1, 1), date(2024, 12, 31)).first()
    assert got.total_rev_pct == pytest.approx(440.0)
    assert got.total_orders_pct == pytest.approx(500.0)
    alone = metrics.kpi_delta(sales, date(2023, 1, 1), date(2023, 12, 31)).first()
    assert alone.total_rev_pct is None


def test_kpi_cards(sales, frame):
    delivery = frame("delivery_time_days INT", (3,), (4,))
    cards = metrics.kpi_cards(
        metrics.kpi_summary(sales, START, END), metrics.avg_delivery_days(delivery)
    )
    assert {r.label: r.value for r in cards.collect()} == {
        "Total Revenue": "₹47.00",
        "Order Volume": "5",
        "Avg. Order Value": "₹7.83",
        "Avg. Delivery Time": "3.5 Days",
    }
    none = metrics.avg_delivery_days(delivery.where("false"))
    empty = metrics.kpi_summary(sales.where("false"), START, END)
    assert [r.value for r in metrics.kpi_cards(empty, none).collect()] == ["N/A", "0", "N/A", "N/A"]


def test_trends(sales):
    daily = metrics.daily_revenue(sales, START, END).collect()
    assert [(str(r.sale_date), r.daily_revenue) for r in daily] == [
        ("2024-03-05", Decimal("37.00")),
        ("2024-04-01", Decimal("10.00")),
    ]
    monthly = metrics.monthly_revenue(sales, START, END).collect()
    assert [(r.sale_month, r.monthly_orders) for r in monthly] == [("2024-03", 4), ("2024-04", 1)]
    seasons = metrics.seasonal_demand(sales, date(2023, 1, 1), END).collect()
    assert [tuple(r) for r in seasons] == [
        ("March", 3, 13, Decimal("47.00")),
        ("April", 4, 1, Decimal("10.00")),
    ]


def test_city_sales_counts_each_version(sales, customers):
    every = metrics.city_sales(sales, customers, START, END).collect()
    assert [tuple(r) for r in every] == [("Goa", Decimal("45.00")), ("Pune", Decimal("35.00"))]
    current = metrics.city_sales(sales, customers, START, END, current_only=True).collect()
    assert [tuple(r) for r in current] == [("Goa", Decimal("45.00"))]
    assert len(metrics.city_sales(sales, customers, START, END, n=1).collect()) == 1


def test_shopper_type(sales, rows):
    assert rows(metrics.shopper_type(sales, START, END)) == [("New", 1), ("Returning", 2)]


def test_top_products_merge_by_description(sales, products):
    top = metrics.top_products(sales, products, START, END)
    assert [tuple(r) for r in top.collect()] == [
        ("lamp", 7, Decimal("40.00")),
        ("cup", 1, Decimal("5.00")),
        (None, 2, Decimal("2.00")),
    ]
    units = metrics.top_products(sales, products, START, END, by="units").collect()
    assert [r.units_sold for r in units] == [7, 2, 1]
    with pytest.raises(KeyError):
        metrics.top_products(sales, products, START, END, by="revenue; DROP")


def test_top_products_equal_the_row_level_join_on_repeated_products(sales, products):
    doubled = products.unionByName(products.where("product_id = 'p1'"))
    top = metrics.top_products(sales, doubled, START, END).first()
    plain = (
        sales.where("year(transaction_date) = 2024 and quantity > 0")
        .join(doubled, "product_id")
        .where("description = 'lamp'")
        .selectExpr("sum(quantity) u", "sum(quantity * unit_price) r")
        .first()
    )
    assert (top.units_sold, top.revenue) == (plain.u, plain.r)


def test_top_products_table(frame):
    top = frame("product_name STRING, units_sold BIGINT, revenue DECIMAL(38,2)", ("x" * 50, 3, Decimal("1234.50")))
    assert tuple(metrics.top_products_table(top).first()) == ("x" * 40, 3, "₹1,234.50")


def test_clv_and_leaderboard(sales, customers):
    every = metrics.customer_clv(sales, customers, START, END).collect()
    assert [(r.name, round(r.clv_score, 6)) for r in every] == [
        ("Asha", 35.0),
        ("Asha", 35.0),
        ("Ravi", 15.0),
    ]
    current = metrics.customer_clv(sales, customers, START, END, current_only=True)
    assert [r.name for r in current.collect()] == ["Asha", "Ravi"]
    board = metrics.clv_leaderboard(metrics.customer_clv(sales, customers, START, END, n=2))
    assert [(r.rank, r.medal, r.expected_value) for r in board.collect()] == [
        (1, "🥇", "₹35"),
        (2, "🥈", "₹35"),
    ]


def test_views_keep_unmatched_rows(sales, products, frame):
    stores = frame("store_id STRING, store_name STRING, city STRING", ("s1", "Hub", "Pune"))
    view = metrics.sales_performance(sales, products.where("product_id <> 'p4'"), stores)
    assert view.count() == 8
    assert view.columns == [
        "transaction_id",
        "transaction_date",
        "product_name",
        "category",
        "store_name",
        "store_city",
        "quantity",
        "unit_price",
        "total_revenue",
    ]
    assert view.where("transaction_id = 't5'").first().store_city is None
    events = frame(
        "session_id STRING, customer_id INT, event_type STRING, event_date DATE, device_type STRING, "
        "referrer STRING, product_id STRING, promo_code STRING",
        ("a", 1, "search", START, "mobile", "direct", None, None),
        ("b", 1, "page_view", START, "mobile", "direct", "p1", None),
    )
    got = metrics.web_engagement(events, products).collect()
    assert {r.session_id: r.product_category for r in got} == {"a": None, "b": "home"}


def test_inventory(sales, frame, rows):
    inventory = frame("store_id STRING, product_id STRING, stock_on_hand INT", ("s1", "p1", 4), ("s1", "p2", 8), ("s2", "p1", None))
    got = metrics.inventory_turnover(sales, inventory, START, END).first()
    assert got.turnover_ratio == pytest.approx(10 / 6)
    none = metrics.inventory_turnover(sales, inventory.where("false"), START, END)
    assert none.first().turnover_ratio is None
    assert rows(metrics.inventory_by_store(inventory)) == [("s1", 2, 12, 6.0), ("s2", 1, None, None)]


def test_inventory_is_dealt_to_all_partitions(frame):
    """Also where the rows lie by store and product already."""
    lines = frame("store_id BIGINT, product_id BIGINT, stock INT", (1, 1, 4), (1, 2, 8), (2, 1, None))
    inventory = lines.groupBy("store_id", "product_id").agg(F.sum("stock").alias("stock_on_hand"))
    plan = metrics.inventory_by_store(inventory)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan


def test_profile_and_counts(sales, products, rows):
    got = {r.column_name: r for r in metrics.profile(sales, ["quantity", "unit_price"]).collect()}
    assert got["quantity"]["count"] == 8 and got["quantity"]["max"] == 4.0
    assert got["unit_price"]["null_count"] == 0
    assert rows(metrics.table_counts({"a": sales, "b": products})) == [("a", 8), ("b", 4)]
    assert rows(metrics.category_distribution(products)) == [("home", 3, 6.0), ("toys", 1, 1.0)]
    check = metrics.revenue_validation(sales).first()
    assert (check.total_transactions, check.total_revenue) == (8, Decimal("64.00"))


def test_period_skips_folders(spark, sales, tmp_path):
    from martlet.operators.sales import in_period, with_partition_keys
    from martlet.sources.sinks import write_partitioned

    write_partitioned(with_partition_keys(sales), str(tmp_path / "s"), ["year", "month"])
    table = spark.read.parquet(str(tmp_path / "s"))
    picked = in_period(table, date(2024, 3, 1), date(2024, 3, 31))
    assert len(picked.inputFiles()) >= 4
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "month" in plan
    assert picked.count() == 5
