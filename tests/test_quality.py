from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest

from martlet.operators import quality
from martlet.operators.quality import Rule


@pytest.fixture
def sales(frame):
    day, price = datetime(2011, 1, 1), Decimal("2.00")
    return frame(
        "transaction_id STRING, customer_id INT, product_id STRING, store_id STRING, quantity INT, "
        "unit_price DECIMAL(10,2), transaction_date TIMESTAMP_NTZ",
        ("t1", 1, "p1", "s1", 1, price, day),
        ("t1", 2, "p1", "s1", -1, price, day),
        ("t2", 9, "p9", "s1", 0, Decimal(0), day),
        ("t3", None, "p1", "s9", None, price, None),
        (None, 1, "p1", "s1", 2, price, day),
    )


@pytest.fixture
def dims(frame):
    return {
        "dim_customers": frame("customer_id INT, email STRING", (1, "a@x"), (1, "b@x"), (2, "a@x"), (3, None), (4, None)),
        "dim_products": frame("product_id STRING", ("p1",)),
        "dim_stores": frame("store_id STRING", ("s1",)),
    }


def test_orphans_count_rows(sales, dims, rows):
    got = rows(quality.orphan_report(sales, *dims.values()))
    assert got == [("Orphaned Customers", 2), ("Orphaned Products", 1), ("Orphaned Stores", 1)]


def test_constraints(sales, dims, rows):
    report = quality.constraint_report(
        "fact_sales",
        sales,
        [
            Rule("key", ("transaction_id",)),
            Rule("not_null", ("customer_id",)),
            Rule("check", ("quantity",), "> 0"),
            Rule("max_length", ("product_id",), 1),
            Rule("reference", ("customer_id",), "dim_customers"),
        ],
        dims,
    )
    assert {r.rule: r.violations for r in report.collect()} == {
        "key(transaction_id)": 2,
        "not_null(customer_id)": 1,
        "check(quantity) > 0": 2,
        "max_length(product_id) 1": 5,
        "reference(customer_id) dim_customers": 1,
    }
    unique = quality.constraint_report(
        "dim_customers", dims["dim_customers"], [Rule("unique", ("email",))], dims
    )
    assert rows(unique, "violations") == [(1,)]


def test_constraints_of_an_empty_table(sales, dims, rows):
    rules = [Rule("key", ("transaction_id",)), Rule("reference", ("store_id",), "dim_stores")]
    report = quality.constraint_report("fact_sales", sales.where("false"), rules, dims)
    assert rows(report, "violations") == [(0,), (0,)]


def test_sales_checks(sales, rows):
    assert rows(quality.sales_quality(sales)) == [(5, 2, 1)]
    assert rows(quality.sales_date_range(sales)) == [(datetime(2011, 1, 1), datetime(2011, 1, 1))]


def test_statuses(frame, rows):
    shipments = frame("status STRING", ("Delivered",), ("Lost",), ("Lost",), (None,))
    assert rows(quality.shipment_status_check(shipments, ["Delivered"])) == [(None, 1), ("Lost", 2)]


def test_quality_report(sales, frame):
    customers = frame("customer_id INT, is_current BOOLEAN", (1, True), (1, False), (2, None))
    inventory = frame("stock_on_hand INT", (-1,), (0,), (None,))
    event = (1, "s", "view", "2024-01-01T00:00:00", None, 1, "X", 1, "T")
    events = frame(
        "customer_id INT, session_id STRING, event_type STRING, timestamp STRING, product_id STRING, "
        "duration_seconds INT, promo_code STRING, quantity INT, transaction_id STRING",
        event,
        event,
        (None, *event[1:]),
        (1, "s", "view", "never", "p", 1, "X", 1, "T"),
    )
    bad = frame("value STRING", ("bad{",), ("",))
    report = quality.quality_report(customers, sales, inventory, events, bad)
    assert {(r.source, r.check): r.affected for r in report.collect()} == {
        ("dim_customers", "duplicate customer_id"): 1,
        ("fact_sales", "quantity <= 0"): 2,
        ("fact_sales", "unit_price <= 0"): 1,
        ("fact_sales", "all rules"): 3,
        ("fact_inventory", "stock_on_hand < 0"): 1,
        ("fact_web_events", "customer_id is null"): 1,
        ("fact_web_events", "duplicate event"): 1,
        ("fact_web_events", "invalid timestamp"): 1,
        ("fact_web_events", "missing optional field"): 2,
        ("fact_web_events", "JSON parse error"): 2,
    }
    empty = quality.quality_report(events=events.where("false"))
    assert {r.affected for r in empty.collect()} == {0}
