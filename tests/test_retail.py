from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest

from martlet.operators import retail

LINE = (
    "invoice_no STRING, stock_code STRING, description STRING, quantity INT, "
    "invoice_date TIMESTAMP_NTZ, unit_price DECIMAL(10,2), customer_id STRING, country STRING, "
    "line_no INT"
)


def line(invoice, code, text, quantity, price, customer, n):
    day = datetime(2010, 12, 1, 8, 26)
    return (invoice, code, text, quantity, day, Decimal(price), customer, "United Kingdom", n)


@pytest.fixture
def lines(frame):
    return frame(
        LINE,
        line("536365", "85123A", " WHITE LANTERN ", 6, "2.55", "17850", 1),
        line("536365", "71053", "METAL LAMP", 6, "3.39", "17850.0", 2),
        line("536365", "85123A", "WHITE LANTERN again", 1, "2.60", "17850", 3),
        line("C536379", "D", "Discount", -1, "27.50", "14527", 1),
        line("536414", "22139", None, 56, "0.00", None, 1),
        line("536415", "22139", "", 1, "4.00", "x", 1),
    )


def test_drop_null_customers(lines, rows):
    kept = rows(retail.drop_null_customers(lines), "invoice_no", "customer_id")
    assert kept == [("536365", 17850)] * 3 + [("C536379", 14527)]


def test_derive_products_takes_the_first_line(lines, rows):
    got = rows(retail.derive_products(lines, ["invoice_date", "invoice_no", "line_no"]))
    assert ("85123A", " WHITE LANTERN ", Decimal("2.55")) in got
    assert ("22139", None, Decimal("0.00")) in got
    assert len(got) == 4


def test_retail_clean(lines, rows):
    got = rows(retail.retail_clean(lines), "invoice_no", "line_no")
    assert got == [("536365", 1), ("536365", 2), ("536365", 3), ("536415", 1)]


def test_map_sales_keeps_returns(lines):
    mapped = retail.map_sales(lines)
    assert mapped.columns == ["transaction_id", "customer_id", "product_id", "quantity", "unit_price"]
    assert mapped.where("quantity < 0").count() == 1


def test_shipments_one_per_transaction(lines, rows):
    got = rows(retail.derive_shipments(retail.map_sales(lines)))
    assert got == [
        ("SHP_0536365", "536365"),
        ("SHP_0536414", "536414"),
        ("SHP_0536415", "536415"),
        ("SHP_C536379", "C536379"),
    ]


def test_shipment_ids_are_unique(frame):
    ids = ["123", "0123", " 123", "+123", "-5", "#0123", "#123", "C1", "12345678", "0000123", "1.5"]
    got = retail.derive_shipments(frame("transaction_id STRING", *[(i,) for i in ids])).collect()
    by_id = {r.transaction_id: r.shipment_id for r in got}
    assert len(set(by_id.values())) == len(ids)
    assert by_id["123"] == "SHP_0000123" and by_id["12345678"] == "SHP_12345678"


def test_line_transaction_ids(lines, rows):
    got = rows(retail.line_transaction_ids(lines, ["line_no"]), "transaction_id", "product_id")
    assert got == [
        ("TXN536365-1", "PROD85123A"),
        ("TXN536365-2", "PROD71053"),
        ("TXN536365-3", "PROD85123A"),
        ("TXN536414-1", "PROD22139"),
        ("TXN536415-1", "PROD22139"),
        ("TXNC536379-1", "PRODD"),
    ]


def test_standardize_description(lines, rows):
    products = retail.derive_products(lines, ["invoice_no", "line_no"])
    got = rows(retail.standardize_description(products), "product_id", "description")
    assert got == [("71053", "Metal Lamp"), ("85123A", "White Lantern"), ("D", "Discount")]


def test_categorize_first_rule_wins(frame, rows):
    products = frame("product_id INT, description STRING", (1, "Red LAMP bag"), (2, "cup"), (3, None))
    rules = [("bag", "Bags"), ("lamp", "Home")]
    got = rows(retail.categorize(products, rules, {"Bags": "S1", "Other": "S9"}))
    assert got == [
        (1, "Red LAMP bag", "Bags", "S1"),
        (2, "cup", "Other", "S9"),
        (3, None, "Other", "S9"),
    ]


def test_enrich_customers(frame, rows):
    df = frame("customer_id INT, name STRING, country STRING", (1, "Asha Rao", "France"), (2, "B C", "Peru"))
    got = rows(retail.enrich_customers(df, {"France": "Pune"}, "2024-01-15 10:30:00"))
    when = datetime(2024, 1, 15, 10, 30)
    assert got == [
        (1, "Asha Rao", "asha.rao@email.com", "Pune", when),
        (2, "B C", "b.c@email.com", "Peru", when),
    ]


def test_dedup_pk_by_order(frame, rows):
    df = frame("id INT, at INT, v STRING", (1, 2, "b"), (1, 1, "a"), (2, 1, "c"), (2, 1, "c"))
    assert rows(retail.dedup_pk(df, ["id"], ["at"])) == [(1, 1, "a"), (2, 1, "c")]


def test_sample_by_key_repeats_and_keeps_keys_together(spark):
    df = spark.range(20_000).selectExpr("id % 5000 as k", "id as v")
    sample = retail.sample_rows(df, 0.1, key="k")
    first = {r.v for r in sample.collect()}
    again = {r.v for r in retail.sample_rows(df.repartition(7), 0.1, key="k").collect()}
    assert first == again and 0.07 < len(first) / 20_000 < 0.13
    assert {v % 5000 + 5000 * i for v in first for i in range(4)} == first
    assert retail.sample_rows(df, 1.0, key="k").count() == 20_000
    assert 0 < retail.sample_rows(df, 0.1, seed=3).count() < 20_000


def test_sample_of_exactly_n(spark, frame, rows, capsys):
    df = spark.range(1000).selectExpr("id", "id % 7 AS kind", "CAST(id % 3 AS STRING) AS v")
    got = retail.sample_n(df, 10, ["id"])
    assert got.count() == 10 and rows(got) == rows(retail.sample_n(df.orderBy("v"), 10, ["id"]))
    got.explain()
    assert "TakeOrderedAndProject" in capsys.readouterr().out
    each = retail.sample_n(df, 4, ["id"], by="kind")
    assert each.groupBy("kind").count().where("count = 4").count() == 7
    each.explain()
    assert "WindowGroupLimit" in capsys.readouterr().out
    assert retail.sample_n(df.limit(3), 10, ["id"]).count() == 3
    assert retail.sample_n(df, 0, ["id"]).count() == 0
    ties = frame("k INT, v STRING", (1, "b"), (1, "a"), (None, "c"), (1, "a"))
    assert rows(retail.sample_n(ties, 2, ["k"], by="k")) == [(None, "c"), (1, "a"), (1, "a")]
