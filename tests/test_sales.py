from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest

from martlet.operators import sales

SALE = "transaction_id STRING, quantity INT, unit_price DECIMAL(10,2), transaction_date TIMESTAMP_NTZ"


@pytest.fixture
def raw(frame):
    price = Decimal("2.50")
    return frame(
        SALE,
        ("a", 1, price, datetime(2024, 1, 1)),
        ("b", 0, price, datetime(2024, 1, 1)),
        ("c", -3, price, datetime(2024, 1, 1)),
        ("d", 2, Decimal(0), datetime(2024, 1, 1)),
        ("e", None, price, datetime(2024, 1, 1)),
        ("f", 2, None, datetime(2024, 1, 1)),
        ("g", 5, price, datetime(2024, 2, 29, 10)),
        ("h", 5, price, None),
    )


def test_clean_and_counts_agree(raw, rows):
    cleaned = sales.clean_sales(raw)
    assert rows(cleaned, "transaction_id") == [("a",), ("g",), ("h",)]
    assert rows(sales.sales_dropped(raw)) == [(8, 3, 5)]
    assert rows(sales.clean_sales(cleaned)) == rows(cleaned)


def test_partition_keys(raw, rows):
    got = rows(sales.with_partition_keys(sales.clean_sales(raw)), "transaction_id", "year", "month")
    assert got == [("a", 2024, 1), ("g", 2024, 2), ("h", None, None)]


def test_period_end_is_midnight(raw, rows):
    def ids(*period, **options):
        return [r[0] for r in rows(sales.in_period(raw, *period, **options), "transaction_id")]

    assert "g" not in ids(date(2024, 1, 1), date(2024, 2, 29))
    assert "g" in ids(date(2024, 1, 1), date(2024, 2, 29), end_inclusive_day=True)
    assert "a" in ids(date(2023, 1, 1), date(2024, 1, 1))
    keyed = sales.with_partition_keys(raw)
    assert rows(sales.in_period(keyed, date(2024, 1, 1), date(2024, 3, 1)), "transaction_id") == [
        (c,) for c in "abcdefg"
    ]


def test_floor_keeps_unknown_stock(frame, rows):
    df = frame("id INT, stock_on_hand INT", (1, -5), (2, 0), (3, 7), (4, None))
    assert rows(sales.floor_inventory(df)) == [(1, 0), (2, 0), (3, 7), (4, None)]


def test_since_and_watermark(raw, rows):
    mark = sales.next_watermark(raw, "transaction_date").first()[0]
    assert mark == datetime(2024, 2, 29, 10)
    assert rows(sales.since(raw, "transaction_date", datetime(2024, 1, 1)), "transaction_id") == [("g",)]
    assert sales.since(raw, "transaction_date", mark).count() == 0


def test_purge_keeps_the_limit_day_and_undated_rows(frame, rows):
    df = frame("id INT, event_date DATE", (1, date(2024, 1, 1)), (2, date(2024, 1, 2)), (3, None))
    assert rows(sales.purge(df, "event_date", date(2024, 4, 1), 90), "id") == [(2,), (3,)]


def test_forget(frame, rows):
    df = frame("customer_id INT, v INT", (1, 1), (1, 2), (2, 3), (None, 4))
    ids = frame("customer_id INT", (1,), (1,), (None,))
    assert rows(sales.forget(df, ids)) == [(None, 4), (2, 3)]


def test_incremental_load_skips_folders(spark, raw, tmp_path, rows):
    from martlet.sources.sinks import write_partitioned

    dated = sales.with_partition_keys(raw).where("year is not null")
    write_partitioned(dated, str(tmp_path / "s"), ["year", "month"])
    new = sales.since(
        spark.read.parquet(str(tmp_path / "s")), "transaction_date", datetime(2024, 1, 31)
    )
    assert rows(new, "transaction_id") == [("g",)]
    scan = new._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in scan
