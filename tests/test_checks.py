"""Every registered query against its SQL on the smallest data set."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as spark_entry
from martlet.checks.registry import QUERIES
from martlet.operators import customers
from martlet.operators.retail import line_transaction_ids

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test data")


@pytest.fixture(scope="module")
def con():
    pytest.importorskip("duckdb")
    from martlet.checks.compare import connect

    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(spark_entry.queries())
    assert set(QUERIES) <= set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    from martlet.checks.compare import differences

    df = spark_entry.queries()[name](spark, FOLDER)
    assert differences(df, con, spark_entry.oracle_sql()[name]) == []


def test_pairs_of_variants_differ(con):
    """The planted cases tell apart what a wrong switch would mix up."""
    sql = spark_entry.oracle_sql()
    for one, other in (("web_dedup", "web_dedup_second"), ("customer_clv", "customer_clv_current")):
        assert con.execute(sql[one]).fetchall() != con.execute(sql[other]).fetchall()
    tied = con.execute(f"SELECT max(n) FROM (SELECT count(*) AS n FROM ({sql['customer_clv']}) GROUP BY name)")
    assert tied.fetchone()[0] > 1


def test_building_a_plan_starts_no_job(spark):
    """Only mining baskets works before it is asked for rows; reading a schema is no work."""
    sales = spark.createDataFrame([], "customer_id BIGINT, name STRING, email STRING, city STRING, update_timestamp TIMESTAMP_NTZ")
    retail = spark.createDataFrame([], "invoice_no STRING, stock_code STRING, quantity INT, unit_price DOUBLE, customer_id BIGINT, line_no INT")
    spark.sparkContext.setJobGroup("building", "plans only")
    try:
        flagged = customers.scd2_flag(sales)
        customers.scd2_merge(flagged, sales)
        line_transaction_ids(retail, ["line_no"])
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_entry(spark):
    assert spark_entry.entry(spark).columns == ["product_name", "units_sold", "revenue"]
