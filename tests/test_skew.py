"""The plans for large groups must give what the plain windows give."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from martlet.operators import retail, skew


@pytest.fixture(autouse=True)
def small_pieces(spark):
    """Keep range partitions apart that adaptive execution would join on so few rows."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, "true")


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, some without a key, many exact copies."""
    n = F.col("id")
    return spark.range(3000).select(
        F.when(n % 3 == 0, F.lit(7)).when(n % 50 != 1, n % 400).alias("k"),
        (n % 11).cast("int").alias("line"),
        (F.when(n % 3 == 0, n % 97).otherwise(n)).alias("v"),
    )


def test_group_max(skewed, rows):
    plain = skewed.withColumn("m", F.max("v").over(Window.partitionBy("k")))
    got = skew.with_group_max(skewed, "k", "v", "m")
    assert rows(got) == rows(plain)
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()


def test_row_number(skewed, rows):
    order = Window.partitionBy("k").orderBy("line", "v")
    plain = skewed.withColumn("rn", F.row_number().over(order).cast("bigint"))
    assert rows(skew.with_row_number(skewed, "k", ["line"], "rn")) == rows(plain)
    nothing = skewed.where("k < 0")
    assert skew.with_row_number(nothing, "k", ["line"], "rn").collect() == []


@pytest.mark.parametrize("crowd", [0, 10, 4_000])
def test_row_number_of_keys_cut_or_whole(skewed, rows, monkeypatch, crowd):
    """Few entries, or many, or all: a key counts as a crowd or not, its numbers are the same."""
    monkeypatch.setattr(skew, "_CROWD", crowd)
    copies = skewed.union(skewed.where("v % 5 = 0"))
    order = Window.partitionBy("k").orderBy("line", "v")
    plain = copies.withColumn("rn", F.row_number().over(order).cast("bigint"))
    assert rows(skew.with_row_number(copies, "k", ["line"], "rn")) == rows(plain)


@pytest.mark.parametrize("kind", ["string", "date", "timestamp_ntz", "double"])
def test_row_number_by_other_orders(skewed, rows, kind):
    moved = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("v") % 50).cast("int"))
    value = {"string": F.md5(F.col("v").cast("string").cast("binary")), "double": F.col("v") / 7}
    column = value.get(kind, F.when(F.col("v") % 9 != 0, moved).cast(kind))
    df = skewed.withColumn("at", column)
    order = Window.partitionBy("k").orderBy("at", "line", "v")
    plain = df.withColumn("rn", F.row_number().over(order).cast("bigint"))
    assert rows(skew.with_row_number(df, "k", ["at"], "rn")) == rows(plain)


def test_a_key_with_most_rows_is_numbered_by_several_tasks(spark):
    """90 % of the rows have one key, and the order begins with a column of few values."""
    n = F.col("id")
    df = spark.range(20_000).select(
        F.when(n % 10 > 0, 7).otherwise(n).alias("k"), (n % 7).alias("line"), n.alias("at")
    )
    numbered = skew.with_row_number(df, "k", ["line", "at"], "rn").where("k = 7")
    order = Window.partitionBy("k").orderBy("line", "at")
    assert numbered.join(df.withColumn("rn", F.row_number().over(order)), ["k", "at", "rn"]).count() == 18_000
    sizes = [r["count"] for r in numbered.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 2 and max(sizes) < 0.6 * 18_000


def test_one_invoice_of_most_lines_in_the_registered_order(spark, rows):
    n = F.col("id")
    lines = spark.range(5_000).select(
        F.when(n % 10 > 0, "536365").otherwise(n.cast("string")).alias("invoice_no"),
        (n % 500).cast("string").alias("stock_code"),
        (n % 3).cast("int").alias("quantity"),
        F.lit("2.50").cast("decimal(10,2)").alias("unit_price"),
        n.alias("customer_id"),
        (1 + n % 7).cast("int").alias("line_no"),
    )
    order = ["line_no", "stock_code", "quantity"]
    rest = [c for c in lines.columns if c not in (*order, "invoice_no")]
    plain = F.row_number().over(Window.partitionBy("invoice_no").orderBy(*order, *rest))
    got = retail.line_transaction_ids(lines, order)
    want = lines.select(F.concat(F.lit("TXN"), "invoice_no", F.lit("-"), plain).alias("id"), "customer_id")
    assert rows(got.select("transaction_id", F.substring("customer_id", 5, 9))) == rows(
        want.select("id", F.col("customer_id").cast("string"))
    )
    sizes = got.where("invoice_no = '536365'").groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 2 and max(r["count"] for r in sizes) < 0.6 * 4_500


def test_very_many_copies_are_shared_out(spark, monkeypatch):
    monkeypatch.setattr(skew, "_COPIES", 100)
    copies = spark.range(2_550).select(F.lit(1).alias("k"), F.lit("same").alias("v"))
    got = skew.with_row_number(copies.union(spark.sql("SELECT 1, 'z' UNION ALL SELECT 2, 'a'")), "k", ["v"], "rn")
    numbers = sorted((r["k"], r["rn"]) for r in got.collect())
    assert numbers == [(1, n) for n in range(1, 2_552)] + [(2, 1)]
    assert got.where("v = 'z'").first()["rn"] == 2_551


def test_first_per_key_breaks_ties_and_keeps_maps(frame, rows):
    df = frame(
        "k STRING, at INT, who STRING, extra MAP<STRING, STRING>",
        ("a", 2, "late", {"x": "1"}),
        ("a", 1, "b", None),
        ("a", 1, "a", {"z": "3", "y": "2"}),
        (None, 5, "n", None),
        (None, 4, None, None),
    )
    got = {r.k: (r.at, r.who, r.extra) for r in skew.first_per_key(df, ["k"], ["at"]).collect()}
    assert got == {"a": (1, "a", {"y": "2", "z": "3"}), None: (4, None, None)}


def test_first_per_key_combines_before_the_shuffle(skewed):
    plan = skew.first_per_key(skewed, ["k"], ["line"])._jdf.queryExecution().toString()
    assert "partial_min" in plan and "Window" not in plan
