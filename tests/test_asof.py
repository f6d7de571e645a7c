from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from martlet.operators.asof import with_version_at
from martlet.operators.customers import customer_at_sale

ROWS = "id int, who long, at timestamp_ntz"
VERSIONS = "who long, begins timestamp_ntz, city string, n int"
T0 = datetime(2024, 1, 1)


def looked_up(rows, versions, strict=False):
    return with_version_at(
        rows, versions, key="who", time="at", valid_from="begins", columns=["city", "n"], strict=strict
    )


def expected(rows, versions, strict=False):
    found = []
    for i, who, at in rows:
        valid = [
            (begins, city, n)
            for key, begins, city, n in versions
            if key == who and None not in (who, at, begins)
            and (begins < at if strict else begins <= at)
        ]
        begins, city, n = max(valid, default=(None, None, None))
        found.append((i, who, at, city, n, begins))
    return sorted(found)


@pytest.mark.parametrize("strict", [False, True])
def test_equals_the_definition(frame, strict):
    rng = random.Random(8)

    def moment():
        return T0 + timedelta(hours=rng.randrange(24 * 6))

    versions = [(rng.randrange(5), moment(), rng.choice("abc"), rng.randrange(9)) for _ in range(60)]
    rows = [(i, rng.randrange(6), moment()) for i in range(300)]
    got = looked_up(frame(ROWS, *rows), frame(VERSIONS, *versions), strict)
    assert got.columns == ["id", "who", "at", "city", "n", "valid_from"]
    assert sorted(map(tuple, got.collect())) == expected(rows, versions, strict)


def test_edges(frame):
    at = T0 + timedelta(days=40, hours=7)
    rows = [(1, 1, at), (2, 1, T0), (3, None, at), (4, 1, None), (5, 9, at), (1, 1, at)]
    versions = [
        (1, T0 + timedelta(days=1), "first", 1),
        (1, at, "tie", 3), (1, at, "tie", 2), (1, at, "sit", 9),
        (1, None, "never", 0), (None, T0, "nobody", 0),
    ]
    got = [tuple(r)[0::3] for r in looked_up(frame(ROWS, *rows), frame(VERSIONS, *versions)).collect()]
    assert sorted(got, key=str) == [(1, "tie"), (1, "tie"), (2, None), (3, None), (4, None), (5, None)]
    before = looked_up(frame(ROWS, (1, 1, at)), frame(VERSIONS, *versions), strict=True).first()
    assert before["city"] == "first"
    assert looked_up(frame(ROWS), frame(VERSIONS, *versions)).count() == 0
    assert looked_up(frame(ROWS, *rows), frame(VERSIONS)).where("city IS NULL").count() == 6


def test_hot_customer_is_cut_into_days(spark, frame, capsys):
    """Most rows are one customer's; windows work per day, and no range join is planned."""
    rows = spark.range(20_000).select(
        F.col("id").cast("int").alias("id"),
        F.when(F.col("id") % 10 < 9, 1).otherwise(F.col("id")).alias("who"),
        (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id").cast("int") % 2000)).alias("at"),
    )
    versions = [(1, T0 + timedelta(days=d, hours=5), f"c{d}", d) for d in (0, 1, 30, 31, 60)]
    got = looked_up(rows, frame(VERSIONS, *versions))
    got.explain()
    plan = capsys.readouterr().out
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "windowspecdefinition(_key#" in plan and ", _day#" in plan
    seen = {r["n"]: r["c"] for r in got.where("who = 1").groupBy("n").agg(F.count("*").alias("c")).collect()}
    hours = [h % 2000 for h in range(20_000) if h % 10 < 9]
    want = {}
    for hour in hours:
        n = max((d for d in (0, 1, 30, 31, 60) if 24 * d + 5 <= hour), default=None)
        want[n] = want.get(n, 0) + 1
    assert seen == want


def test_names_of_the_caller_stay(frame):
    sales = frame("customer_id long, transaction_date timestamp_ntz, city_ string", (1, T0, "x"))
    history = "customer_id long, name string, email string, city string, update_timestamp timestamp_ntz"
    got = customer_at_sale(sales, frame(history, (1, "n", "e", "c", T0)))
    assert got.columns == [
        "customer_id", "transaction_date", "city_", "name", "email", "city", "valid_from"
    ]
    assert tuple(got.first())[2:6] == ("x", "n", "e", "c")
