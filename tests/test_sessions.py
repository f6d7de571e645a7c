from __future__ import annotations

import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from martlet.operators.sessions import (
    session_funnel,
    store_windows,
    web_sessions,
    with_event_time,
)
from martlet.streaming.sessions import stream_store_windows, stream_web_sessions

EVENTS = "customer_id long, event_type string, timestamp timestamp_ntz, total_value double"
T0 = datetime(2024, 3, 1, 9)


def at(minutes, seconds=0):
    return T0 + timedelta(minutes=minutes, seconds=seconds)


def visits(df):
    return sorted(tuple(r) for r in df.withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("started", "ended")}
    ).collect())


def test_gap_splits_visits(frame):
    events = frame(
        EVENTS,
        (1, "page_view", at(0), None), (1, "add_to_cart", at(29, 59), None),
        (1, "checkout_completed", at(59, 58), 12.5), (1, "checkout_completed", at(59, 58), 2.5),
        (1, "page_view", at(89, 58), None),  # exactly the gap later: the same visit
        (1, "page_view", at(119, 59), None),
        (2, "search", at(0), 99.0), (None, "page_view", at(0), None), (2, "page_view", None, None),
    )
    found = web_sessions(with_event_time(events, "timestamp"))
    assert visits(found) == [
        (1, at(0), at(89, 58), 5, 2, 1, 0, 2, "checkout_completed", 15.0),
        (1, at(119, 59), at(119, 59), 1, 1, 0, 0, 0, "page_view", 0.0),
        (2, at(0), at(0), 1, 0, 0, 0, 0, None, 0.0),
    ]
    funnel = [tuple(r) for r in session_funnel(found).orderBy("place").collect()]
    assert funnel == [
        (1, "page_view", 2, 1.0), (2, "add_to_cart", 1, 0.5), (3, "checkout_start", 0, 0.0),
        (4, "checkout_completed", 1, 0.5),
    ]
    none = web_sessions(with_event_time(frame(EVENTS), "timestamp"))
    assert none.count() == 0 and session_funnel(none).first()["conversion"] is None


def write_events(folder, name, rows):
    lines = [
        json.dumps({"customer_id": c, "session_id": "s", "event_type": k, "timestamp": t.isoformat()})
        for c, k, t in rows
    ]
    (folder / f"{name}.json").write_text("\n".join(lines) + "\n")


def drain(start):
    query = start()
    query.processAllAvailable()
    query.stop()
    return query


def test_stream_of_visits_drops_late_events_and_expired_state(spark, tmp_path):
    raw = tmp_path / "in"
    raw.mkdir()

    def run():
        return drain(lambda: stream_web_sessions(
            spark, str(raw), str(tmp_path / "out"), str(tmp_path / "check"), {"processingTime": "0 seconds"}
        ))

    def written():
        return [r[:4] for r in visits(spark.read.parquet(str(tmp_path / "out")))]

    write_events(raw, "a", [(1, "page_view", at(0)), (1, "add_to_cart", at(20)), (1, "page_view", at(0))])
    run()
    assert written() == []  # the visit is open
    write_events(raw, "b", [(1, "search", at(15)), (2, "page_view", at(45))])  # in time, out of order
    run()
    write_events(raw, "c", [(3, "page_view", at(200))])
    state = run().recentProgress
    # Watermark 190: both visits are over, one copy counted once; only customer 3 is open.
    assert written() == [(1, at(0), at(20), 3), (2, at(45), at(45), 1)]
    windows = [op["numRowsTotal"] for p in state for op in p["stateOperators"] if op["operatorName"] == "sessionWindowStateStoreSaveExec"]
    assert windows[-1] == 1
    write_events(raw, "d", [(1, "page_view", at(21)), (4, "page_view", at(400))])  # 1 is too late
    run()
    assert written() == [
        (1, at(0), at(20), 3), (2, at(45), at(45), 1), (3, at(200), at(200), 1)
    ]


SALE = "transaction_id,customer_id,product_id,quantity,unit_price,store_id,transaction_date\n"


def write_sales(folder, name, rows):
    lines = [f"{i},1,p,{q},2.50,{store},{t.isoformat(sep=' ')}" for i, (store, q, t) in enumerate(rows)]
    (folder / f"{name}.csv").write_text(SALE + "\n".join(lines) + "\n")


def test_windows_tumble_and_slide(frame):
    sales = frame(
        "store_id string, quantity int, unit_price decimal(10,2), transaction_date timestamp_ntz",
        *[("s", 1, None, at(m)) for m in (0, 59, 60, 125)],
    ).withColumn("unit_price", F.lit("2.50").cast("decimal(10,2)"))
    timed = with_event_time(sales, "transaction_date")
    hours = store_windows(timed, "1 hour").orderBy("window_start").collect()
    assert [(r["lines"], r["units"], float(r["revenue"])) for r in hours] == [
        (2, 2, 5.0), (1, 1, 2.5), (1, 1, 2.5)
    ]
    sliding = store_windows(timed, "2 hours", "1 hour")
    assert sliding.agg(F.sum("lines")).first()[0] == 8


def test_stream_of_windows_restarts_in_mid_window(spark, tmp_path):
    raw = tmp_path / "in"
    raw.mkdir()

    def run():
        drain(lambda: stream_store_windows(
            spark, str(raw), str(tmp_path / "out"), str(tmp_path / "check"), {"processingTime": "0 seconds"}
        ))
        rows = spark.read.parquet(str(tmp_path / "out")).orderBy("window_start").collect()
        return [(r["store_id"], r["lines"], r["units"]) for r in rows]

    write_sales(raw, "a", [("s", 1, at(0)), ("s", 2, at(30)), ("s", -1, at(31))])
    assert run() == []
    write_sales(raw, "b", [("s", 4, at(59)), ("s", 8, at(65))])  # the query was stopped in between
    assert run() == []
    write_sales(raw, "c", [("s", 16, at(140))])
    assert run() == [("s", 3, 7), ("s", 1, 8)]
    write_sales(raw, "d", [("s", 32, at(1)), ("s", 64, at(300))])  # the first is too late
    assert run() == [("s", 3, 7), ("s", 1, 8), ("s", 1, 16)]
