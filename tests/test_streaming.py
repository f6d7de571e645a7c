"""A stream must end with what the batch gives on the same files."""

from __future__ import annotations

import json
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from martlet.operators import web
from martlet.sources.tables import arrival_columns, read_ticks
from martlet.sources.web import read_web_lines
from martlet.streaming import ticks as tick_stream
from martlet.streaming import web as web_stream

NOW = {"availableNow": True}


def event(n, **fields):
    base = {
        "session_id": f"s{n % 3}",
        "customer_id": n if n % 5 else None,
        "event_type": "search",
        "timestamp": f"2024-01-0{1 + n % 4}T10:00:00",
    }
    return json.dumps({**base, "referrer": f"r{n}", **fields})


@pytest.fixture
def folders(tmp_path):
    for name in ("in", "out"):
        (tmp_path / name).mkdir()
    return {name: str(tmp_path / name) for name in ("in", "out", "check")}


def drop(folders, name, lines):
    with open(f"{folders['in']}/{name}", "w") as file:
        file.write("\n".join(lines) + "\n")


def run(start, spark, folders, **options):
    query = start(spark, folders["in"], folders["out"], folders["check"], NOW, **options)
    query.awaitTermination(120)
    assert query.exception() is None


def test_web_stream_equals_batch(spark, folders, rows):
    drop(folders, "a.json", [event(n) for n in range(1, 15)] + ["bad{", ""])
    run(web_stream.stream_web_events, spark, folders)
    drop(folders, "b.json", [event(n, extra_key=1) for n in range(8, 30)] + ["5"])
    drop(folders, "ignored.txt", ["not an event file"])
    run(web_stream.stream_web_events, spark, folders)
    run(web_stream.stream_web_events, spark, folders)

    lines = read_web_lines(spark, f"{folders['in']}/*.json")
    batch = web.dated_events(web.clean_web_events(web.parse_events(lines), arrival_columns()))
    keys = ["session_id", "event_type", "timestamp", "event_date"]
    stream = web_stream.read_stream_events(spark, folders["out"])
    assert rows(stream, *keys) == rows(batch, *keys)
    # The first file came first, so its events stay; the batch orders files by name alike.
    assert rows(stream, "referrer") == rows(batch, "referrer")

    report = web_stream.read_stream_quality(spark, folders["out"])
    counts = {(r.batch_id, r.check): r.affected for r in report.collect()}
    assert counts[0, "JSON parse error"] == 2 and counts[1, "JSON parse error"] == 1
    assert counts[0, "customer_id is null"] == 2 and counts[1, "customer_id is null"] == 4
    assert counts[1, "event already in hub"] > 0
    assert counts[0, "events in hub"] + counts[1, "events in hub"] == stream.count()


def test_every_line_is_accounted_for(spark, folders):
    """Lines in = events stored + copies + events without customer + quarantine, in each batch."""
    odd = [event(4, timestamp="yesterday"), event(4, timestamp="yesterday"), event(7, timestamp="2024")]
    unfit = [event(11, quantity="many"), event(12, customer_id=12.0), event(13, customer_id=12.5)]
    files = {"a.json": [event(n) for n in range(1, 15)] + odd + ["bad{", event(1) + event(2)],
             "b.json": [event(n) for n in range(9, 20)] + unfit + [event(3, timestamp="2024-01-01T10:00:00Z")]}
    for name, lines in files.items():
        drop(folders, name, lines)
        run(web_stream.stream_web_events, spark, folders)
    report = web_stream.read_stream_quality(spark, folders["out"]).collect()
    for batch_id, lines in enumerate(files.values()):
        counts = {r.check: r.affected for r in report if r.batch_id == batch_id}
        parts = ["events in hub", "event already in hub", "duplicate event", "customer_id is null",
                 "invalid timestamp", "JSON parse error"]
        assert sum(counts[p] for p in parts) == len(lines)
    kept = spark.read.parquet(f"{folders['out']}/quarantine_web_events")
    assert sorted(r.timestamp_text for r in kept.collect()) == ["2024", "2024-01-01T10:00:00Z", "yesterday"]
    assert {"session_id", "referrer", "extra", "source_file"} <= set(kept.columns)
    assert spark.read.parquet(f"{folders['out']}/quarantine_web_lines").count() == 2
    assert {r.check: r.affected for r in report if r.batch_id == 1}["value does not fit"] == 2


def test_another_checkpoint_destroys_nothing(spark, folders, rows):
    drop(folders, "a.json", [event(1)])
    run(web_stream.stream_web_events, spark, folders)
    other = {**folders, "in": f"{folders['in']}2", "check": f"{folders['check']}2"}
    Path(other["in"]).mkdir()
    drop(other, "b.json", [event(9), event(1)])
    run(web_stream.stream_web_events, spark, other)
    stored = web_stream.read_stream_events(spark, folders["out"])
    assert rows(stored, "referrer", "batch_id") == [("r1", 0), ("r9", 0)]
    run(web_stream.stream_web_events, spark, {**other, "check": f"{folders['check']}3"})
    assert web_stream.read_stream_events(spark, folders["out"]).count() == 2


def test_only_the_days_of_a_batch_are_read(spark, folders):
    drop(folders, "a.json", [event(n) for n in range(1, 15)])
    run(web_stream.stream_web_events, spark, folders)
    stored = web_stream.read_stream_events(spark, folders["out"])
    days = [date(1970, 1, 1), date(2024, 1, 2)]
    scan = stored.where(F.col("event_date").isin(days))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [event_date" in scan and "IN (1970-01-01,2024-01-02)" in scan


def test_compaction_keeps_every_event(spark, folders, rows, tmp_path):
    for name, numbers in (("a.json", range(1, 9)), ("b.json", range(6, 20))):
        drop(folders, name, [event(n) for n in numbers])
        run(web_stream.stream_web_events, spark, folders)
    before = web_stream.read_stream_events(spark, folders["out"]).drop("run_id", "batch_id")
    web_stream.compact_stream_events(spark, folders["out"], str(tmp_path / "compact"))
    after = web_stream.read_stream_events(spark, str(tmp_path / "compact")).drop("run_id", "batch_id")
    assert rows(after) == rows(before)


def test_a_batch_that_runs_again_changes_nothing(spark, folders, rows):
    drop(folders, "a.json", [event(n) for n in range(1, 10)])
    lines = read_web_lines(spark, f"{folders['in']}/*.json").drop("_position")
    for _ in range(2):
        web_stream._write_batch(lines, 0, folders["out"], "run", "exact")
    first = rows(web_stream.read_stream_events(spark, folders["out"]))
    web_stream._write_batch(lines, 1, folders["out"], "run", "exact")
    assert rows(web_stream.read_stream_events(spark, folders["out"])) == first
    assert len(first) == 8


def test_dedup_by_second_across_batches(spark, folders):
    drop(folders, "a.json", [event(1, timestamp="2024-01-01T10:00:00.1")])
    run(web_stream.stream_web_events, spark, folders, dedup="second")
    drop(folders, "b.json", [event(4, session_id="s1", timestamp="2024-01-01T10:00:00.9")])
    run(web_stream.stream_web_events, spark, folders, dedup="second")
    assert web_stream.read_stream_events(spark, folders["out"]).count() == 1


def test_stateful_dedup_gives_one_row_per_key(spark, folders):
    drop(folders, "a.json", [event(n) for n in range(1, 15)] * 2)
    lines = spark.readStream.format("text").load(folders["in"])
    events = web.parse_event_time(web.drop_null_customers(web.parse_events(lines)))
    query = (
        web_stream.dedup_stream(events)
        .writeStream.format("memory")
        .queryName("deduped")
        .trigger(**NOW)
        .start()
    )
    query.awaitTermination(120)
    keys = ["session_id", "event_type", "timestamp"]
    seen = spark.table("deduped").select(*keys)
    assert seen.count() == seen.distinct().count() == 10


def tick(n):
    return f"{10 + n // 3600:02}:{n // 60 % 60:02}:{n % 60:02},{100 + n},{10 + n % 40},ST_00{1 + n % 5}"


def test_live_ticks(spark, folders, rows):
    drop(folders, "a.csv", ["timestamp,sales,inventory_level,store_id"] + [tick(n) for n in range(20)])
    run(tick_stream.stream_live_ticks, spark, folders)
    drop(folders, "b.csv", [tick(n) for n in range(20, 26)])
    run(tick_stream.stream_live_ticks, spark, folders)
    batch = tick_stream.live_latest(read_ticks(spark, folders["in"]))
    live = tick_stream.read_live_latest(spark, folders["out"])
    columns = ["tick_ts", "sales", "inventory", "store_id"]
    assert rows(live, *columns) == rows(batch, *columns)
    assert [r.sales for r in live.orderBy("tick_ts").collect()] == list(range(111, 126))
    panel = tick_stream.live_panel(batch).where("current_sales is not null or in_log")
    assert panel.count() == 5
    assert [r.current_sales for r in panel.collect() if r.current_sales] == ["₹125"]


def test_ticks_after_midnight_are_newer(spark, folders):
    drop(folders, "a.csv", ["23:59:59,500,10,ST_001"])
    run(tick_stream.stream_live_ticks, spark, folders, n=1)
    drop(folders, "b.csv", ["00:00:01,600,10,ST_001"])
    run(tick_stream.stream_live_ticks, spark, folders, n=1)
    assert [r.sales for r in tick_stream.read_live_latest(spark, folders["out"], 1).collect()] == [600]


def test_ticks_after_a_new_checkpoint_are_newer(spark, folders):
    for n in range(3):
        drop(folders, f"{n}.csv", [f"10:00:0{n},{101 + n},10,ST_001"])
        run(tick_stream.stream_live_ticks, spark, folders, n=3)
    other = {**folders, "in": f"{folders['in']}2", "check": f"{folders['check']}2"}
    Path(other["in"]).mkdir()
    drop(other, "late.csv", ["09:00:00,999,10,ST_001"])
    run(tick_stream.stream_live_ticks, spark, other, n=3)
    live = tick_stream.read_live_latest(spark, folders["out"], 3)
    assert [r.sales for r in live.collect()] == [999, 103, 102]


def test_tick_batch_runs_again(spark, folders, rows):
    drop(folders, "a.csv", [tick(n) for n in range(5)])
    batch = read_ticks(spark, folders["in"])
    for batch_id in (0, 1, 1, 2):
        tick_stream._merge_batch(batch, batch_id, folders["out"], "run", 8)
    live = tick_stream.read_live_latest(spark, folders["out"])
    assert live.count() == 8


def test_tick_series(spark, folders):
    drop(folders, "a.csv", [tick(n) for n in range(7)])
    run(tick_stream.stream_tick_series, spark, folders)
    series = spark.read.parquet(f"{folders['out']}/series")
    assert series.columns == ["tick_ts", "sales"] and series.count() == 7
    assert series.agg(F.max("tick_ts")).first()[0] == datetime(1970, 1, 1, 10, 0, 6)
