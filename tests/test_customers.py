from __future__ import annotations

from datetime import datetime

import pytest

from martlet.operators import customers as cust

RECORD = "customer_id BIGINT, name STRING, email STRING, city STRING, update_timestamp STRING"


def day(d, month=1):
    return datetime(2024, month, d)


@pytest.fixture
def flagged(frame):
    raw = frame(
        RECORD,
        (1, "A", "a@x", "Mumbai", "2024-01-01T00:00:00"),
        (1, "A", "a@x", "Delhi", "2024-01-05T00:00:00"),
        (2, "B", "b@x", "Pune", "2024-01-02T00:00:00"),
        (3, "C", "c@x", "Goa", "2024-01-03T00:00:00"),
        (3, "C", "c@x", "Agra", "2024-01-03T00:00:00"),
        (4, "D", "d@x", "Kochi", "broken"),
    )
    return cust.scd2_flag(cust.parse_updates(raw))


def test_flags(frame, rows):
    df = frame("customer_id INT, update_timestamp INT", (1, 1), (1, 5), (2, 2), (3, 3), (3, 3), (4, None), (None, 1), (None, 2))
    got = rows(cust.scd2_flag(df), "customer_id", "update_timestamp", "is_current")
    assert got == [
        (None, 1, False),
        (None, 2, True),
        (1, 1, False),
        (1, 5, True),
        (2, 2, True),
        (3, 3, True),
        (3, 3, True),
        (4, None, None),
    ]


def test_history_and_versions(flagged, rows):
    assert rows(cust.scd2_history_count(flagged)) == [(1,)]
    assert rows(cust.scd2_current(flagged), "city") == [("Agra",), ("Delhi",), ("Goa",), ("Pune",)]
    assert [r.city for r in cust.scd2_history(flagged, 1).collect()] == ["Delhi", "Mumbai"]
    assert rows(cust.scd2_versions(flagged)) == [(1, 2), (3, 2)]


def test_check_fails_on_ties(flagged, rows):
    assert rows(cust.scd2_check(flagged)) == [(4, 4, True)]
    assert rows(cust.scd2_check(flagged.where("customer_id <> 4"))) == [(4, 3, False)]


def test_merge_ends_old_versions(frame, flagged, rows):
    feed = cust.parse_updates(
        frame(
            RECORD,
            (1, "A", "a@x", "Pune", "2024-02-01"),
            (1, "A", "a@x", "Goa", "2024-03-01"),
            (2, "B", "b@x", "Pune", "2024-02-01"),
            (9, "Z", "z@x", "Agra", "2024-02-02"),
        )
    )
    merged = cust.scd2_merge(flagged.where("customer_id < 3"), feed)
    got = rows(merged, "customer_id", "city", "valid_from", "valid_to", "is_current")
    assert got == [
        (1, "Delhi", day(5), day(1, 2), False),
        (1, "Goa", day(1, 3), None, True),
        (1, "Mumbai", day(1), day(5), False),
        (1, "Pune", day(1, 2), day(1, 3), False),
        (2, "Pune", day(2), None, True),
        (9, "Agra", day(2, 2), None, True),
    ]


def test_merge_is_idempotent(frame, flagged, rows):
    feed = cust.parse_updates(frame(RECORD, (1, "A", "a@x", "Pune", "2024-02-01")))
    once = cust.scd2_merge(flagged.where("customer_id < 3"), feed)
    assert rows(cust.scd2_merge(once, feed)) == rows(once)


def merged_cities(frame, rows, stored, feed):
    """(city, from, to, current) after a merge for one customer."""
    def records(pairs):
        return cust.parse_updates(frame(RECORD, *[(1, "A", "a@x", city, at) for city, at in pairs]))

    flagged = cust.scd2_flag(records(stored))
    merged = cust.scd2_merge(flagged, records(feed))
    assert rows(cust.scd2_merge(merged, records(feed))) == rows(merged)
    found = merged.orderBy("valid_from", "city").collect()
    return [(r.city, r.valid_from, r.valid_to, r.is_current) for r in found]


def test_merge_keeps_a_move_back(frame, rows):
    feed = [("Pune", "2024-03-01"), ("Delhi", "2024-02-01")]
    assert merged_cities(frame, rows, [("Pune", "2024-01-01")], feed) == [
        ("Pune", day(1), day(1, 2), False),
        ("Delhi", day(1, 2), day(1, 3), False),
        ("Pune", day(1, 3), None, True),
    ]


def test_merge_drops_repeated_records(frame, rows):
    feed = [("Delhi", "2024-02-01"), ("Delhi", "2024-03-01"), ("Delhi", "2024-02-01")]
    assert merged_cities(frame, rows, [("Pune", "2024-01-01")], feed) == [
        ("Pune", day(1), day(1, 2), False),
        ("Delhi", day(1, 2), None, True),
    ]


def test_merge_of_late_tied_and_undated_records(frame, rows):
    feed = [("Goa", "2024-01-15"), ("Agra", "2024-06-01"), ("Kochi", "2024-06-01"), ("Late", "?")]
    stored = [("Pune", "2024-01-01"), ("Delhi", "2024-02-01")]
    assert merged_cities(frame, rows, stored, feed) == [
        ("Late", None, None, None),
        ("Pune", day(1), day(15), False),
        ("Goa", day(15), day(1, 2), False),
        ("Delhi", day(1, 2), day(1, 6), False),
        ("Agra", day(1, 6), None, True),
        ("Kochi", day(1, 6), None, True),
    ]


def test_merge_reads_each_input_once(frame):
    stored = frame(f"{RECORD}, is_current BOOLEAN", (1, "A", "a@x", "Pune", "2024-01-01", True))
    plan = cust.scd2_merge(stored, stored.drop("is_current"))._jdf.queryExecution()
    assert plan.executedPlan().toString().count("Scan") == 2
