from __future__ import annotations

import json
from datetime import date, datetime

import pytest

from martlet.operators import web

ARRIVAL = ["_position"]


def event(n, **fields):
    base = {"session_id": "s1", "customer_id": 5, "event_type": "search", "timestamp": "2024-01-01T10:00:00"}
    return (n, json.dumps({**base, **fields}))


@pytest.fixture
def lines(frame):
    return frame(
        "_position INT, value STRING",
        event(1),
        event(2, referrer="late copy"),
        event(3, timestamp="2024-01-01T10:00:00.400", promo_code="SAVE10"),
        event(4, customer_id=None),
        event(5, event_type="page_view", timestamp="yesterday", product_id=17),
        event(6, event_type="add_to_cart", quantity=2, campaign="x", nested={"a": [1]}),
        event(7, event_type="checkout_completed", total_value=12.5, quantity="many"),
        (8, "bad{"),
        (9, ""),
        (10, "{}"),
        (11, "5"),
        (12, '{"session_id": "s9"'),
        (13, "[1]"),
        (14, "null"),
        (15, '{"session_id": "s9"} tail'),
        (16, '{"session_id": "s9"}{"session_id": "s8"}'),
        (17, '{"session_id": "s9"} junk}'),
        (18, '{"session_id": "s9"},{"session_id": "s8"}'),
        (19, '{"session_id": "s9"}]'),
        (20, "{'session_id': 's9'}"),
    )


def test_parse_keeps_events_only(lines, rows):
    events = web.parse_events(lines)
    assert rows(events, "_position") == [(n,) for n in range(1, 8)]
    by_position = {r._position: r for r in events.collect()}
    assert by_position[5].product_id == "17"
    assert by_position[6].extra == {"campaign": "x", "nested": '{"a":[1]}'}
    assert by_position[1].extra is None and by_position[1].promo_code is None
    assert (by_position[7].quantity, by_position[7].total_value) == (None, 12.5)


def test_bad_lines(lines, rows):
    assert rows(web.bad_lines(lines), "value") == [
        ("",),
        ("5",),
        ("[1]",),
        ("bad{",),
        ('{"session_id": "s9"',),
        ('{"session_id": "s9"} junk}',),
        ('{"session_id": "s9"} tail',),
        ('{"session_id": "s9"},{"session_id": "s8"}',),
        ('{"session_id": "s9"}]',),
        ('{"session_id": "s9"}{"session_id": "s8"}',),
        ("{'session_id': 's9'}",),
    ]


def test_a_repeated_name_has_its_last_value(frame):
    line = frame("value STRING", ('{"session_id": "a", "x": 1, "session_id": "b", "x": 2}',))
    event = web.parse_events(line).collect()[0]
    assert event.session_id == "b" and event.extra == {"x": "2"}


def test_values_that_do_not_fit(frame, rows):
    lines = frame(
        "value STRING",
        ('{"customer_id": 17850.0, "duration_seconds": "12", "quantity": 2.50}',),
        ('{"customer_id": "x", "duration_seconds": 12.7, "quantity": null}',),
        ('{"customer_id": 99999999999999999999, "total_value": "dear"}',),
    )
    got = [tuple(r) for r in web.parse_events(lines).select("customer_id", "duration_seconds", "quantity").collect()]
    assert got == [(17850, 12, None), (None, None, None), (None, None, None)]
    unfit = web.unfit_values_of(web.split_lines(lines))
    assert rows(unfit) == [("customer_id", 2), ("duration_seconds", 1), ("quantity", 1), ("total_value", 1)]


def test_new_fields(lines, rows):
    assert rows(web.new_fields(lines)) == [("campaign",), ("nested",)]


def test_clean_exact(lines, rows):
    cleaned = web.clean_web_events(web.parse_events(lines), ARRIVAL)
    got = rows(cleaned, "event_type", "timestamp", "event_date", "referrer")
    ten, day = datetime(2024, 1, 1, 10), date(2024, 1, 1)
    assert got == [
        ("add_to_cart", ten, day, None),
        ("checkout_completed", ten, day, None),
        ("page_view", None, None, None),
        ("search", ten, day, None),
        ("search", ten.replace(microsecond=400000), day, None),
    ]
    assert web.undated_events(cleaned).count() == 1
    assert web.dated_events(cleaned).count() == 4


def test_clean_by_second(lines):
    events = web.parse_events(lines)
    cleaned = web.clean_web_events(events, ARRIVAL, dedup="second")
    assert cleaned.where("event_type = 'search'").count() == 1
    with pytest.raises(ValueError):
        web.clean_web_events(events, ARRIVAL, dedup="minute")


def test_dedup_keeps_the_first_and_counts(lines):
    events = web.drop_null_customers(web.parse_events(lines))
    kept = web.dedup_events(events, ARRIVAL)
    assert events.count() - kept.count() == 1
    assert {r._position for r in kept.collect()} == {1, 3, 5, 6, 7}


def test_each_line_is_parsed_once(lines):
    plan = web.parse_events(lines)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1
