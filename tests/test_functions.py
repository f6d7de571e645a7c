from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from martlet import functions as fn


def one(df, column):
    return [row[0] for row in df.select(column).collect()]


def test_mask_email(frame):
    df = frame("e STRING", ("john@x.com",), ("ab@x.com",), ("abc@x.com",), (None,), ("none",))
    assert one(df, fn.mask_email(F.col("e"))) == [
        "joh****@x.com",
        "ab@x.com",
        "abc****@x.com",
        None,
        "none",
    ]
    assert one(df, fn.mask_email(F.col("e"), strict=True))[:2] == ["joh****@x.com", "****@x.com"]


def test_mask_name_masks_the_first_word_only(frame):
    df = frame("n STRING", ("Jane Smith",), ("Al Brown",), ("Bo",), ("Bob",))
    assert one(df, fn.mask_name(F.col("n"))) == ["J***e Smith", "Al B***n", "Bo", "B***b"]


def test_padded_id_keeps_long_numbers_whole(frame):
    df = frame("n BIGINT", (7,), (1234567,), (123456789,), (None,))
    assert one(df, fn.padded_id("SHP_", F.col("n"), 7)) == [
        "SHP_0000007",
        "SHP_1234567",
        "SHP_123456789",
        None,
    ]


def test_parse_timestamp_formats(frame):
    texts = [
        "2024-01-02T03:04:05.123456",
        "2024-01-02T03:04:05",
        "2024-01-02 03:04:05",
        "2024-01-02",
        "12/1/10 8:26",
        "01/31/99 23:59",
        "13/45/10 8:26",
        "soon",
        "",
        None,
    ]
    df = frame("t STRING", *[(t,) for t in texts])
    assert one(df, fn.parse_timestamp(F.col("t"))) == [
        datetime(2024, 1, 2, 3, 4, 5, 123456),
        datetime(2024, 1, 2, 3, 4, 5),
        datetime(2024, 1, 2, 3, 4, 5),
        datetime(2024, 1, 2),
        datetime(2010, 12, 1, 8, 26),
        datetime(1999, 1, 31, 23, 59),
        None,
        None,
        None,
        None,
    ]


def test_parse_timestamp_keeps_an_hour_the_session_zone_skips(spark, frame):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = frame("t STRING", ("3/10/24 2:30",), ("2024-03-10T02:30:00",))
        text = fn.parse_timestamp(F.col("t")).cast("string")
        assert one(df, text) == ["2024-03-10 02:30:00"] * 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_display_text(frame):
    df = frame("x DOUBLE, n BIGINT, p DOUBLE", (1234.5, 12345, 12.0), (None, None, None))
    assert one(df, fn.money(F.col("x"))) == ["₹1,234.50", "N/A"]
    assert one(df, fn.count_text(F.col("n"))) == ["12,345", "N/A"]
    assert one(df, fn.percent(F.col("p"))) == ["12%", None]
