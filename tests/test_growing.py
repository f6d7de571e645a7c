from __future__ import annotations

import pytest

from martlet.sources.growing import GrowingLinesReader, follow_lines
from martlet.streaming.ticks import read_live_latest, stream_live_ticks, stream_tick_series

OFTEN = {"processingTime": "0 seconds"}


def append(path, text):
    with open(path, "a", newline="") as file:
        file.write(text)


def test_ticks_of_one_growing_file(spark, tmp_path):
    """Appended between batches, in mid-line too, and after a restart: each tick once."""
    file, out, check = tmp_path / "live.csv", str(tmp_path / "out"), str(tmp_path / "check")

    def start():
        return stream_tick_series(spark, str(file), out, check, OFTEN, growing=True)

    def written():
        return sorted(r["sales"] for r in spark.read.parquet(f"{out}/series").collect())

    query = start()
    query.processAllAvailable()  # the file is not there yet
    append(file, "timestamp,sales,inventory,store_id\n10:00:01,5,7,S1\n10:00:02,6,7,S1\n10:00:0")
    query.processAllAvailable()
    assert written() == [5, 6]
    append(file, "3,8,7,S2\n")
    query.processAllAvailable()
    assert written() == [5, 6, 8]
    query.stop()
    append(file, "10:00:04,9,7,S1\n10:00:05,1")
    query = start()
    query.processAllAvailable()
    assert written() == [5, 6, 8, 9]
    append(file, "0,7,S1\r\n")
    query.processAllAvailable()
    query.stop()
    assert written() == [5, 6, 8, 9, 10]


def test_newest_ticks_of_a_growing_file(spark, tmp_path):
    file, out = tmp_path / "live.csv", str(tmp_path / "out")
    append(file, "".join(f"10:00:{n:02d},{n},1,S\n" for n in range(20)))
    query = stream_live_ticks(spark, str(file), out, str(tmp_path / "c"), OFTEN, n=3, growing=True)
    query.processAllAvailable()
    append(file, "10:01:00,99,1,S\n")
    query.processAllAvailable()
    query.stop()
    assert [r["sales"] for r in read_live_latest(spark, out, 3).collect()] == [99, 19, 18]


@pytest.mark.parametrize("piece", [1, 7, 64, 1 << 20])
def test_pieces_share_the_lines(tmp_path, piece):
    file = tmp_path / "f"
    lines = ["", "a", "größer als ein Stück " * 5, "", "z", "last"]
    file.write_bytes("\n".join(lines).encode() + b"\nhalf")
    reader = GrowingLinesReader(str(file), piece)
    end = reader.latestOffset()
    parts = reader.partitions(reader.initialOffset(), end)
    read = [v for p in parts for b in reader.read(p) for v in b.column(0).to_pylist()]
    assert read == lines
    append(file, " line\n")
    later = reader.partitions(end, reader.latestOffset())
    assert [v for p in later for b in reader.read(p) for v in b.column(0).to_pylist()] == ["half line"]
    with pytest.raises(ValueError):
        reader.partitions(reader.latestOffset(), end)


def test_long_half_line_and_empty_file(spark, tmp_path):
    file = tmp_path / "f"
    file.write_bytes(b"")
    reader = GrowingLinesReader(str(file), 10)
    assert reader.latestOffset()["byte"] == 0
    append(file, "x" * 200_000)
    assert reader.latestOffset()["byte"] == 0
    append(file, "\ny" + "z" * 70_000)
    assert reader.latestOffset()["byte"] == 200_001
    assert follow_lines(spark, str(file)).schema.simpleString() == "struct<value:string>"
