"""One text file that grows at its end, as a stream: a Python data source.

    spark.dataSource.register(GrowingLines)
    spark.readStream.format("growing_lines").option("path", file).load()

The offset is the byte behind the last whole line; a line that is still being written waits for
the next batch. A batch is the bytes between two offsets, so one that is run again after a
restart reads the same lines. Long stretches are cut into pieces that tasks read side by side: a
piece has the lines that begin in it. A file that does not exist yet has no lines; one that is
shorter than what was read fails, as it is another file.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

_BLOCK = 1 << 16
_ROWS = 10_000


class Piece(InputPartition):
    """Bytes of the file; ``whole`` if a line is known to begin at the first one."""

    def __init__(self, start: int, stop: int, whole: bool) -> None:
        super().__init__(start)
        self.start, self.stop, self.whole = start, stop, whole


class GrowingLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "growing_lines"

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema) -> GrowingLinesReader:
        return GrowingLinesReader(self.options["path"], int(self.options.get("piece", 32 << 20)))


class GrowingLinesReader(DataSourceStreamReader):
    def __init__(self, path: str, piece: int) -> None:
        self.path, self.piece = path, piece

    def _open(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path)

    def initialOffset(self) -> dict:
        return {"file": self.path, "byte": 0}

    def latestOffset(self) -> dict:
        system, name = self._open()
        if system.get_file_info(name).type == fs.FileType.NotFound:
            return self.initialOffset()
        with system.open_input_file(name) as file:
            end = file.size()
            while end > 0:
                start = max(0, end - _BLOCK)
                block = file.read_at(end - start, start)
                if (last := block.rfind(b"\n")) >= 0:
                    return {"file": self.path, "byte": start + last + 1}
                end = start
        return self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        low, high = start["byte"], end["byte"]
        if high < low:
            raise ValueError(f"{self.path} has become shorter than what was read of it")
        cuts = [*range(low, high, self.piece), high]
        return [Piece(a, b, a == low) for a, b in zip(cuts, cuts[1:])]

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        system, name = self._open()
        with io.BufferedReader(system.open_input_file(name), 1 << 20) as file:
            at = partition.start
            if not partition.whole:  # the line that crosses the cut is the piece before's
                at -= 1
                file.seek(at)
                at += len(file.readline())
            file.seek(at)
            lines = []
            while at < partition.stop:
                line = file.readline()
                at += len(line)
                lines.append(line.rstrip(b"\r\n").decode("utf-8", "replace"))
                if len(lines) == _ROWS:
                    yield _batch(lines)
                    lines = []
            if lines:
                yield _batch(lines)


def _batch(lines: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])


def follow_lines(spark: SparkSession, path: str, piece: int | None = None) -> DataFrame:
    """The lines of a growing file as a stream with the column ``value``."""
    spark.dataSource.register(GrowingLines)
    reader = spark.readStream.format("growing_lines").option("path", path)
    return (reader.option("piece", piece) if piece else reader).load()
