"""Reader of web event logs: JSON lines in any number of files."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.operators.web import bad_lines, parse_events
from martlet.sources.tables import arrival_columns, with_arrival


def no_web_lines(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "value STRING, _file STRING, _block BIGINT, _position BIGINT")


def read_web_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text lines with their order of arrival; a file that cannot be read fails the run.

    ``unreadable_files`` names such files, so that a run can go on without them and say so.
    """
    try:
        lines = spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return no_web_lines(spark)
    return with_arrival(lines).select("value", *arrival_columns())


def unreadable_files(spark: SparkSession, path: str | list[str]) -> tuple[list[str], list[str]]:
    """(readable, unreadable) files: all are read, and a set that fails is halved."""
    listed = spark.read.format("binaryFile").load(path).select("path").collect()

    def broken(files: list[str]) -> list[str]:
        try:
            spark.read.text(files).agg(F.count("value"), F.max(F.length("value"))).collect()
            return []
        except (PySparkException, Py4JJavaError):
            if len(files) == 1:
                return files
            half = len(files) // 2
            return broken(files[:half]) + broken(files[half:])

    files = sorted(row["path"] for row in listed)
    lost = broken(files) if files else []
    return [f for f in files if f not in lost], lost


def read_web_events(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(events in order-of-arrival columns, lines that are not events)."""
    lines = read_web_lines(spark, path)
    return parse_events(lines), bad_lines(lines)
