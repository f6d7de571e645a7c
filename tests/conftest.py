from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from martlet.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, partitions=4, memory="4g")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Build a small DataFrame from rows and a DDL schema."""

    def build(schema: str, *rows):
        return spark.createDataFrame(list(rows), schema)

    return build


@pytest.fixture
def rows():
    """Rows as sorted tuples; nulls sort first."""

    def collect(df, *columns):
        if columns:
            df = df.select(*columns)
        key = lambda row: tuple((v is not None, str(v)) for v in row)
        return sorted((tuple(r) for r in df.collect()), key=key)

    return collect
