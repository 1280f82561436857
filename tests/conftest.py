from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from basketry.schemas import SOURCE_SCHEMAS  # noqa: E402
from basketry.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4, app="tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def source(spark):
    """Build a source table from partial rows: columns left out are NULL."""

    def make(name: str, rows: list[dict]):
        schema = SOURCE_SCHEMAS[name]
        return spark.createDataFrame(
            [tuple(row.get(f.name) for f in schema) for row in rows], schema
        )

    return make


def rows_by(df, key: str) -> dict:
    """Collected rows as dicts under one column's value."""
    return {row[key]: row.asDict() for row in df.collect()}
