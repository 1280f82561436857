"""Every query against independent SQL on the smallest sample."""

from __future__ import annotations

import pytest

from tests.conftest import SMALL
from verification.compare import differences, oracle_connection
from verification.oracle import all_oracles
from verification.queries import all_queries

QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def duck():
    return oracle_connection(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, SMALL).toArrow()
    expected = duck.sql(ORACLES[name]).to_arrow_table()
    assert not differences(result, expected)
    if name != "flagged_months":
        assert result.num_rows > 0


def test_entry(spark):
    import __spark_entry__

    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    months = __spark_entry__.entry(spark)
    assert months.columns == ["order_month", "revenue", "orders"]
    assert months.count() > 0
