from __future__ import annotations

import pytest

from basketry.operators import checks


@pytest.fixture(scope="module")
def broken(spark):
    return spark.createDataFrame(
        [("1", "Complete"), ("1", "complete"), ("2", "Lost"), (None, None), (None, "Lost"), ("2", "?")],
        "order_id string, order_status string",
    )


def failures(df):
    return df.first().failures


def test_each_kind_finds_what_is_wrong(broken):
    assert failures(checks.check_not_null(broken, "order_id")) == 2
    assert failures(checks.check_unique(broken, "order_id")) == 2  # values, not rows
    statuses = checks.ORDER_STATUSES
    assert failures(checks.check_accepted_values(broken, "order_status", statuses)) == 3


def test_each_kind_passes_clean_data(broken):
    clean = broken.limit(1)
    assert failures(checks.check_not_null(clean, "order_id")) == 0
    assert failures(checks.check_unique(clean, "order_id")) == 0
    assert failures(checks.check_accepted_values(clean, "order_status", checks.ORDER_STATUSES)) == 0


def test_empty_tables_pass(broken):
    assert failures(checks.check_unique(broken.where("false"), "order_id")) == 0
    assert failures(checks.check_not_null(broken.where("false"), "order_id")) == 0


def test_all_checks_are_listed():
    kinds = [c.kind for c in checks.ALL_CHECKS]
    assert (kinds.count("not_null"), kinds.count("unique"), kinds.count("accepted_values")) == (14, 7, 2)
    assert len(set(checks.ALL_CHECKS)) == 23


def test_run_checks_over_a_broken_table(broken):
    own = [c for c in checks.ALL_CHECKS if c.table == "stg_orders"]
    got = {(r.check_name, r.column_name): r.failures
           for r in checks.run_checks({"stg_orders": broken}, own).collect()}
    assert got == {
        ("not_null", "order_id"): 2, ("unique", "order_id"): 2,
        ("accepted_values", "order_status"): 3,
    }
