"""Data checks. Each yields one row: check, table, column, failures. Zero passes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from basketry.operators.intermediate import RFM_SEGMENTS

NOT_NULL, UNIQUE, ACCEPTED = "not_null", "unique", "accepted_values"

# Fixed values.
ORDER_STATUSES = (
    "Complete", "Cancelled", "Returned", "Processing", "Shipped", "On Hold",
    "pending", "complete", "cancelled", "returned", "processing", "shipped",
)


@dataclass(frozen=True)
class Check:
    kind: str
    table: str
    column: str
    values: tuple[str, ...] = ()


SOURCE_CHECKS = (
    Check(NOT_NULL, "orders", "order_id"),
    Check(NOT_NULL, "order_items", "id"),
    Check(NOT_NULL, "users", "id"),
    Check(NOT_NULL, "products", "id"),
    Check(NOT_NULL, "events", "id"),
)
MODEL_CHECKS = (
    Check(NOT_NULL, "stg_orders", "order_id"),
    Check(UNIQUE, "stg_orders", "order_id"),
    Check(ACCEPTED, "stg_orders", "order_status", ORDER_STATUSES),
    Check(NOT_NULL, "stg_order_items", "order_item_id"),
    Check(UNIQUE, "stg_order_items", "order_item_id"),
    Check(NOT_NULL, "stg_order_items", "order_id"),
    Check(NOT_NULL, "stg_users", "user_id"),
    Check(UNIQUE, "stg_users", "user_id"),
    Check(NOT_NULL, "stg_products", "product_id"),
    Check(UNIQUE, "stg_products", "product_id"),
    Check(NOT_NULL, "fct_orders", "order_id"),
    Check(UNIQUE, "fct_orders", "order_id"),
    Check(NOT_NULL, "fct_orders", "gross_revenue"),
    Check(NOT_NULL, "dim_customers", "user_id"),
    Check(UNIQUE, "dim_customers", "user_id"),
    Check(ACCEPTED, "dim_customers", "rfm_segment", RFM_SEGMENTS),
    Check(NOT_NULL, "mart_product_performance", "product_id"),
    Check(UNIQUE, "mart_product_performance", "product_id"),
)
ALL_CHECKS = SOURCE_CHECKS + MODEL_CHECKS


def _failure(check: Check) -> Column:
    """Failing rows of a check that looks at single rows."""
    value = F.col(check.column)
    bad = value.isNull() if check.kind == NOT_NULL else ~value.isin(*check.values)
    return F.count_if(bad)


def _labelled(check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(check.kind).alias("check_name"),
        F.lit(check.table).alias("table_name"),
        F.lit(check.column).alias("column_name"),
        failures.cast("long").alias("failures"),
    )


def _row_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All row checks of one table in a single pass."""
    counts = df.agg(*[_failure(c).alias(f"c{i}") for i, c in enumerate(checks)])
    rows = [_labelled(c, F.col(f"c{i}")) for i, c in enumerate(checks)]
    return counts.select(F.inline(F.array(*rows)))


def _key_checks(df: DataFrame, column: str, checks: Sequence[Check]) -> DataFrame:
    """Unique and not-null checks of one column, from one count per value.

    Unique fails per value that occurs more than once; missing values do not count
    there, but are what not-null counts.
    """
    missing = F.col(column).isNull()
    counts = (
        df.groupBy(column)
        .agg(F.count("*").alias("n"))
        .agg(
            F.count_if(~missing & (F.col("n") > 1)).alias(UNIQUE),
            F.coalesce(F.sum(F.when(missing, F.col("n"))), F.lit(0)).alias(NOT_NULL),
        )
    )
    return counts.select(F.inline(F.array(*[_labelled(c, F.col(c.kind)) for c in checks])))


def row_checks_of(table: str, checks: Sequence[Check] = ALL_CHECKS) -> list[Check]:
    """The checks of a table that look at single rows, and so can be counted while it is written or read for another use."""
    return [c for c in checks if c.table == table and c.kind != UNIQUE]


def watched(df: DataFrame, table: str, observation: Observation) -> DataFrame:
    """The same rows; whatever action they pass counts them and the failures of the table's row checks."""
    failures = [_failure(c).alias(f"c{i}") for i, c in enumerate(row_checks_of(table))]
    return df.observe(observation, F.count("*").alias("rows"), *failures)


def observed_failures(table: str, counts: Mapping[str, int]) -> list[tuple[str, str, str, int]]:
    """What :func:`watched` counted, as rows of check, table, column, failures."""
    return [(c.kind, c.table, c.column, counts[f"c{i}"]) for i, c in enumerate(row_checks_of(table))]


def check_not_null(df: DataFrame, column: str, table: str = "") -> DataFrame:
    return _row_checks(df, [Check(NOT_NULL, table, column)])


def check_unique(df: DataFrame, column: str, table: str = "") -> DataFrame:
    return _key_checks(df, column, [Check(UNIQUE, table, column)])


def check_accepted_values(
    df: DataFrame, column: str, values: Sequence[str], table: str = ""
) -> DataFrame:
    """Rows with a value outside the list; a missing value passes."""
    return _row_checks(df, [Check(ACCEPTED, table, column, tuple(values))])


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check] = ALL_CHECKS) -> DataFrame:
    """Every check as one result table.

    Per table, each unique column is counted once, which answers its not-null check
    too; all other checks share one more pass.
    """
    parts: list[DataFrame] = []
    for table in dict.fromkeys(c.table for c in checks):
        own = [c for c in checks if c.table == table]
        keys = dict.fromkeys(c.column for c in own if c.kind == UNIQUE)
        by_key = [c for c in own if c.column in keys and c.kind in (UNIQUE, NOT_NULL)]
        by_row = [c for c in own if c not in by_key]
        if by_row:
            parts.append(_row_checks(tables[table], by_row))
        parts += [
            _key_checks(tables[table], key, [c for c in by_key if c.column == key]) for key in keys
        ]
    return reduce(DataFrame.unionByName, parts)
