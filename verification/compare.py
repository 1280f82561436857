"""Run queries next to their SQL and compare row by row.

    python -m verification.compare <sample folder> [query ...]
"""

from __future__ import annotations

import sys
import time

import duckdb
import pyarrow as pa

from basketry.session import local_session
from verification.oracle import all_oracles
from verification.queries import all_queries

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')"
        )
    return connection


def _normal(table: pa.Table) -> tuple[list[tuple[str, str]], list[tuple]]:
    names = sorted(table.column_names)
    types = []
    for name in names:
        kind = table.schema.field(name).type
        types.append((name, "timestamp" if pa.types.is_timestamp(kind) else
                      "string" if pa.types.is_large_string(kind) else str(kind)))
    rows = zip(*[table.column(n).to_pylist() for n in names]) if table.num_rows else []
    return types, sorted(rows, key=repr)


def differences(spark_rows: pa.Table, oracle_rows: pa.Table) -> list[str]:
    """What differs: columns and types, row count, exact values."""
    (left_types, left), (right_types, right) = _normal(spark_rows), _normal(oracle_rows)
    found = []
    if left_types != right_types:
        found.append(f"types: {set(left_types) ^ set(right_types)}")
    if len(left) != len(right):
        found.append(f"rows: {len(left)} and {len(right)}")
    unequal = [(a, b) for a, b in zip(left, right) if a != b]
    if unequal:
        found.append(f"values: {len(unequal)} rows, first {unequal[0]}")
    return found


def main(folder: str, chosen: list[str]) -> int:
    spark = local_session(8)
    connection = oracle_connection(folder)
    queries, oracles = all_queries(), all_oracles()
    bad = 0
    for name in chosen or queries:
        begin = time.time()
        try:
            rows = queries[name](spark, folder).toArrow()
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            print(f"FAIL {name}: {str(error)[:600]}", flush=True)
            bad += 1
            continue
        seconds = time.time() - begin
        if name not in oracles:
            print(f"ONLY {name}: {rows.num_rows} rows, no SQL", flush=True)
            continue
        try:
            expected = connection.sql(oracles[name]).to_arrow_table()
        except Exception as error:  # noqa: BLE001
            print(f"SQL! {name}: {str(error)[:600]}", flush=True)
            bad += 1
            continue
        found = differences(rows, expected)
        bad += bool(found)
        print(f"{'DIFF' if found else 'ok  '} {name}: {rows.num_rows} rows, {seconds:.2f}s "
              f"{' | '.join(found)[:900]}", flush=True)
    print(f"{bad} of {len(chosen or queries)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
