"""Counting-based ranks against Spark's own window and numpy."""

from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from basketry.operators import ranking
from basketry.operators.ranking import (
    Score,
    extremes,
    global_ntile,
    order_statistics,
    tile_starts,
)

SCHEMA = "id string, key double"
QUICK = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def check(spark, rows, tiles):
    df = spark.createDataFrame(rows, SCHEMA)
    scores = [
        Score("up", F.col("key")),
        Score("last", F.col("key"), nulls_last=True),
        Score("down", -F.col("key")),
    ]
    counted = global_ntile(df, scores, tie="id", tiles=tiles)
    windows = {
        "w_up": Window.orderBy(F.col("key").asc_nulls_first(), F.col("id").asc_nulls_first()),
        "w_last": Window.orderBy(F.col("key").asc_nulls_last(), F.col("id").asc_nulls_first()),
        "w_down": Window.orderBy((-F.col("key")).asc_nulls_first(), F.col("id").asc_nulls_first()),
    }
    both = counted.select("*", *[F.ntile(tiles).over(w).alias(n) for n, w in windows.items()])
    for row in both.collect():
        assert (row.up, row.last, row.down) == (row.w_up, row.w_last, row.w_down), row


LARGEST = 1.7976931348623157e308


@pytest.mark.parametrize(
    "keys, tiles",
    [
        ([None, LARGEST], 2),
        ([-math.inf, -LARGEST, 0.0, LARGEST, math.inf], 5),
        ([math.inf, math.inf, -math.inf, None, 1.0], 3),
        ([-math.inf] * 3, 2),
    ],
)
def test_ends_of_the_double_range(spark, keys, tiles):
    check(spark, [(str(i * 7919), key) for i, key in enumerate(keys)], tiles)


@QUICK
@given(
    keys=st.lists(
        st.one_of(
            st.none(),
            st.integers(-2, 2).map(float),
            st.floats(allow_nan=False, allow_infinity=True),
        ),
        min_size=1,
        max_size=60,
    ),
    tiles=st.integers(1, 7),
)
def test_any_keys(spark, keys, tiles):
    check(spark, [(str(i * 7919), key) for i, key in enumerate(keys)], tiles)


@pytest.mark.parametrize(
    "rows",
    [
        [(f"user-{i:07d}", 1.0) for i in range(500)],  # every key the same
        [(str(i), None) for i in range(40)],  # no key at all
        [(None, 1.0), ("", 1.0), ("a", 1.0), ("é", 1.0), ("ab", 1.0), ("abc", 1.0), ("abcd", 1.0)],
        [(str(i), float(i % 3)) for i in range(300)] + [("x", None), (None, None)],
        [("only", 5.0)],
    ],
    ids=["tied", "missing", "texts", "few keys", "one row"],
)
def test_difficult_ties(spark, rows):
    check(spark, rows, 5)


def test_tile_sizes_differ_by_at_most_one(spark):
    df = spark.range(1003).select(F.col("id").cast("string").alias("id"), F.rand(3).alias("key"))
    tiled = global_ntile(df, [Score("t", F.col("key"))], "id", 5)
    sizes = [r["count"] for r in tiled.groupBy("t").count().orderBy("t").collect()]
    assert sizes == [201, 201, 201, 200, 200]


def test_tile_starts():
    assert tile_starts(10, 5) == [2, 4, 6, 8]
    assert tile_starts(7, 3) == [3, 5]
    assert tile_starts(2, 5) == [1]
    assert tile_starts(0, 5) == []


@pytest.mark.parametrize("values", [
    np.random.default_rng(1).lognormal(0, 8, 3000),
    np.array([-math.inf, -1e308, -5e-324, 0.0, 5e-324, 1.0, 1e308, math.inf]),
    np.repeat([3.0, 7.0], [900, 1]),
], ids=["spread over many magnitudes", "extremes", "two values"])
def test_order_statistics(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    ranges = df.agg(*extremes(["v"])).first().asDict()
    wanted = sorted({0, len(values) // 3, len(values) // 2, len(values) - 2, len(values) - 1})
    found = order_statistics(df, {"v": wanted}, ranges)["v"]
    ordered = np.sort(values)
    for rank in wanted:
        value, below = found[rank]
        assert value == ordered[rank]
        assert below == int((values < value).sum())


def test_rounds_are_bounded_over_all_magnitudes(spark, monkeypatch):
    """151 values over 600 decades, and ties of 64 letters: few rounds, few buckets."""
    histograms = []
    count = ranking._histogram
    monkeypatch.setattr(ranking, "_histogram", lambda *a: histograms.append(count(*a)) or histograms[-1])
    values = [10.0**p for p in range(-300, 301, 4)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = order_statistics(df, {"v": list(range(0, 151, 10))}, df.agg(*extremes(["v"])).first().asDict())["v"]
    assert all(found[r] == (values[r], r) for r in found) and len(histograms) <= 7
    histograms.clear()
    letters = np.array(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"))
    ids = ["".join(row) for row in np.random.default_rng(2).choice(letters, (4000, 12))]
    check(spark, [(i, 1.0) for i in ids], 5)
    assert max(h.groupBy("span").count().agg(F.max("count")).first()[0] or 0 for h in histograms) <= 64 * 64


def test_long_ties_take_few_rounds(spark, monkeypatch):
    """Ids of 36 characters with little in common: a bucket of few rows ends the rounds."""
    import uuid

    histograms = []
    count = ranking._histogram
    monkeypatch.setattr(ranking, "_histogram", lambda *a: histograms.append(a) or count(*a))
    draw = np.random.default_rng(3)
    ids = [str(uuid.UUID(bytes=draw.bytes(16))) for _ in range(6000)]
    check(spark, [(i, float(k % 2)) for k, i in enumerate(ids)], 5)
    assert len(histograms) <= 5


@pytest.mark.parametrize("few", [1, 3, 10_000])
def test_ties_read_or_counted_are_the_same(spark, monkeypatch, few):
    monkeypatch.setattr(ranking, "TIES_READ", few)
    check(spark, [(f"user-{i * 7919 % 600:04d}é", 1.0) for i in range(600)] + [("user-0001", 1.0), ("", 1.0), (None, 1.0)], 7)


def test_ranked_rows_are_never_shuffled(spark):
    """The result is a projection: no exchange, no sort, no window."""
    df = spark.range(1000).select(F.col("id").cast("string").alias("id"), F.rand(5).alias("key"))
    tiled = global_ntile(df, [Score("t", F.col("key"))], "id", 5)
    plan = tiled._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "Window" not in plan
