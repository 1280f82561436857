"""Profiles and CSV scans against pandas."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from basketry.operators import profile
from basketry.sources.readers import MISSING_TOKENS, read_csv
from tests.conftest import rows_by


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(5)
    values = rng.normal(50, 10, 101).round(2)
    values[[3, 50]] = [500.0, -400.0]
    frame = pd.DataFrame({
        "key": np.arange(101), "value": values, "flat": 7.0, "name": [f"n{i % 4}" for i in range(101)],
        "flag": [i % 2 == 0 for i in range(101)],
    })
    frame.loc[[10, 20, 30], "value"] = np.nan
    frame.loc[[1, 2], "name"] = None
    return frame


@pytest.fixture(scope="module")
def df(spark, frame):
    rows = [
        (int(r.key), r.value, r.flat, r["name"] if isinstance(r["name"], str) else None, bool(r.flag))
        for _, r in frame.iterrows()
    ]
    return spark.createDataFrame(rows, "key long, value double, flat double, name string, flag boolean")


def test_shape_counts_nan_as_missing(df, frame):
    assert tuple(profile.shape(df).first()) == (101, 5, int(frame.isnull().sum().sum()))


def test_missing_by_column(df):
    assert {r.column_name: r.nulls for r in profile.missing_by_column(df).collect()} == {
        "value": 3, "name": 2
    }


def test_kinds(df):
    kinds = {r.column_name: (r.kind, r.present) for r in profile.column_kinds(df).collect()}
    assert kinds == {
        "key": ("numeric", 101), "value": ("numeric", 98), "flat": ("numeric", 101),
        "name": ("text", 99),
    }


def test_describe(df, frame):
    expected = frame.describe().round(2)
    got = rows_by(profile.describe(df), "column_name")
    assert list(got) == ["key", "value", "flat"]
    names = {"count": "count", "mean": "mean", "std": "std", "min": "min", "25%": "p25",
             "50%": "p50", "75%": "p75", "max": "max"}
    for column, row in got.items():
        for theirs, ours in names.items():
            assert row[ours] == pytest.approx(expected[column][theirs], abs=1e-9), (column, ours)


def test_describe_without_values(spark):
    empty = spark.createDataFrame([(None,), (None,)], "v double")
    row = profile.describe(empty).first()
    assert (row["count"], row.mean, row.p50, row.max) == (0, None, None, None)


def test_describe_approximate(df, frame):
    row = profile.describe(df, ["value"], approximate=True).first()
    assert abs(row.p50 - frame.value.median()) < 1


def test_describe_of_texts_only(df):
    assert [tuple(r) for r in profile.describe(df.select("name")).collect()] == [("name", 99, 4, "n0", 26)]
    with pytest.raises(ValueError):
        profile.describe(df.select("flag"))


@pytest.mark.parametrize("tied", [1000, 2])
def test_describe_text(spark, monkeypatch, tied):
    monkeypatch.setattr(profile, "TIED_VALUES", tied)
    rows = [
        (f"id-{i:04d}", ["b", "a", "c", None][i % 4], ["x", "y"][i < 3], f"v{i // 2 % 30}", None, "é" * 3000 if i % 9 else "", i)
        for i in range(120)
    ]
    df = spark.createDataFrame(rows, "u string, `three ways` string, few string, pairs string, nothing string, long string, n int")
    df = df.withColumn("day", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("n") / 100).cast("int")))
    frame = df.toPandas().astype({"day": str})
    got = rows_by(profile.describe_text(df), "column_name")
    assert list(got) == ["u", "three ways", "few", "pairs", "nothing", "long", "day"]
    for name, row in got.items():
        counts = frame[name].value_counts()
        top = min(counts.index[counts == counts.max()], default=None)
        expected = (name, counts.sum(), len(counts), top, counts.max() if len(counts) else None)
        assert tuple(row.values()) == expected
    empty = profile.describe_text(df.limit(0)).collect()
    assert {tuple(r)[1:] for r in empty} == {(0, 0, None, None)}


def test_long_texts_are_not_shuffled(spark):
    """What the distinct count moves is hashes."""
    df = spark.range(50).select(F.repeat(F.col("id").cast("string"), F.lit(9)).alias("text"))
    frames = []
    keep = profile.materialize
    profile.materialize, before = lambda f, *a: frames.append(f) or keep(f, *a), keep
    try:
        assert profile.describe_text(df).first().unique == 50
    finally:
        profile.materialize = before
    assert [f.columns for f in frames] == [["i", "a", "b", "n"]]


def test_series(df, frame):
    bars = {r.x: r.y for r in profile.bar_series(df, "name", "key").collect()}
    for name, total in frame.groupby("name").key.sum().items():
        assert bars[name] == total
    points = profile.xy_series(df, "key", "flat", line=True).collect()
    assert [p.x for p in points] == list(range(101)) and points[0].y == 7.0
    assert profile.xy_series(df, "key", "value").count() == 101


def test_histogram_matches_numpy(df, frame):
    counts, edges = np.histogram(frame.value.dropna(), bins=8)
    got = rows_by(profile.histogram(df, "value", 8), "bin")
    assert [got[i]["count"] for i in range(8)] == counts.tolist() and 0 in counts.tolist()
    assert got[0]["bin_start"] == edges[0] and got[7]["bin_end"] == pytest.approx(edges[-1])
    assert [tuple(r) for r in profile.histogram(df, "flat").collect()] == [(0, 7.0, 7.0, 101)]


def test_histogram_chooses_its_bins(spark, df, frame):
    counts, edges = np.histogram(frame.value.dropna(), bins="sturges")
    got = profile.histogram(df, "value").collect()
    assert [r["count"] for r in got] == counts.tolist()
    assert [r.bin_start for r in got] == pytest.approx(edges[:-1].tolist())


def test_histogram_of_infinite_and_extreme_values(spark):
    values = [-math.inf, math.inf, math.nan, None, 1.0, 2.0, 4.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [tuple(r) for r in profile.histogram(df, "v", 3).collect()] == [(0, 1.0, 2.0, 1), (1, 2.0, 3.0, 1), (2, 3.0, 4.0, 1)]
    ends = spark.createDataFrame([(-1.7e308,), (1.7e308,), (0.1,)], "v double")
    got = profile.histogram(ends, "v", 2).collect()
    assert [r["count"] for r in got] == [1, 2] and got[0].bin_end == 0 and got[1].bin_end == 1.7e308
    assert profile.histogram(df.where("v = 7"), "v").count() == profile.histogram(df.where("abs(v) > 7"), "v", 5).count() == 0


@pytest.mark.parametrize("column", ["value", "flat", "key"])
def test_anomalies(df, frame, column):
    values = frame[column]
    flags = (values - values.mean()).abs() > 2 * values.std()
    got = profile.column_anomalies(df, column)
    assert {r.key for r in got.where("is_anomaly").collect()} == set(frame.key[flags])
    assert got.count() == 101 and got.where("is_anomaly IS NULL").count() == 0
    summary = profile.anomaly_summary(df, column).first()
    assert summary.anomalies == flags.sum() and summary.n_rows == 101
    assert summary["mean"] == pytest.approx(values.mean())
    assert summary.anomaly_pct == pytest.approx(flags.mean() * 100)
    sample = profile.anomaly_sample(df, column, 1, ["key"])
    assert sample.columns == df.columns and sample.count() == min(1, flags.sum())


def test_one_row_has_no_deviation(spark):
    one = spark.createDataFrame([(5.0,)], "v double")
    assert profile.column_anomalies(one, "v").first().is_anomaly is False


def test_preview(df):
    assert [r.key for r in profile.preview(df, 3, [F.desc("key")]).collect()] == [100, 99, 98]
    assert profile.preview(df).count() == 10


# ------------------------------------------------------------------- CSV

KINDS = {"i": "bigint", "f": "double", "b": "boolean", "O": "string"}

CSV = '''id,amount,rate,ok,maybe,when,city,empty,"with, comma"
1,10,1.5,True,true,2023-01-01,"Paris, FR",,a
2,NA,2e3,False,,2023-01-02,"say ""hi""",NULL,b
3, 30 ,-.5,TRUE,false,2023-01-03,n/a,nan,c
4,-40,+7.,false,TRUE,not a date,None,,None
'''


def test_csv_types_follow_pandas(spark, tmp_path):
    path = tmp_path / "upload.csv"
    path.write_text(CSV)
    expected = pd.read_csv(path)
    got = read_csv(spark, str(path))
    assert got.columns == expected.columns.tolist()
    for field in got.schema:
        assert field.dataType.simpleString() == KINDS[expected[field.name].dtype.kind], field
    rows = got.collect()
    assert len(rows) == len(expected)
    for row, (_, other) in zip(rows, expected.iterrows()):
        for name in ("id", "amount", "rate", "ok", "when", "city", "empty", "with, comma"):
            if pd.isna(other[name]):
                assert row[name] is None, name
            else:
                assert row[name] == other[name], name
    # A boolean column with a missing cell is no boolean column.
    assert profile.column_kinds(got).where("column_name = 'maybe'").first().kind == "text"
    assert profile.shape(got).first().missing_values == expected.isnull().sum().sum()


def test_missing_tokens_are_those_of_pandas(spark, tmp_path):
    path = tmp_path / "tokens.csv"
    path.write_text("n,token\n" + "".join(f"{i},{t}\n" for i, t in enumerate(MISSING_TOKENS)))
    assert pd.read_csv(path).token.isna().all()
    got = read_csv(spark, str(path))
    assert got.where("token IS NOT NULL").count() == 0
    assert got.schema["n"].dataType.simpleString() == "bigint"


def test_big_and_odd_numbers(spark, tmp_path):
    path = tmp_path / "numbers.csv"
    path.write_text("big,suffix,mixed\n99999999999999999999,1d,1\n1,2f,x\n")
    got = read_csv(spark, str(path))
    assert [f.dataType.simpleString() for f in got.schema] == ["double", "string", "string"]
    assert math.isclose(got.first().big, 1e20)


def test_infinities_are_numbers(spark, tmp_path):
    path = tmp_path / "infinite.csv"
    path.write_text("a,b\ninf,1\n-Infinity,infinite\n+Inf,2\n1.5,3\n")
    expected = pd.read_csv(path)
    got = read_csv(spark, str(path))
    assert [KINDS[expected[f.name].dtype.kind] for f in got.schema] == [
        f.dataType.simpleString() for f in got.schema
    ]
    assert [r.a for r in got.collect()] == expected.a.tolist()


def test_line_breaks_in_quotes(spark, tmp_path):
    path = tmp_path / "lines.csv"
    path.write_text('a,b\n1,"two\nlines"\n')
    assert [tuple(r) for r in read_csv(spark, str(path)).collect()] == [(1, "two\nlines")]


@pytest.mark.parametrize("multi_line", [True, False])
def test_short_and_long_rows(spark, tmp_path, multi_line):
    path = tmp_path / "rows.csv"
    path.write_text("a,b\n1,2\n3\n")
    assert [tuple(r) for r in read_csv(spark, str(path), multi_line).collect()] == [(1, 2.0), (3, None)]
    path.write_text('a,b\n1,2,,\n3,"x,y"\n"p ""q,r"" s, t",, \n')
    assert [tuple(r) for r in read_csv(spark, str(path), multi_line).collect()] == [("1", "2"), ("3", "x,y"), ('p "q,r" s, t', None)]
    for row in ("1,2,3", "3,4,,5", ",,3", '1,2,"x"', "3,4,,,,,,,,5", '"a,b","c,d","e"'):
        path.write_text(f"a,b\n1,2\n{row}\n6,7\n")
        with pytest.raises(ValueError, match="more cells"):
            read_csv(spark, str(path), multi_line)


def test_long_rows_with_line_breaks(spark, tmp_path):
    path = tmp_path / "rows.csv"
    path.write_text('a,b\n1,"two, with a comma\nand a line"\n3,4\n')
    assert [tuple(r) for r in read_csv(spark, str(path)).collect()] == [(1, "two, with a comma\nand a line"), (3, "4")]
    path.write_text('a,b\n1,"two, with a comma\nand a line",,"x"\n3,4\n')
    with pytest.raises(ValueError, match="and a line"):
        read_csv(spark, str(path))
