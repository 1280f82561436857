"""Profile of any table: size, gaps, kinds, statistics, series and outliers."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, FloatType, NumericType

from basketry.functions.columns import percent, without_nan
from basketry.operators.ranking import extremes, order_statistics
from basketry.plans.scratch import Scratch, materialize

QUARTILES = {"p25": 0.25, "p50": 0.50, "p75": 0.75}


def _cell(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")


def _present(df: DataFrame, name: str) -> Column:
    """The cell, NULL when missing; NaN counts as missing."""
    floating = isinstance(df.schema[name].dataType, (DoubleType, FloatType))
    return without_nan(_cell(name)) if floating else _cell(name)


def _number(df: DataFrame, name: str) -> Column:
    return _present(df, name).cast("double")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    """Everything that is neither a number nor a boolean; dates count as text."""
    return [f.name for f in df.schema if not isinstance(f.dataType, (NumericType, BooleanType))]


def column_kinds(df: DataFrame) -> DataFrame:
    """(column_name, kind, present) for numeric and text columns."""
    kinds = {c: "numeric" for c in numeric_columns(df)} | {c: "text" for c in text_columns(df)}
    return _per_column(
        df,
        [c for c in df.columns if c in kinds],
        {"present": lambda c: F.count(_present(df, c))},
        kinds=kinds,
    )


def _per_column(df: DataFrame, columns: Sequence[str], measures: dict, kinds=None) -> DataFrame:
    """One pass over the table, then one output row per column."""
    wide = df.agg(
        *[make(c).alias(f"{m}_{i}") for i, c in enumerate(columns) for m, make in measures.items()]
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            *([F.lit(kinds[c]).alias("kind")] if kinds else []),
            *[F.col(f"{m}_{i}").alias(m) for m in measures],
        )
        for i, c in enumerate(columns)
    ]
    return wide.select(F.inline(F.array(*rows)))


def preview(df: DataFrame, n: int = 10, order_by: Sequence[str | Column] = ()) -> DataFrame:
    """The first n rows; name an order to make them the same every time."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def shape(df: DataFrame) -> DataFrame:
    """Rows, columns and missing cells."""
    missing = sum((F.count_if(_present(df, c).isNull()) for c in df.columns), F.lit(0))
    return df.agg(
        F.count("*").alias("n_rows"),
        F.lit(len(df.columns)).cast("long").alias("n_columns"),
        missing.cast("long").alias("missing_values"),
    )


def missing_by_column(df: DataFrame) -> DataFrame:
    """Columns with missing cells, and how many."""
    nulls = _per_column(
        df, df.columns, {"nulls": lambda c: F.count_if(_present(df, c).isNull())}
    )
    return nulls.where("nulls > 0")


def describe(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    approximate: bool = False,
) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles per numeric column, to 2 places.

    A table without numeric columns is described by :func:`describe_text`.
    Quartiles interpolate linearly between neighbouring values. Spark's exact
    ``percentile`` gathers every distinct value of a column in one task, so
    they come from ``order_statistics``; ``approximate``
    uses Spark's percentile sketch instead.
    """
    columns = list(columns or numeric_columns(df))
    if not columns:
        return describe_text(df)
    numbers = df.select(*[_number(df, c).alias(c) for c in columns])
    def to_places(value: Column) -> Column:
        return F.bround(value, 2)

    def summary(quartile: Callable[[str, float], Column]) -> DataFrame:
        measures = {
            "count": lambda c: F.count(_cell(c)),
            "mean": lambda c: to_places(F.avg(_cell(c))),
            "std": lambda c: to_places(F.stddev_samp(_cell(c))),
            "min": lambda c: to_places(F.min(_cell(c))),
            **{
                name: lambda c, p=p: to_places(quartile(c, p)) for name, p in QUARTILES.items()
            },
            "max": lambda c: to_places(F.max(_cell(c))),
        }
        return _per_column(numbers, columns, measures)

    if approximate:
        return summary(lambda c, p: F.percentile_approx(_cell(c), p, 10_000))
    exact = _exact_quantiles(numbers, columns, list(QUARTILES.values()))
    return summary(lambda c, p: F.lit(exact[c][p]).cast("double"))


def _exact_quantiles(
    numbers: DataFrame, columns: Sequence[str], shares: Sequence[float]
) -> dict[str, dict[float, float | None]]:
    """Linearly interpolated quantiles of double columns."""
    plain = numbers.select(*[_cell(c).alias(f"n{i}") for i, c in enumerate(columns)])
    facts = plain.agg(*extremes(plain.columns)).first()
    last = {name: facts[name].present - 1 for name in plain.columns}

    def neighbours(name: str, share: float) -> tuple[int, int, float]:
        place = share * last[name]
        low = int(place)
        return low, min(low + 1, last[name]), place - low

    filled = [name for name in plain.columns if last[name] >= 0]
    ranks = {
        name: sorted({rank for share in shares for rank in neighbours(name, share)[:2]})
        for name in filled
    }
    values = order_statistics(plain, ranks, facts.asDict())

    def quantile(name: str, share: float) -> float | None:
        if name not in ranks:
            return None
        low, high, beyond = neighbours(name, share)
        start, end = values[name][low][0], values[name][high][0]
        if beyond == 0 or start == end:
            return start
        # Weighted ends: their difference may be no finite double.
        return (1 - beyond) * start + beyond * end

    return {
        column: {share: quantile(name, share) for share in shares}
        for name, column in zip(plain.columns, columns)
    }


# A most frequent value is looked up among so many equally frequent ones without a join.
TIED_VALUES = 1_000


def describe_text(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, count, unique, top, freq) per text column: present cells, distinct ones, the most frequent.

    Everything is exact. Cells that are no strings count as their text; of equally frequent values the smallest is
    the top; a column without values has no top and a NULL freq. One pass counts the distinct values of all columns, by 128 bits of hash:
    what is shuffled, and kept in the shared folder meanwhile, is a few bytes per distinct value, however long the texts. A second pass
    looks up which text the most frequent hash stands for. Only where more than ``TIED_VALUES`` values are equally frequent, more than
    once each, does their column take a join.
    """
    columns = list(columns or text_columns(df))
    if not columns:
        raise ValueError("no column to describe")
    texts = df.select(*[_present(df, c).cast("string").alias(f"t{i}") for i, c in enumerate(columns)])
    prints = {i: F.struct(F.xxhash64(f"t{i}").alias("a"), F.xxhash64(F.lit(i), F.col(f"t{i}")).alias("b")) for i in range(len(columns))}
    cells = F.array(*[F.when(F.col(f"t{i}").isNotNull(), F.struct(F.lit(i).alias("i"), prints[i].alias("print"))) for i in prints])
    each = texts.select(F.explode(F.filter(cells, lambda c: c.isNotNull())).alias("cell")).select("cell.i", "cell.print.a", "cell.print.b")
    often = each.groupBy("i", "a", "b").agg(F.count("*").alias("n"))
    with Scratch(df.sparkSession, "describe") as scratch:
        often = materialize(often, "values", scratch)
        per_column = often.groupBy("i").agg(F.sum("n").alias("count"), F.count("*").alias("unique"), F.max("n").alias("freq"))
        # One row per column.
        facts = {r.i: r for r in per_column.collect()}
        tops = _tops(texts, prints, often, facts)
    rows = [
        (c, facts[i]["count"], facts[i].unique, tops[f"t{i}"], facts[i].freq) if i in facts else (c, 0, 0, None, None)
        for i, c in enumerate(columns)
    ]
    return df.sparkSession.createDataFrame(rows, "column_name string, count long, unique long, top string, freq long")


def _tops(texts: DataFrame, prints: Mapping[int, Column], often: DataFrame, facts: Mapping[int, Row]) -> dict[str, str]:
    """The smallest of the most frequent texts of each column that has any."""
    # Where no value repeats, all are equally frequent.
    repeating = {i: r.freq for i, r in facts.items() if r.freq > 1}
    most = often.where(reduce(lambda x, y: x | y, ((F.col("i") == i) & (F.col("n") == n) for i, n in repeating.items()), F.lit(False)))
    tied = {r.i: r.n for r in most.groupBy("i").agg(F.count("*").alias("n")).collect()}
    few = [i for i, n in tied.items() if n <= TIED_VALUES]
    known: dict[int, list[Row]] = {}
    for r in most.where(F.col("i").isin(*few)).collect() if few else []:
        known.setdefault(r.i, []).append(r)

    def is_top(i: int) -> Column:
        a, b = prints[i].getField("a"), prints[i].getField("b")
        return a.isin(*[r.a for r in known[i]]) & b.isin(*[r.b for r in known[i]])

    smallest = {i: F.min(F.when(is_top(i), F.col(f"t{i}")) if i in known else F.col(f"t{i}")) for i in facts if i not in tied or i in known}
    tops = texts.agg(*[value.alias(f"t{i}") for i, value in smallest.items()]).first().asDict() if smallest else {}
    for i in set(tied) - set(known):
        text = texts.select(F.col(f"t{i}").alias("text"), prints[i].alias("print")).where("text IS NOT NULL")
        winners = most.where(F.col("i") == i).select(F.struct("a", "b").alias("print"))
        tops[f"t{i}"] = text.join(winners, "print", "left_semi").agg(F.min("text")).first()[0]
    return tops


# ---------------------------------------------------------------- series


def bar_series(df: DataFrame, x: str, y: str) -> DataFrame:
    """Bar heights: rows with the same x stack up."""
    return df.groupBy(_cell(x).alias("x")).agg(F.sum(_present(df, y)).alias("y"))


def xy_series(df: DataFrame, x: str, y: str, line: bool = False) -> DataFrame:
    """Points of a scatter, or of a line drawn in x order."""
    points = df.select(_cell(x).alias("x"), _cell(y).alias("y"))
    return points.orderBy("x", "y") if line else points


def histogram(df: DataFrame, column: str, bins: int | None = None) -> DataFrame:
    """(bin, bin_start, bin_end, count): equal-width bins between the smallest and the largest value, empty ones too.

    The largest value belongs to the last bin. Without a number of bins it is Sturges' rule, 1 + log2 of the number
    of values, rounded up. NULL, NaN and infinite values stand in no bin; a column of one value has
    one bin of no width, a column without finite values none.
    """
    value = _number(df, column)
    values = df.select(F.when(F.abs(value) < math.inf, value).alias("v")).where("v IS NOT NULL")
    # One pass: a row that every bin is computed from.
    facts = values.agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count("v").alias("n"))
    wanted = F.lit(bins).cast("long") if bins is not None else (F.ceil(F.log2("n")) + 1).cast("long")
    # Half the scale where the width of all bins is no finite double.
    facts = facts.where("n > 0").select(
        "low",
        F.when(F.col("high") - F.col("low") < math.inf, 1.0).otherwise(0.5).alias("scale"),
        "high",
        F.when(F.col("low") == F.col("high"), F.lit(1).cast("long")).otherwise(wanted).alias("bins"),
    )
    facts = facts.select(
        "low", "scale", "bins",
        ((F.col("high") * F.col("scale") - F.col("low") * F.col("scale")) / F.col("bins")).alias("width"),
    )
    low, scale, width, n_bins = (facts.select(c).scalar() for c in ("low", "scale", "width", "bins"))
    place = F.coalesce(F.floor((F.col("v") * scale - low * scale) / F.nullif(width, F.lit(0.0))), F.lit(0))
    counted = values.groupBy(F.least(place.cast("long"), n_bins - 1).alias("bin")).agg(F.count("*").alias("count"))
    frame = facts.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bins") - 1)).alias("bin"))

    def edge(number: Column) -> Column:
        return (F.col("low") * F.col("scale") + number * F.col("width")) / F.col("scale")

    return (
        frame.join(counted, "bin", "left")
        .select(
            "bin",
            edge(F.col("bin")).alias("bin_start"),
            edge(F.col("bin") + 1).alias("bin_end"),
            F.coalesce("count", F.lit(0)).alias("count"),
        )
        .orderBy("bin")
    )


# -------------------------------------------------------------- outliers


def column_anomalies(df: DataFrame, column: str) -> DataFrame:
    """Every row, with a flag for values beyond 2 standard deviations of the mean.

    A missing value, or a column whose deviation is undefined, is never flagged.
    """
    value = _number(df, column)
    # Two scalar subqueries, which Spark answers with one pass over the column.
    mean, deviation = df.agg(F.avg(value)).scalar(), df.agg(F.stddev_samp(value)).scalar()
    far = F.abs(value - mean) > 2 * deviation
    return df.withColumn("is_anomaly", F.coalesce(far, F.lit(False)))


def anomaly_summary(df: DataFrame, column: str) -> DataFrame:
    value = _number(df, column)
    anomalies, rows = F.count_if("is_anomaly"), F.count("*")
    return column_anomalies(df, column).agg(
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        anomalies.alias("anomalies"),
        rows.alias("n_rows"),
        percent(anomalies, rows).alias("anomaly_pct"),
    )


def anomaly_sample(
    df: DataFrame, column: str, n: int = 10, order_by: Sequence[str | Column] = ()
) -> DataFrame:
    """The first n flagged rows, without the flag."""
    flagged = column_anomalies(df, column).where("is_anomaly").drop("is_anomaly")
    return preview(flagged, n, order_by)
