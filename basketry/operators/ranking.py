"""Exact ranks over a whole table without moving the table.

NTILE over everything needs no global sort: a row's tile follows from comparing it
with the k-1 rows that open a new tile. Those cut rows are order statistics, and
an order statistic can be found by counting: build a histogram, pick the bucket
that holds the wanted rank, look into that bucket with a finer histogram, and so
on until one value is left. Every round is a map-side aggregation that shuffles
only bucket counts; the ranked rows are never shuffled, sorted or collected, and
a value shared by any number of rows costs nothing extra.
"""

from __future__ import annotations

import math
import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from basketry.functions.columns import without_nan

NUMBER_BUCKETS = 2048
TIE_STEP = 2  # bytes resolved per round: at most 65,536 buckets
TIES_READ = 1_000  # rows of a tie that are read instead of counted on


# ------------------------------------------------------ order statistics


@dataclass(frozen=True)
class _Span:
    """An interval known to hold some wanted ranks of one column."""

    column: str
    low: float
    high: float
    below: int  # rows with a value under ``low``
    ranks: tuple[int, ...]

    def holds(self) -> Column:
        return F.col(self.column).between(self.low, self.high)

    def many_magnitudes(self) -> bool:
        ends = sorted((abs(self.low), abs(self.high)))
        return self.low <= 0 <= self.high or ends[1] / NUMBER_BUCKETS > ends[0]

    def bucket(self) -> Column:
        """Place of a value on a grid over the interval, in value order; every step is monotonic.

        An interval over many magnitudes is cut by sign and exponent first, about 2,100 buckets of each
        sign. The even grid after that gains 11 of the 53 bits of a double per round, so the
        number of rounds does not depend on the values.
        """
        if self.many_magnitudes():
            value = F.col(self.column)
            exponent = F.floor(F.log2(F.abs(value))) + 1100
            return F.when(value > 0, exponent).when(value < 0, -exponent).otherwise(F.lit(0))
        # Half the scale where the width is no finite double.
        scale = 1.0 if math.isfinite(self.high - self.low) else 0.5
        start, width = self.low * scale, self.high * scale - self.low * scale
        place = (F.col(self.column) * scale - start) / width * NUMBER_BUCKETS
        return F.least(F.floor(place), F.lit(NUMBER_BUCKETS - 1))


@dataclass(frozen=True)
class _Prefix:
    """Rows sharing a key and the start of their tie text, holding some wanted ranks."""

    column: str
    key: float | None
    start: bytes
    below: int  # rows with this key and a smaller tie text
    ranks: tuple[int, ...]

    def holds(self) -> Column:
        same = F.col(self.column).eqNullSafe(F.lit(self.key).cast("double"))
        return same & F.startswith(_bytes(F.col("tie")), F.lit(self.start))

    def bucket(self) -> Column:
        return F.substring(_bytes(F.col("tie")), len(self.start) + 1, TIE_STEP)


def _bytes(text: Column) -> Column:
    """UTF-8, whose byte order is that of Spark's strings."""
    return text.cast("binary")


def _histogram(
    df: DataFrame, spans: Sequence[_Span | _Prefix], value: bool, *measures: Column
) -> DataFrame:
    """Rows per span and bucket.

    The spans of one column are disjoint, so a row enters at most one of them.
    """
    entries: dict[str, Column] = {}
    for index, span in enumerate(spans):
        fields = [F.lit(index).alias("span"), span.bucket().alias("bucket")]
        if value:
            fields.append(F.col(span.column).alias("value"))
        chain = entries.get(span.column, F)
        entries[span.column] = chain.when(span.holds(), F.struct(*fields))
    placed = df.select(F.inline(F.array(*entries.values()))).where(F.col("span").isNotNull())
    return placed.groupBy("span", "bucket").agg(F.count("*").alias("rows"), *measures)


def _pick_buckets(histogram: DataFrame, spans: Sequence[_Span | _Prefix]) -> list[Row]:
    """The bucket of each wanted rank, with the rows of its span before it.

    A histogram has a bounded number of buckets per span, so its running total is cheap.
    """
    wanted = [
        F.array(*[F.lit(rank - span.below).cast("long") for rank in span.ranks]) for span in spans
    ]
    of_span = F.element_at(F.array(*wanted), F.col("span") + 1)
    upto = F.sum("rows").over(Window.partitionBy("span").orderBy("bucket"))
    running = histogram.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("rows"))
    inside = F.filter(
        of_span, lambda target: (target >= F.col("before")) & (target < F.col("upto"))
    )
    # A handful of targets.
    return running.withColumn("target", F.explode(inside)).collect()


def _finite(name: str) -> Column:
    """A column without its infinities: they rank first and last, and are counted apart."""
    return F.when(F.abs(F.col(name)) < math.inf, F.col(name))


def extremes(columns: Sequence[str]) -> list[Column]:
    """Aggregates of each column: non-NULL rows, infinite rows at both ends, range of the finite ones."""
    return [
        F.struct(
            F.count(c).alias("present"),
            F.count_if(F.col(c) == -math.inf).alias("lowest"),
            F.count_if(F.col(c) == math.inf).alias("highest"),
            F.min(_finite(c)).alias("low"),
            F.max(_finite(c)).alias("high"),
        ).alias(c)
        for c in columns
    ]


def order_statistics(
    df: DataFrame, ranks: Mapping[str, Sequence[int]], ranges: Mapping[str, Row]
) -> dict[str, dict[int, tuple[float, int]]]:
    """Exact values at 0-based ascending ranks of double columns.

    NULLs are ignored; NaN must have been turned into NULL. ``ranges`` comes from
    ``extremes``. The answer maps ``column -> rank -> (value, rows with a smaller value)``.
    """
    found: dict[str, dict[int, tuple[float, int]]] = {column: {} for column in ranks}
    columns = [column for column, wanted in ranks.items() if wanted]
    narrow = df.select(*[_finite(c).alias(c) for c in columns])
    spans = []
    for c in columns:
        facts = ranges[c]
        top = facts.present - facts.highest
        inner = []
        for rank in sorted(set(ranks[c])):
            if rank < facts.lowest:
                found[c][rank] = (-math.inf, 0)
            elif rank >= top:
                found[c][rank] = (math.inf, top)
            else:
                inner.append(rank)
        if inner:
            spans.append(_Span(c, facts.low, facts.high, facts.lowest, tuple(inner)))
    while spans:
        for span in spans:
            if span.low == span.high:
                found[span.column].update({r: (span.low, span.below) for r in span.ranks})
        spans = [span for span in spans if span.low < span.high]
        if not spans:
            break
        histogram = _histogram(
            narrow, spans, True, F.min("value").alias("low"), F.max("value").alias("high")
        )
        narrower: dict[tuple, list[int]] = {}
        for hit in _pick_buckets(histogram, spans):
            parent = spans[hit.span]
            key = (parent.column, hit.low, hit.high, parent.below + hit.before)
            narrower.setdefault(key, []).append(parent.below + hit.target)
        spans = [_Span(*key, tuple(sorted(inside))) for key, inside in narrower.items()]
    return found


def _tie_texts(
    keyed: DataFrame, common: str, ranks: Mapping[tuple[str, float | None], Sequence[int]]
) -> dict[tuple[str, float | None, int], str]:
    """Exact tie texts at ranks among the rows sharing a (column, key).

    Works along the text, two bytes per round: rows sharing the known start
    are counted by their next bytes. All texts start with ``common``. A bucket of few rows ends the
    rounds: its texts are read and put in order, so their length does not matter.
    """
    found: dict[tuple[str, float | None, int], str] = {}
    few: list[_Prefix] = []
    spans = [_Prefix(*place, common.encode(), 0, tuple(wanted)) for place, wanted in ranks.items()]
    while spans:
        longer: dict[tuple, list[int]] = {}
        short: dict[tuple, list[int]] = {}
        for hit in _pick_buckets(_histogram(keyed, spans, False), spans):
            parent = spans[hit.span]
            text, rank = parent.start + bytes(hit.bucket), parent.below + hit.target
            key = (parent.column, parent.key, text, parent.below + hit.before)
            if len(hit.bucket) < TIE_STEP:
                found[parent.column, parent.key, rank] = text.decode()
            else:
                (short if hit.rows <= TIES_READ else longer).setdefault(key, []).append(rank)
        few += [_Prefix(*key, tuple(inside)) for key, inside in short.items()]
        spans = [_Prefix(*key, tuple(sorted(inside))) for key, inside in longer.items()]
    return found | _read_ties(keyed, few)


def _read_ties(keyed: DataFrame, spans: Sequence[_Prefix]) -> dict[tuple[str, float | None, int], str]:
    """The wanted texts of spans of at most ``TIES_READ`` rows each, a handful, in one pass."""
    if not spans:
        return {}
    # A row may lie in spans of several columns.
    inside = F.array(*[F.when(span.holds(), F.lit(i)) for i, span in enumerate(spans)])
    rows = keyed.select("tie", F.explode(F.filter(inside, lambda i: i.isNotNull())).alias("span")).collect()
    texts: dict[int, list[bytes]] = {}
    for row in rows:
        texts.setdefault(row.span, []).append(row.tie.encode())
    return {
        (span.column, span.key, rank): sorted(texts[i])[rank - span.below].decode()
        for i, span in enumerate(spans)
        for rank in span.ranks
    }


# ----------------------------------------------------------------- NTILE


@dataclass(frozen=True)
class Score:
    """A tile number to add: ascending by a numeric key, missing keys at one end."""

    name: str
    key: Column
    nulls_last: bool = False

    @property
    def number(self) -> Column:
        return without_nan(self.key.cast("double"))


@dataclass(frozen=True)
class _Cut:
    """The first row of a tile: its key (None in the missing end) and its rank there."""

    score: Score
    column: str
    value: float | None
    offset: int  # rank among the rows sharing the key

    def reached(self, tie: Column, tie_value: str | None) -> Column:
        """Whether a row comes at or after this cut."""
        key = self.score.number
        if self.value is None:
            later = F.lit(False) if self.score.nulls_last else key.isNotNull()
        else:
            later = F.coalesce(key > self.value, F.lit(self.score.nulls_last))
        same = key.eqNullSafe(F.lit(self.value).cast("double"))
        return later | (same if tie_value is None else same & (tie >= tie_value))


def tile_starts(rows: int, tiles: int) -> list[int]:
    """0-based ranks at which tiles 2..k begin: sizes differ by at most one, larger first."""
    size, larger = divmod(rows, tiles)
    starts = [i * size + min(i, larger) for i in range(1, tiles)]
    return [start for start in starts if start < rows]


def global_ntile(
    df: DataFrame,
    scores: Sequence[Score],
    tie: str,
    tiles: int = 5,
) -> DataFrame:
    """Add NTILE columns over the whole table, ties broken by a unique text column.

    ``df`` is read several times: pass a stored table, not an expensive plan.
    """
    # A leading mark makes a missing tie value sort before any other.
    tie_text = F.coalesce(F.concat(F.lit("1"), F.col(tie)), F.lit("0"))
    columns = {s.name: f"key_{i}" for i, s in enumerate(scores)}
    keyed = df.select(
        tie_text.alias("tie"), *[s.number.alias(columns[s.name]) for s in scores]
    )
    facts = keyed.agg(
        F.count("*").alias("rows"),
        F.min("tie").alias("tie_low"),
        F.max("tie").alias("tie_high"),
        *extremes(list(columns.values())),
    ).first()
    cuts = _find_cuts(keyed, scores, columns, facts, tile_starts(facts["rows"], tiles))
    # A cut at the first of the rows sharing its key needs no tie text.
    inner: dict[tuple[str, float | None], list[int]] = {}
    for cut in cuts:
        if cut.offset > 0:
            inner.setdefault((cut.column, cut.value), []).append(cut.offset)
    common = os.path.commonprefix([facts["tie_low"], facts["tie_high"]])
    texts = _tie_texts(keyed, common, inner)

    tile = {s.name: F.lit(1).cast("long") for s in scores}
    for cut in cuts:
        reached = cut.reached(tie_text, texts.get((cut.column, cut.value, cut.offset)))
        tile[cut.score.name] = tile[cut.score.name] + reached.cast("long")
    return df.select("*", *[number.alias(name) for name, number in tile.items()])


def _find_cuts(
    keyed: DataFrame, scores: Sequence[Score], columns: dict[str, str], facts: Row, starts: list[int]
) -> list[_Cut]:
    # Ranks among the present keys; the missing ones fill one end.
    present = {c: facts[c].present for c in columns.values()}
    shift = {
        columns[s.name]: 0 if s.nulls_last else facts["rows"] - present[columns[s.name]]
        for s in scores
    }
    ranks = {
        c: [start - shift[c] for start in starts if 0 <= start - shift[c] < present[c]]
        for c in columns.values()
    }
    values = order_statistics(keyed, ranks, facts.asDict())
    cuts = []
    for score in scores:
        column = columns[score.name]
        for start in starts:
            rank = start - shift[column]
            if rank in values[column]:
                value, below = values[column][rank]
                cuts.append(_Cut(score, column, value, rank - below))
            else:
                missing_from = present[column] if score.nulls_last else 0
                cuts.append(_Cut(score, column, None, start - missing_from))
    return cuts
