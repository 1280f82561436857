"""Fuzzy duplicate lines: MinHash bands, exact Jaccard verification, one line kept per component.

A line is what stands between line feeds, trimmed, lower-cased in A-Z. Lines that are then equal are
one line, named by a 64-bit hash. Its shingles are all runs of ``chars`` characters (the whole line, if
shorter). They are dealt over ``bands * rows`` bins by their hash, the smallest hash of a bin is one
MinHash value (one-permutation hashing), and empty bins borrow from bins that a fixed sequence of
draws names (densification). Lines that agree in all rows of a band are candidates; what decides is
the Jaccard similarity of their shingles.

Twelve bands of five find 99.1% of the pairs at a similarity of 0.8 and 99.96% at 0.85. Of a line's shingles a
bitmap holds which places an odd number of them fall on. Two lines have at least as many different shingles as their
bitmaps have different bits, so candidates with too many are not verified, and no similar pair is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm import utf8
from basketry.llm.graph import linked_components, most_shared_centres, shared_buckets
from basketry.llm.storage import stored

_BASE = 0x9E3779B97F4A7C15
LEAST_BITS = 64
_DRAWS = 200  # borrowed bins: so many draws, then the next filled bin to the right


def _lines(data: np.ndarray, offsets: np.ndarray):
    """Trimmed, non-blank lines of a run of texts: text index, line number, start, end."""
    feeds = np.flatnonzero(data == 0x0A)
    starts = np.concatenate([offsets[:-1], feeds + 1])
    text = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, feeds, "right") - 1])
    order = np.lexsort((starts, text))
    starts, text = starts[order], text[order]
    ends = np.empty_like(starts)
    ends[:-1] = starts[1:] - 1
    last = np.append(text[1:] != text[:-1], True)
    ends[last] = offsets[text[last] + 1]
    number = np.arange(len(starts)) - np.searchsorted(text, text)
    solid = np.flatnonzero(~utf8.IS_SPACE[data])
    a, b = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    full = np.flatnonzero(b > a)
    return text[full], number[full], solid[a[full]], solid[b[full] - 1] + 1


def _windows(points: np.ndarray, n: int) -> np.ndarray:
    """A hash of every run of n numbers, from those of half as many."""
    if n == 1:
        return points
    half = _windows(points, n // 2)
    if len(half) <= n - n // 2:
        return half[:0]
    pairs = half[: -(n // 2)] * np.uint64(pow(_BASE, n // 2, 2**64)) + half[n // 2 :]
    return pairs if n % 2 == 0 else pairs[:-1] * np.uint64(_BASE) + points[n - 1 :]


def _code_points(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A number per character: its bytes, as one number."""
    points = data[at].astype(np.uint64)
    more = np.flatnonzero(points >= 0xC0)
    if len(more):
        size = np.diff(np.append(at, len(data)))[more]
        value = points[more]
        for k in range(1, 4):
            longer = np.flatnonzero(size > k)
            value[longer] = (value[longer] << np.uint64(8)) | data[at[more[longer]] + k]
        points[more] = value
    return points


def _shingles(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, chars: int):
    """Hashes of the character shingles of every span, and the span each belongs to; spans do not overlap."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], ends[order]
    at = np.flatnonzero((data & 0xC0) != 0x80)
    a, b = np.searchsorted(at, starts), np.searchsorted(at, ends)
    short = np.flatnonzero(b - a < chars)
    windows = _windows(utf8.mix(_code_points(data, at) + np.uint64(1)), chars)
    # A window counts for the span that it begins and ends in.
    step = np.zeros(len(windows) + 1, np.int8)
    long_ = np.flatnonzero(b - a >= chars)
    step[a[long_]] += 1
    step[b[long_] - chars + 1] -= 1
    inside = np.flatnonzero(np.cumsum(step[:-1], dtype=np.int8))
    hashes = utf8.mix(windows[inside])
    line = np.repeat(long_, b[long_] - a[long_] - chars + 1)
    if len(short):
        whole = utf8.span_hashes(data, starts[short], ends[short])
        hashes, line = np.concatenate([hashes, whole]), np.concatenate([line, short])
    return hashes, order[line]


def _least(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, chars: int, bins: int) -> np.ndarray:
    """One-permutation MinHash values of every span, empty bins filled by borrowing."""
    n = len(starts)
    hashes, line = _shingles(data, starts, ends, chars)
    bin_ = ((hashes >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
    none = np.uint64(2**64 - 1)
    values = np.full(n * bins, none, np.uint64)
    np.minimum.at(values, line * bins + bin_.astype(np.int64), hashes & np.uint64(0xFFFFFFFF))
    values = values.reshape(n, bins)
    given = values != none
    who, where = np.nonzero(~given)
    draw = np.random.default_rng(7).integers(0, bins, (_DRAWS, bins))
    for k in range(_DRAWS):
        if not len(who):
            break
        source = draw[k][where]
        hit = given[who, source]
        values[who[hit], where[hit]] = values[who[hit], source[hit]] + np.uint64((k + 1) << 32)
        who, where = who[~hit], where[~hit]
    for step in range(1, bins):
        if not len(who):
            break
        source = (where + step) % bins
        hit = given[who, source]
        values[who[hit], where[hit]] = values[who[hit], source[hit]] + np.uint64((_DRAWS + step) << 32)
        who, where = who[~hit], where[~hit]
    return values


def _bands(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, chars: int, bands: int, rows: int) -> np.ndarray:
    values = _least(data, starts, ends, chars, bands * rows)
    out = np.empty((len(starts), bands), np.uint64)
    for k in range(bands):
        key = np.full(len(starts), k + 1, np.uint64)
        for r in range(rows):
            key = utf8.mix(key * np.uint64(31) + values[:, k * rows + r])
        out[:, k] = key
    return out


def _each_line(batches: Iterator[pa.RecordBatch], of_lines) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, data, offsets in utf8.texts(batch.column("text")):
            folded = utf8.LOWER[data]
            text, number, starts, ends = _lines(folded, offsets)
            ids = utf8.span_hashes(folded, starts, ends)
            yield from of_lines(batch, first, end, folded, text, number, starts, ends, ids)


def _occurrences(batches):
    def rows(batch, first, end, data, text, number, starts, ends, ids):
        docs = [batch.column(c).slice(first, end - first).take(pa.array(text)) for c in ("doc_id", "text_id")]
        yield pa.RecordBatch.from_arrays(
            [*docs, pa.array(number.astype(np.int32)), pa.array(ids.view(np.int64))], ["doc_id", "text_id", "line", "id"]
        )

    return _each_line(batches, rows)


def _buckets(chars: int, bands: int, rows_per_band: int):
    def rows(batch, first, end, data, text, number, starts, ends, ids):
        ids, at = np.unique(ids, return_index=True)
        keys = _bands(data, starts[at], ends[at], chars, bands, rows_per_band)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(ids, bands).view(np.int64))], ["bucket", "id"]
        )

    return lambda batches: _each_line(batches, rows)


def _line_texts(batches):
    def rows(batch, first, end, data, text, number, starts, ends, ids):
        ids, at = np.unique(ids, return_index=True)
        values = [bytes(data[a:b]) for a, b in zip(starts[at], ends[at])]
        yield pa.RecordBatch.from_arrays([pa.array(ids.view(np.int64)), pa.array(values, pa.binary())], ["id", "value"])

    return _each_line(batches, rows)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column and the offsets of its values in them, without a copy."""
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


_ROW_BITS = 12  # rows of a piece; the other bits of a key are the shingle's hash


def _shingle_keys(values: pa.Array, chars: int) -> np.ndarray:
    """Distinct shingles of each of a few lines, sorted: the line's number and 52 bits of hash."""
    data, offsets = _bytes_of(values)
    hashes, row = _shingles(data, offsets[:-1], offsets[1:], chars)
    keys = (row.astype(np.uint64) << np.uint64(64 - _ROW_BITS)) | (hashes >> np.uint64(_ROW_BITS))
    keys.sort()
    fresh = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=fresh[1:])
    return keys[fresh]


def _row_counts(keys: np.ndarray, n: int) -> np.ndarray:
    return np.bincount((keys >> np.uint64(64 - _ROW_BITS)).astype(np.int64), minlength=n)


def _some(batch: pa.RecordBatch, *columns: str) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``SLICE_BYTES`` of lines and a bounded number of rows."""
    size = sum(np.diff(_bytes_of(batch.column(c))[1]) for c in columns)
    piece = np.cumsum(size) // utf8.SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1), len(batch)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        for first in range(a, b, 1 << _ROW_BITS):
            yield batch.slice(int(first), int(min(b - first, 1 << _ROW_BITS)))


def _verified(chars: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in _some(batch, "of_a", "of_b") if len(batch) else ():
                n = len(some)
                a, b = (_shingle_keys(some.column(c), chars) for c in ("of_a", "of_b"))
                both = np.concatenate([a, b])
                both.sort()
                shared = _row_counts(both[1:][both[1:] == both[:-1]], n)
                union = _row_counts(a, n) + _row_counts(b, n) - shared
                yield some.select(["a", "b"]).filter(pa.array(shared >= threshold * union - 1e-9))

    return run


DESCRIBED = "id long, n long, bits array<long>"


def _described(chars: int):
    """The number of shingles of a line, and a bitmap of one to two bits for each: where an odd number of them falls."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in _some(batch, "value") if len(batch) else ():
                keys = _shingle_keys(some.column("value"), chars)
                n = _row_counts(keys, len(some))
                size = np.left_shift(1, np.ceil(np.log2(np.maximum(n, LEAST_BITS))).astype(np.int64))
                begin = np.concatenate([np.zeros(1, np.int64), np.cumsum(size)])
                row = (keys >> np.uint64(64 - _ROW_BITS)).astype(np.int64)
                odd = np.bincount(begin[row] + (keys.view(np.int64) & (size[row] - 1)), minlength=begin[-1]) & 1
                words = np.packbits(odd.astype(bool), bitorder="little").view(np.int64)
                bits = pa.ListArray.from_arrays(pa.array(begin // 64, pa.int32()), pa.array(words))
                yield pa.RecordBatch.from_arrays([some.column("id"), pa.array(n, pa.int64()), bits], ["id", "n", "bits"])

    return run


def _may_reach(threshold: float):
    """Whether two lines can reach the Jaccard threshold, from what :func:`_described` says of them. Exact: none that does is passed over.

    The smaller set over the larger is the most they can have, and at the threshold (1 - threshold) / (1 + threshold) of both sizes together
    are shingles of one only. Each of these changes one bit, so no more bits can differ. The longer of two bitmaps is folded to the shorter.
    """
    apart = (1 - threshold) / (1 + threshold)

    def folded(bits: Column, size: Column) -> Column:
        half = F.zip_with(F.slice(bits, F.lit(1), size), F.slice(bits, size + 1, size), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(bits) == 2 * size, half).otherwise(bits)

    def possible(left, right):
        n_a, n_b, a, b = left("n"), right("n"), left("bits"), right("bits")
        size = F.least(F.size(a), F.size(b))
        bits = F.zip_with(folded(a, size), folded(b, size), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
        # Bitmaps of more than two sizes apart cannot be compared (NULL).
        differ = F.coalesce(F.aggregate(bits, F.lit(0), lambda total, x: total + x), F.lit(0))
        return (F.least(n_a, n_b) >= threshold * F.greatest(n_a, n_b) - 1e-6) & (differ <= apart * (n_a + n_b) + 1e-6)

    return possible


def text_id(text: Column) -> Column:
    return F.xxhash64(text.cast("string")).alias("text_id")


def line_classes(
    documents: DataFrame, threshold: float = 0.8, chars: int = 8, bands: int = 12, rows_per_band: int = 5
) -> DataFrame:
    """``(doc_id, text_id, line, id, class_id, kept)`` of every non-blank line of ``documents`` (doc_id, text).

    A document is named by its ``doc_id``, which may be NULL, and a hash of its whole text, ``text_id``, so
    that texts under one ``doc_id`` keep their lines apart.
    ``line`` counts from 0; ``id`` names the line's text, ``class_id`` its component. ``kept`` is true for the
    first line of each component, by ``doc_id`` (NULL first), text and line. NULL and empty texts have no lines.
    Repeated rows of one document hold the same lines at the same places, so each keeps them.
    """
    rows = documents.select(F.col("doc_id").cast("long"), text_id(F.col("text")), F.col("text").cast("string"))
    lines = stored(rows.mapInArrow(_occurrences, "doc_id long, text_id long, line int, id long"))
    banded = rows.select("text").mapInArrow(_buckets(chars, bands, rows_per_band), "bucket long, id long")
    buckets = stored(shared_buckets(banded).distinct())
    candidates = buckets.select("id").distinct()
    values = (
        rows.select("text").mapInArrow(_line_texts, "id long, value binary")
        .join(candidates, "id", "left_semi")
        .groupBy("id").agg(F.first("value").alias("value"))
    )
    values = stored(values)

    def verify(pairs: DataFrame) -> DataFrame:
        a = values.select(F.col("id").alias("a"), F.col("value").alias("of_a"))
        b = values.select(F.col("id").alias("b"), F.col("value").alias("of_b"))
        return pairs.join(a, "a").join(b, "b").mapInArrow(_verified(chars, threshold), "a long, b long")

    described = values.mapInArrow(_described(chars), DESCRIBED)
    buckets = stored(most_shared_centres(buckets).join(described, "id"))
    found, _ = linked_components(buckets, verify, _may_reach(threshold))
    # Occurrences of one text shrink to its first before they meet the components.
    place = F.struct("doc_id", "text_id", "line")
    texts = lines.groupBy("id").agg(F.min(place).alias("place")).join(found, "id", "left")
    texts = texts.withColumn("class_id", F.coalesce("component", "id"))
    first = texts.groupBy("class_id").agg(F.min("place").alias("keeper"))
    texts = texts.join(first, "class_id").select("id", "class_id", "keeper")
    same = F.col("doc_id").eqNullSafe(F.col("keeper.doc_id")) & (F.col("text_id") == F.col("keeper.text_id"))
    same &= F.col("line") == F.col("keeper.line")
    return lines.join(texts, "id").select("doc_id", "text_id", "line", "id", "class_id", same.alias("kept"))


def line_report(documents: DataFrame, **options) -> DataFrame:
    """``(doc_id, n_lines, n_kept, dropped_lines, class_ids)`` of every row of ``documents`` (doc_id, text).

    Of its non-blank lines: how many, how many of them stay, the numbers of those that go (NULL without any line) and the
    class of each in order. Rows with one ``doc_id``, or none, answer each by its own text.
    """
    classes = line_classes(documents, **options)
    lines = classes.groupBy("doc_id", "text_id").agg(
        F.array_sort(F.collect_set(F.struct("line", "kept", "class_id"))).alias("lines")
    )
    lines = lines.select(F.col("doc_id").alias("of_id"), F.col("text_id").alias("of_text"), "lines")
    named = documents.select(F.col("doc_id"), text_id(F.col("text")))
    joined = named.join(lines, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_id") == F.col("of_text")), "left")
    kept = F.filter("lines", lambda line: line["kept"])
    gone = F.filter("lines", lambda line: ~line["kept"])
    return joined.select(
        "doc_id",
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size(kept), F.lit(0)).cast("long").alias("n_kept"),
        F.transform(gone, lambda line: line["line"]).alias("dropped_lines"),
        F.transform("lines", lambda line: line["class_id"]).alias("class_ids"),
    )


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, gone in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist()):
            if gone and text is not None:
                gone = set(gone)
                text = "\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone)
            texts.append(text)
        yield batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(texts, pa.string())).drop_columns(["gone"])


def dedup_lines(documents: DataFrame, **options) -> DataFrame:
    """``documents`` with each near-duplicate line kept once in the whole table.

    A document all of whose lines stand elsewhere has nothing of its own left and goes; one that had
    no lines from the start (NULL, empty, blank) stays as it is. Blank lines between kept ones stay.
    ``n_chars``, if there is one, follows the text. Other columns pass through, whatever their names.
    """
    classes = stored(line_classes(documents.select("doc_id", "text"), **options))
    per_document = classes.groupBy("doc_id", "text_id").agg(
        F.array_distinct(F.collect_list(F.when(~F.col("kept"), F.col("line")))).alias("gone"),
        F.max("kept").alias("some"),
    )
    per_document = per_document.where("size(gone) > 0").select(
        F.col("doc_id").alias("of"), F.col("text_id").alias("of_text"), "gone", "some"
    )
    kept = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))
    kept = kept.withColumn("text_id", text_id(F.col("row.text")))
    same = F.col("row.doc_id").eqNullSafe(F.col("of")) & (F.col("text_id") == F.col("of_text"))
    joined = kept.join(per_document, same, "left")
    joined = joined.where("some is null or some")
    frame = joined.select("row", F.col("row.text").alias("text"), "gone")
    schema = f"row {documents.schema.simpleString()}, text string"
    changed = frame.mapInArrow(_without, schema)
    fresh = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return changed.select(*[fresh.get(c, F.col(f"row.`{c}`")).alias(c) for c in documents.columns])
