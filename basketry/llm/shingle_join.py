"""Which documents share nearly all of their word shingles: an exact Jaccard self-join.

A set that must share 90% of another can miss few of its own shingles, so the first few of both,
in one common order, must already meet. Every proof below is for a threshold of 9/10 but uses only
``missing = floor(n / 10)``, the shingles one set can lack in its partner, and
``breaks = floor(n / 9)``, the shingles both together can lack (``(n + n') / 19`` with
``n' <= n / 0.9``); :func:`limits` has both for any threshold.

1. Documents with equal sets become one class, so copies cost nothing further on.
2. A set is cut into more parts, by ranges of the shingles' hash, than it and a partner can have
   differences. One part at least is then the same in both: a combination of some eight shingles.
   Empty parts say little: a set with more parts that hold something than it can have differences
   has some of these in common with its partner, and leaves the empty ones out. Each difference spoils one part, so
   of p parts that a set names and d differences p - d at least are common to both.
   Sets with fewer combinations in common with all others together have no partner. The number of parts must
   be the same for both, so it is fixed per size class, and a set takes part in its own class and,
   as the smaller partner, in the next. This step needs no statistics and leaves a small part of the corpus.
3. For the rest shingles are counted and sorted from rare to frequent. Prefixes of ``missing + breaks + 2``
   shingles hold ``breaks + 2`` shared ones, and so two shared shingles with none between them in
   either set. A rare shingle is a candidate by itself, frequent ones only as a combination of two
   neighbours; one of both must occur. Shingles that occur once match nothing: they are left out and
   lower ``missing`` and ``breaks`` of their set, often below zero.
4. Candidates are verified on the whole sets, and components follow (see ``graph``).
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm import utf8
from basketry.llm.graph import linked_components, shared_buckets
from basketry.llm.storage import stored

DIGEST = "doc_id long, n int, key_a long, key_b long"
SETS = "id long, n int, shingles array<long>"


def enough(overlap: Column, sizes: Column, threshold: Fraction) -> Column:
    """Whether an overlap reaches the Jaccard threshold, in whole numbers; ``sizes`` is the sum of both sets'."""
    num, den = threshold.numerator, threshold.denominator
    return overlap * (num + den) >= sizes * num


def limits(threshold: Fraction) -> tuple[Fraction, Fraction]:
    """Shares of a set's size: what it can lack in its partner, and what both can lack together."""
    t = threshold
    return 1 - t, (1 - t) / (1 + t) * (1 + 1 / t)


def _floor(n, share: Fraction):
    return n * share.numerator // share.denominator


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    flat = np.concatenate([*arrays, np.empty(0, np.uint64)]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def _sets(column: pa.Array, words_per_shingle: int) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    for first, end, data, offsets in utf8.texts(column):
        hashes, begins = utf8.words(data, offsets)
        yield first, end, [utf8.word_shingles(hashes[a:b], words_per_shingle) for a, b in zip(begins[:-1], begins[1:])]


def _keys(sets: list[np.ndarray]) -> np.ndarray:
    """Two independent 64-bit hashes of every set."""
    keys = np.zeros((2, len(sets)), np.uint64)
    for i, s in enumerate(sets):
        if len(s):
            rank = utf8.powers(len(s) + 1)[0][1:]
            keys[0, i] = utf8.mix((s * rank).sum(keepdims=True))[0]
            keys[1, i] = utf8.mix((utf8.mix(s) * rank).sum(keepdims=True))[0]
    return keys


def _digest(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, sets in _sets(batch.column("text"), k):
                size = np.array([len(s) for s in sets], np.int32)
                columns = [batch.column("doc_id").slice(first, end - first), pa.array(size)]
                columns += [pa.array(x.view(np.int64)) for x in _keys(sets)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "key_a", "key_b"])

    return run


def size_classes(n: int, threshold: Fraction) -> list[tuple[int, int]]:
    """The two size classes in which a set of n may meet partners, with the most differences of two such sets.

    A class ends below 1 / threshold times its start, so partners are of one class or of
    neighbouring ones. Sets of a class and the one before have at most ``2 * largest * (1 - t) / (1 + t)``
    differences. No difference means equal sets.
    """
    start, number, found = 1, 0, []
    while len(found) < 2:
        end = max(start + 1, -(-start * threshold.denominator // threshold.numerator))
        if n < end:
            found.append((number, _floor(2 * (end - 1), (1 - threshold) / (1 + threshold))))
        start, number = end, number + 1
    return found


def _combinations(k: int, threshold: Fraction):
    """(bucket, id, quota): a hash of each part of each set, named by the set's first key.

    The quota holds the size class, and how many of the set's parts in it a partner must share.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes: dict[int, list[tuple[int, int]]] = {}
        for batch in batches:
            seen: set[int] = set()  # copies within a batch count once
            for _, _, sets in _sets(batch.column("text"), k):
                buckets, ids, quotas = [], [], []
                for s, key in zip(sets, _keys(sets)[0]):
                    if not len(s) or int(key) in seen:
                        continue
                    seen.add(int(key))
                    if len(s) not in classes:
                        classes[len(s)] = size_classes(len(s), threshold)
                    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(utf8.mix(s))])
                    for number, differences in classes[len(s)]:
                        if differences:
                            parts = differences + differences // 8 + 3
                            part = ((s >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
                            cut = np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))
                            of_part = np.arange(parts, dtype=np.uint64) + np.uint64(number << 32)
                            bucket = utf8.mix(utf8.mix(of_part) + total[cut[1:]] - total[cut[:-1]])
                            solid = cut[1:] > cut[:-1]
                            if solid.sum() > differences:
                                bucket = bucket[solid]
                            buckets.append(bucket)
                            ids.append(np.full(len(bucket), key, np.uint64))
                            quotas.append(np.full(len(bucket), (number << 32) + len(bucket) - differences, np.uint64))
                if buckets:
                    columns = [pa.array(np.concatenate(x).view(np.int64)) for x in (buckets, ids, quotas)]
                    yield pa.RecordBatch.from_arrays(columns, ["bucket", "id", "quota"])

    return run


def _whole_sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, sets in _sets(batch.column("text"), k):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(first, end - first), pa.array([len(s) for s in sets], pa.int32()), _lists(sets)],
                    ["id", "n", "shingles"],
                )

    return run


def _signatures(sets: DataFrame, threshold: Fraction, rare: int) -> DataFrame:
    """(bucket, id, n, m): single rare shingles and pairs of frequent neighbours in the prefixes.

    m is the number of shingles that any other set has too.
    """
    lack, both = limits(threshold)
    each = sets.select("id", F.explode("shingles").alias("shingle"))
    counts = each.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    ranked = (
        each.join(counts, "shingle")
        .groupBy("id")
        .agg(F.array_sort(F.collect_list(F.struct("df", "shingle"))).alias("order"))
        .withColumn("m", F.size("order"))
        .join(sets.select("id", "n"), "id")
    )
    once = F.col("n") - F.col("m")
    missing = F.floor(F.col("n") * lack.numerator / lack.denominator) - once
    breaks = F.floor(F.col("n") * both.numerator / both.denominator) - once
    prefix = ranked.where((missing >= 0) & (breaks >= 0)).withColumn(
        "order", F.slice("order", F.lit(1), (missing + breaks + 2).cast("int"))
    )
    place = F.posexplode(F.arrays_zip("order", F.slice("order", 2, F.size("order")).alias("next")))
    pairs = prefix.select("id", "n", "m", place.alias("place", "at")).select(
        "id", "n", "m", F.col("at.order").alias("this"), F.col("at.next").alias("next")
    )
    single = F.col("this.df") <= rare
    bucket = F.when(single, F.col("this.shingle")).otherwise(F.xxhash64("this.shingle", "next.shingle"))
    return pairs.where(single | F.col("next").isNotNull()).select(bucket.alias("bucket"), "id", "n", "m")


def near_documents(
    documents: DataFrame, words_per_shingle: int = 5, threshold: str = "0.8", rare: int = 8
) -> DataFrame:
    """``(doc_id, n_shingles, class_id, component_id)`` of every row of ``documents`` (doc_id, text).

    Words are runs of other than ASCII white space, lower-cased in A-Z; a document's set holds its
    distinct shingles, or with fewer words its whole sequence. ``class_id`` is the smallest
    document with an equal set, ``component_id`` the smallest one reachable over pairs whose Jaccard
    similarity reaches ``threshold`` (a decimal from 0.5 to below 1). A shingle is rare if at most ``rare``
    candidate documents hold it. Texts that are NULL or have no words have an empty set and are
    alone. Rows with a NULL ``doc_id`` come back with NULL ids; a repeated ``doc_id`` gives one row
    per input row, linked by whichever of its texts link. Other columns are ignored.
    """
    t = Fraction(threshold)
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    digest = stored(rows.mapInArrow(_digest(words_per_shingle), DIGEST))
    named = digest.where("n > 0 and doc_id is not null")
    classes = stored(named.groupBy("key_a", "key_b", "n").agg(F.min("doc_id").alias("id")))

    parts = rows.where("doc_id is not null").select("text").mapInArrow(_combinations(words_per_shingle, t), "bucket long, id long, quota long")
    # Copies of a set in several batches name the same parts.
    shared = shared_buckets(parts).select("id", "quota", "bucket").distinct().groupBy("id", "quota").agg(F.count("*").alias("n"))
    sharing = shared.where(F.col("n") >= F.col("quota").bitwiseAND((1 << 32) - 1)).select(F.col("id").alias("key_a")).distinct()
    some = stored(classes.join(sharing, "key_a", "left_semi").select("id").distinct())
    texts = rows.join(some, rows.doc_id == some.id, "left_semi").select(F.col("doc_id").alias("id"), "text")
    sets = stored(texts.mapInArrow(_whole_sets(words_per_shingle), SETS))

    def possible(left, right) -> Column:
        return enough(F.least(left("m"), right("m")), left("n") + right("n"), t)

    def verify(pairs: DataFrame) -> DataFrame:
        a = sets.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("shingles").alias("of_a"))
        b = sets.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("shingles").alias("of_b"))
        overlap = F.size(F.array_intersect("of_a", "of_b"))
        both_sets = pairs.join(b, "b").join(a, "a")
        return both_sets.where(enough(overlap, F.col("n_a") + F.col("n_b"), t)).select("a", "b").distinct()

    # The centre of a bucket is the set with the fewest shingles of its own.
    buckets = stored(shared_buckets(_signatures(sets, t, rare), F.col("n") - F.col("m")))
    found, _ = linked_components(buckets, verify, possible)

    by_class = classes.join(found, "id", "left").select(
        "key_a", "key_b", "n", F.col("id").alias("class_id"), F.coalesce("component", "id").alias("component_id")
    )
    alone = F.col("doc_id")
    return digest.join(by_class, ["key_a", "key_b", "n"], "left").select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(alone.isNotNull(), F.coalesce("class_id", alone)).alias("class_id"),
        F.when(alone.isNotNull(), F.coalesce("component_id", alone)).alias("component_id"),
    )


def one_per_component(documents: DataFrame, **options) -> DataFrame:
    """``documents`` without near-duplicates: of each component its smallest ``doc_id`` stays.

    Repeated rows of that document all stay, and so do rows with a NULL ``doc_id`` or without words.
    """
    near = near_documents(documents.select("doc_id", "text"), **options)
    gone = near.where("component_id <> doc_id").select("doc_id").distinct()
    return documents.join(gone, "doc_id", "left_anti").select(*documents.columns)
