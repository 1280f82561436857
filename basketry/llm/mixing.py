"""Mix sources to target weights by systematic sampling.

Every document of a source is expected ``target / source size`` times in the mix. Documents are
put in one order per source, expected copies are summed along it from one random offset, and a
document is taken once for every whole number its stretch of the sum crosses. Documents of like
size stand together in that order, so the words taken come close to the target.

The running sum over a source is exact and needs no task that sees the whole source: documents fall
into blocks, (size level, one of ``BLOCKS`` hash values), whose totals are summed first. Copies are
counted in units of 2^-24, as whole numbers, so any rerun gives the same mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNIT = 1 << 24
BLOCKS = 256
WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def weighted_targets(sizes: DataFrame, total: Column, most: int) -> DataFrame:
    """``target`` for every row of ``sizes`` (source, source_size, weight); one row per source.

    ``total`` is shared by weight. No target exceeds ``most`` times its source's size; what is cut
    off is shared again by weight until none is above. With sources in ascending order of size per
    weight those at their limit come first, so the end of that loop is found from running sums: a
    source is at its limit if its equal share of what the ones before it leave is no less. The
    windows run over one row per source in one task.
    """
    limit = F.lit(most) * F.col("source_size")
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.asc_nulls_last("source"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = total - F.coalesce(F.sum(limit).over(before), F.lit(0))
    shared = sizes.withColumn("level", left / F.sum("weight").over(onward))
    shared = shared.withColumn("full", F.col("level") * F.col("weight") >= limit)
    # From the first source below its limit on, all get the level found there.
    level = F.min(F.when(~F.col("full"), F.struct(F.col("source_size") / F.col("weight"), F.col("level").alias("level"))))
    shared = shared.withColumn("common", level.over(Window.partitionBy())["level"])
    share = F.col("common") * F.col("weight")
    return shared.withColumn("target", F.coalesce(F.least(share, limit), limit).cast("double")).drop("level", "full", "common")


def expected_units(target: Column, size: Column, most: int) -> Column:
    """Copies of a document in units of 2^-24; never more than ``most``."""
    exact = F.round(F.lit(UNIT) * target / size).cast("long")
    return F.when(size > 0, F.least(exact, F.lit(most * UNIT))).otherwise(F.lit(0))


def systematic_copies(rows: DataFrame, seed: str = "mix") -> DataFrame:
    """``copies`` for every row of ``rows`` (source, doc_id, size, units): how often it is taken.

    The random offset of a source comes from the MD5 of the seed and the source.
    """
    # Sizes of one level differ by an eighth at most.
    shift = F.greatest(F.length(F.bin("size")) - 4, F.lit(0))
    rows = rows.withColumn("shift", shift)
    rows = rows.withColumn("level", F.col("shift") * 16 + F.expr("shiftright(size, shift)"))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    spread = F.conv(F.substring(F.md5(name.cast("binary")), 1, 8), 16, 10).cast("long") % BLOCKS
    rows = rows.withColumn("block", spread).drop("shift")
    keys = ["source", "level", "block"]
    sums = rows.groupBy(*keys).agg(F.sum("units").alias("of_block"))
    earlier = Window.partitionBy("source").orderBy("level", "block").rowsBetween(Window.unboundedPreceding, -1)
    start = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce("source", F.lit(""))).cast("binary")), 1, 6), 16, 10)
    sums = sums.withColumn("begin", F.coalesce(F.sum("of_block").over(earlier), F.lit(0)) + start.cast("long")).drop("of_block")
    sums = sums.select(*[F.col(k).alias(f"_{k}") for k in keys], "begin")
    match = F.col("source").eqNullSafe(F.col("_source"))
    match &= (F.col("level") == F.col("_level")) & (F.col("block") == F.col("_block"))
    inside = Window.partitionBy(*keys).orderBy("size", "doc_id", "tie").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("inside", F.sum("units").over(inside)).join(sums, match)
    end = F.col("begin") + F.col("inside")
    crossed = F.floor(end / UNIT) - F.floor((end - F.col("units")) / UNIT)
    return rows.withColumn("copies", crossed.cast("long")).drop(*[f"_{k}" for k in keys], "level", "block", "begin", "inside")


def mix(
    documents: DataFrame, weights: Column | None = None, share: float = 1.5, most: int = 2, seed: str = "mix"
) -> DataFrame:
    """``(doc_id, source, size, source_size, weight, target, copies, taken)`` of every row of ``documents``.

    ``size`` is the number of words of ``text``, 0 for NULL, empty and blank texts, which are never
    taken. ``weights`` is an expression over ``place``, the source's place by code point from 0, NULL
    last; by default 3, 1, 2, repeating. The mix as a whole has ``share`` times the words of the table,
    or ``most`` times, if that is less. NULL is a source like any other. Repeated rows are documents of
    their own; rows equal in all of doc_id, source and text are interchangeable.
    """
    weights = F.element_at(F.array(F.lit(3), F.lit(1), F.lit(2)), (F.col("place") % 3 + 1).cast("int")) if weights is None else weights
    rows = documents.select(
        F.col("doc_id").cast("long"), F.col("source").cast("string"), word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("tie")
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    sizes = sizes.withColumn("place", place).withColumn("weight", weights).drop("place")
    targets = weighted_targets(sizes, F.lit(share) * F.sum("source_size").over(Window.partitionBy()), most)
    targets = targets.withColumnRenamed("source", "of")
    joined = rows.join(targets, rows.source.eqNullSafe(targets.of)).drop("of")
    joined = joined.withColumn("units", expected_units(F.col("target"), F.col("source_size"), most))
    taken = systematic_copies(joined, seed)
    return taken.select(
        "doc_id", "source", "size", "source_size", "weight", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), "tie"
    )


def mixed_documents(documents: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, all its columns as they were.

    Rows equal in doc_id, source and text get their copies in equal parts by count.
    """
    counts = mix(documents.select("doc_id", "source", "text"), **options)
    # Equal rows are interchangeable: the k-th of them takes the k-th count.
    same = ["doc_id", "source", "tie"]
    kth = Window.partitionBy(*same).orderBy("copies")
    counts = counts.withColumn("kth", F.row_number().over(kth)).where("copies > 0").select(
        *[F.col(c).alias(f"_{c}") for c in same], F.col("kth").alias("_kth"), F.col("copies").alias("_copies")
    )
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns])
    rows = documents.select(
        row.alias("row"), F.col("doc_id").cast("long"), F.col("source").cast("string"), F.xxhash64("text").alias("tie")
    )
    rows = rows.withColumn("kth", F.row_number().over(Window.partitionBy(*same).orderBy(F.lit(1))))
    match = F.col("kth") == F.col("_kth")
    for c in same:
        match &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    repeated = rows.join(counts, match).select("row", F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("copy"))
    return repeated.select(*[F.col(f"row.`{c}`").alias(c) for c in documents.columns])
