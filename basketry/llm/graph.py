"""Links between similar items, without all pairs of a group; connected components of links.

Items that share a bucket are candidates. A bucket of n items has n - 1 pairs with its centre
(its star); those are verified first, and the item is chosen so that many of them hold. Two items that are then connected need no further look,
whatever their own similarity is, so what remains are pairs of one bucket whose components differ.
Verifying these too makes the components exactly those of all links between items that share a
bucket, while a large group of copies costs little more than its star.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.storage import Steps, stored


FINISH_LINKS = 100_000


def components(links: DataFrame, finish: int = FINISH_LINKS) -> DataFrame:
    """``(id, component)`` of every item in ``links`` (a, b): the smallest item it is connected with.

    Distributed union by random contraction. In a round each item joins the one of itself and its
    neighbours that a hash of this round puts first, and the links are redrawn between those. An
    item goes on only if it was somebody's choice, so a constant share of any graph goes in a round,
    and the number of rounds follows the logarithm of its size, in long chains too. Once at most
    ``finish`` links are left, a single task unites them. The rounds are then composed from the last,
    smallest one back to the first. Links with a NULL end and links of an item with itself count for nothing.
    """
    steps, result = Steps(links.sparkSession), Steps(links.sparkSession)
    edges = steps.keep(links.select("a", "b").where("a <> b").distinct())
    chosen = []
    while edges.count() > finish:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = [F.xxhash64(F.lit(len(chosen)), c) for c in ("a", "b")]
        choice = both.groupBy("a").agg(F.min_by("b", first[1]).alias("b"))
        top = F.when(first[1] < first[0], F.col("b")).otherwise(F.col("a"))
        chosen.append(steps.keep(choice.select(F.col("a").alias("id"), top.alias("top"))))
        at_a = chosen[-1].select(F.col("id").alias("a"), F.col("top").alias("to_a"))
        at_b = chosen[-1].select(F.col("id").alias("b"), F.col("top").alias("to_b"))
        redrawn = edges.join(at_a, "a").join(at_b, "b").where("to_a <> to_b")
        low, high = F.least("to_a", "to_b"), F.greatest("to_a", "to_b")
        edges = steps.keep(redrawn.select(low.alias("a"), high.alias("b")).distinct())
    kind = edges.schema["a"].dataType.simpleString()
    united = steps.keep(edges.coalesce(1).mapInArrow(_unite, f"id {kind}, top {kind}"))
    for choice in reversed(chosen):
        above = united.select(F.col("id").alias("top"), F.col("top").alias("end"))
        ends = choice.join(above, "top", "left").select("id", F.coalesce("end", "top").alias("top"))
        united = steps.keep(ends)
    smallest = united.groupBy("top").agg(F.min("id").alias("component"))
    labels = result.keep(united.join(smallest, "top").select("id", "component"))
    steps.clear()
    return labels


def _unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the links of one task: each item with one item of its component."""
    up: dict = {}

    def top(item):
        while up.setdefault(item, item) != item:
            up[item] = item = up[up[item]]
        return item

    kind = None
    for batch in batches:
        kind = batch.column(0).type
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            up[top(a)] = top(b)
    if up:
        items = list(up)
        yield pa.RecordBatch.from_arrays([pa.array(items, kind), pa.array([top(i) for i in items], kind)], ["id", "top"])


def shared_buckets(rows: DataFrame, cost: Column | None = None) -> DataFrame:
    """The rows of (bucket, id, ...) whose bucket holds two items at least, with its centre, ``first``.

    The centre is the item of least ``cost``, or the smallest. One shuffle, on the bucket.
    """
    bucket = Window.partitionBy("bucket")
    centre = F.min("id") if cost is None else F.min(F.struct(cost.alias("cost"), F.col("id")))
    marked = rows.withColumns({"low": F.min("id").over(bucket), "high": F.max("id").over(bucket), "first": centre.over(bucket)})
    marked = marked.where("low <> high").drop("low", "high")
    return marked if cost is None else marked.withColumn("first", F.col("first.id"))


def most_shared_centres(buckets: DataFrame) -> DataFrame:
    """``buckets`` (bucket, id, first) with that item as centre that meets the most others over all its buckets.

    An original meets more of its edited copies than they meet each other.
    """
    size = buckets.withColumn("met", F.count("*").over(Window.partitionBy("bucket")))
    weight = size.groupBy("id").agg((-F.sum("met")).alias("cost"))
    return shared_buckets(buckets.drop("first").join(weight, "id"), F.col("cost")).drop("cost")


STAR_ROUNDS = 4
PAIRS_PER_ROW = 2


def _several_components(rows: DataFrame) -> DataFrame:
    """The rows of (bucket, component, ...) whose bucket holds two components at least."""
    bucket = Window.partitionBy("bucket")
    marked = rows.withColumns({"low": F.min("component").over(bucket), "high": F.max("component").over(bucket)})
    return marked.where("low <> high").drop("low", "high")


def linked_components(
    buckets: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    possible: Callable[[Callable, Callable], Column],
) -> tuple[DataFrame, DataFrame]:
    """Components and verified links of items that share a bucket.

    ``buckets`` comes from :func:`shared_buckets`; its other columns describe the item. ``verify`` keeps the similar of the
    pairs (a, b). ``possible`` tells from these columns of two items whether they can be similar at all.

    As long as the buckets hold many more pairs of different components than rows, and new links turn up, another star with
    another centre joins more of them first. All pairs that are left are met.
    """
    star = buckets.where("id <> first").drop("bucket").distinct().alias("l")
    centre = buckets.where("id = first").drop("bucket", "first").distinct().alias("r")
    both = (F.col("l.first") == F.col("r.id")) & possible(lambda c: F.col(f"l.{c}"), lambda c: F.col(f"r.{c}"))
    links = stored(verify(star.join(centre, both).select(F.col("l.first").alias("a"), F.col("l.id").alias("b"))))
    found = components(links)
    labelled = buckets.drop("first").join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    open_ = stored(_several_components(labelled))

    def apart(left: DataFrame, right: DataFrame, *also: Column) -> DataFrame:
        """Pairs of one bucket, of different components, that can be similar."""
        met = (F.col("l.bucket") == F.col("r.bucket")) & (F.col("l.component") != F.col("r.component"))
        for condition in also:
            met &= condition
        met &= possible(lambda c: F.col(f"l.{c}"), lambda c: F.col(f"r.{c}"))
        a, b = F.least("l.id", "r.id").alias("a"), F.greatest("l.id", "r.id").alias("b")
        return left.alias("l").join(right.alias("r"), met).select(a, b).distinct()

    later = []
    for turn in range(1, STAR_ROUNDS):
        sizes = open_.groupBy("bucket").agg(F.count("*").alias("n"))
        rows, pairs = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.col("n") * (F.col("n") - 1) / 2), F.lit(0.0))).first()
        if pairs <= PAIRS_PER_ROW * rows:
            break
        centre = F.min_by("id", F.xxhash64(F.lit(turn), "id")).alias("id")
        centres = open_.join(open_.groupBy("bucket").agg(centre), ["bucket", "id"], "left_semi")
        more = stored(verify(apart(centres, open_)))
        if more.isEmpty():
            break
        later.append(more)
        of = open_.select("id", "component").distinct()
        ends = more.join(of.toDF("a", "at_a"), "a").join(of.toDF("b", "at_b"), "b")
        merged = components(ends.select(F.col("at_a").alias("a"), F.col("at_b").alias("b")))
        relabelled = open_.join(merged.toDF("component", "into"), "component", "left")
        open_ = stored(_several_components(relabelled.withColumn("component", F.coalesce("into", "component")).drop("into")))
    # A pair is met in the smallest bucket that both share, not in all of them.
    each = open_.groupBy("id").agg(F.collect_set("bucket").alias("buckets"))
    open_ = stored(open_.join(each, "id"))
    once = F.col("l.bucket") == F.array_min(F.array_intersect("l.buckets", "r.buckets"))
    later.append(stored(verify(apart(open_, open_, F.col("l.id") < F.col("r.id"), once))))
    if all(more.isEmpty() for more in later):
        return found, links
    for more in later:
        links = links.unionByName(more)
    return components(links), links
