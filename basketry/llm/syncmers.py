"""Document fingerprints from closed syncmers, in SQL functions only.

A text is a sequence of words, a k-mer is ``k`` words in a row, its inner substrings are the runs of ``s`` words in it.
A k-mer is a closed syncmer, and so an anchor, if the smallest hash of its inner substrings is
that of the first or the last one. Whether it is depends on its own words only, so an edit moves no
anchor outside the k-mers it touches, and any ``k`` - ``s`` + 1 k-mers in a row hold an anchor. Words longer
than ``PIECE`` characters count as several, which end where a vowel, an even digit or any character beyond
Latin-1 stands: again by their own characters only, so texts without spaces have anchors that no edit before them moves.

The fingerprint lists the anchors in text order, each as its distance from the one before, in words, and
a 32-bit hash: ``"0-1a2b3c4d 3-..."``. Two fingerprints can be matched by hash, and by place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.storage import stored

K = 8
S = 2
PIECE = 24
_SPACE, _END = r"\x20\x09-\x0D", r"aeiouyAEIOUY02468\x{100}-\x{10FFFF}"
# A whole word, or a piece of one that is too long.
WORD = rf"(?<![^{_SPACE}])[^{_SPACE}]{{1,{PIECE}}}+(?![^{_SPACE}])|[^{_SPACE}{_END}]*[{_END}]|[^{_SPACE}{_END}]+"


def with_anchors(rows: DataFrame, text: str, name: str, k: int = K, s: int = S) -> DataFrame:
    """``rows`` with the anchors of column ``text`` as ``name``: array<struct<place, hash>>.

    ``place`` is the number of words before the anchor. A text of fewer than ``k`` words is one anchor; NULL and
    blank texts have none. Each step is a column of its own, so that Spark computes it once a row.
    """
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), 0)
    rows = rows.withColumn("_words", F.transform(words, lambda w: F.xxhash64(w)))
    runs = F.transform("_words", lambda w, i: F.xxhash64(*[F.get("_words", i + j) for j in range(s)]))
    rows = rows.withColumn("_runs", runs)
    inner = k - s + 1
    # The last s - 1 runs are cut off by the end of the text and stand in no k-mer.
    places = F.sequence(F.lit(0), F.size("_runs") - k)
    least = lambda i: F.array_min(F.slice("_runs", i + 1, inner))
    edge = F.filter(places, lambda i: least(i).isin(F.get("_runs", i), F.get("_runs", i + (inner - 1))))
    found = F.when(F.size("_words") >= k, edge).when(F.size("_words") > 0, F.array(F.lit(0)))
    rows = rows.withColumn("_places", F.coalesce(found, F.array().cast("array<int>")))
    anchor = lambda i: F.struct(i.alias("place"), F.hash(F.slice("_words", i + 1, k)).alias("hash"))
    return rows.withColumn(name, F.transform("_places", anchor)).drop("_words", "_runs", "_places")


def as_string(found: Column) -> Column:
    """The fingerprint of an array of anchors; the empty string if there are none."""
    before = F.slice(found, 1, F.greatest(F.size(found) - 1, F.lit(0)))
    gaps = F.zip_with(
        found, F.concat(F.array(F.lit(None).cast("struct<place:int,hash:int>")), before),
        lambda here, last: F.concat_ws(
            "-",
            (here["place"] - F.coalesce(last["place"], F.lit(0))).cast("string"),
            F.lpad(F.hex(here["hash"].cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"),
        ),
    )
    return F.lower(F.array_join(gaps, " "))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets of anchor hashes; 1 if both are empty."""
    one, two = F.array_distinct(a["hash"]), F.array_distinct(b["hash"])
    both = F.size(F.array_intersect(one, two))
    union = F.size(one) + F.size(two) - both
    return F.when(union == 0, F.lit(1.0)).otherwise(both / union)


def aligned(a: Column, b: Column) -> Column:
    """The share of ``a``'s anchors that stand at the same place in ``b``; 1 if ``a`` has none."""
    # Spark compares whole numbers by hash, structs each with each.
    packed = lambda x: F.shiftleft(x["place"].cast("long"), 32).bitwiseXOR(x["hash"].cast("long"))
    both = F.size(F.array_intersect(F.transform(a, packed), F.transform(b, packed)))
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(both / F.size(a))


def with_next(rows: DataFrame, ranges: int) -> DataFrame:
    """``rows`` (doc_id, text) in ranges of doc_id, with ``edge`` rows that continue each range.

    Every range also gets a copy of the row that follows its smallest doc_id: the one of the largest doc_id of the
    range below, for the lowest range of all ranges. So a row and its next document always stand in one range, and
    texts are shuffled once. There are at most ``ranges`` edge rows, and as many bounds at the driver. Rows with
    NULL doc_id are dealt by their text.
    """
    shares = [i / ranges for i in range(1, ranges)]
    bounds = rows.select(F.percentile_approx("doc_id", F.lit(shares), F.lit(ranges * 10))).first()[0] if shares else []
    bounds = F.array(*[F.lit(x) for x in sorted(set(bounds or []))]).cast("array<bigint>")
    own_range = F.size(F.filter(bounds, lambda x: x < F.col("doc_id")))
    by_text = -1 - F.pmod(F.xxhash64("text"), F.lit(ranges)).cast("int")
    rows = rows.withColumn("range", F.when(F.col("doc_id").isNull(), by_text).otherwise(own_range))
    ends = rows.where("doc_id is not null").groupBy("range").agg(F.max("doc_id").alias("largest"))
    every = Window.orderBy("range")
    above = F.coalesce(F.lead("range").over(every), F.min("range").over(Window.partitionBy()))
    ends = stored(ends.select("largest", above.alias("into")))
    edges = rows.join(F.broadcast(ends), F.col("doc_id") == F.col("largest"))
    edges = edges.groupBy("doc_id", "into").agg(F.min("text").alias("text"))
    edges = edges.select("doc_id", "text", F.col("into").alias("range"), F.lit(True).alias("edge"))
    return rows.withColumn("edge", F.lit(False)).unionByName(edges).repartitionByRange(ranges, "range")


def fingerprints(documents: DataFrame, k: int = K, s: int = S) -> DataFrame:
    """``(doc_id, text, anchors, fingerprint)`` of every row of ``documents`` (doc_id, text); NULL counts as empty."""
    rows = documents.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = with_anchors(rows, "text", "anchors", k, s)
    return found.withColumn("fingerprint", as_string(F.col("anchors")))


def edited_likeness(documents: DataFrame, k: int = K, s: int = S) -> DataFrame:
    """Fingerprints of all texts and of their edited versions, and how alike they are.

    The edited text has its last third replaced by the beginning of the next document's text, by
    descending doc_id, of equal length or all of it. If a doc_id is repeated, the least of its texts stands
    for it as next document; a row with NULL doc_id has no next document and counts as followed by an
    empty text. Output: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    aligned_edited.
    """
    rows = documents.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ranges = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = with_anchors(with_next(rows, ranges), "text", "own", k, s)
    # Ascending, with the least text of a doc_id last: what follows a document stands right before it.
    order = Window.partitionBy("range").orderBy(F.desc("edge"), "doc_id", F.desc("text"))
    before = F.lag(F.struct("doc_id", "text", "own", "edge")).over(order)
    repeat = (F.col("before.doc_id") == F.col("doc_id")) & ~F.col("before.edge")
    pair = own.withColumn("before", before).withColumn("repeat", F.coalesce(repeat, F.lit(False)))
    # Repeats of a doc_id take over what its first row found; a lone document is its own next one.
    first = F.when(~F.col("repeat"), F.struct("before.text", "before.own"))
    pair = pair.withColumn("next", F.last(first, ignorenulls=True).over(order)).where("not edge")
    known = F.col("doc_id").isNotNull()
    pair = pair.select(
        "doc_id", "text", "own", F.when(known, F.col("next.text")).alias("next_text"), F.when(known, F.col("next.own")).alias("next_own")
    )
    cut = F.floor(F.length("text") / 3).cast("int")
    kept = F.substring("text", F.lit(1), F.length("text") - cut)
    pair = pair.withColumn("edited", F.concat(kept, F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), cut)))
    found = with_anchors(pair, "edited", "changed", k, s).select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        "own",
        "changed",
        F.coalesce("next_own", F.array().cast("array<struct<place:int,hash:int>>")).alias("next"),
    )
    return found.select(
        "doc_id", "n_chars", "edited_sha256",
        as_string(F.col("own")).alias("fingerprint"),
        as_string(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("next")).alias("near_next"),
        aligned(F.col("own"), F.col("changed")).alias("aligned_edited"),
    )
