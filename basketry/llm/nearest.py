"""Approximate nearest neighbours by multi-index hashing.

A rotation learned on a bounded sample (iterative quantization) turns a vector into 64 bits, so that
near vectors differ in few. The code is cut into ``PARTS`` substrings, and each is an index of its own. Codes
within a Hamming radius r of the query's differ by r // PARTS at most in one substring (pigeonhole), so
probing all values within that of the query's substring finds every such code. What is found
is ranked by the distance of the original vectors.

The radius is learned too: it is where the true neighbours of sampled queries lie within the sample,
which are farther than those within everything. A query that finds too few within it is asked
again over all codes. The sample also bounds each query's answer: what is farther than its k nearest in the
sample cannot be among the k nearest of all, and is not passed on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.storage import stored

BITS = 64
PARTS = 8
WIDTH = BITS // PARTS
SAMPLE_ROWS = 8000  # about so many rows, that rotation, radius and bounds are learned on
SAMPLE_QUERIES = 200
BLOCK_ROWS = 4000  # rows of one index value that are kept at a time


@dataclass
class Codes:
    mean: np.ndarray
    projection: np.ndarray  # dimensions x BITS
    radius: int

    def of(self, vectors: np.ndarray) -> np.ndarray:
        bits = (vectors - self.mean) @ self.projection > 0
        return np.packbits(bits, axis=1).view(">u8").ravel().astype(np.uint64)


def learn(sample: np.ndarray, k: int, rounds: int = 30, coverage: float = 0.99) -> Codes:
    """Rotation and radius from the rows of ``sample``.

    With fewer than ``BITS`` dimensions several rotations are learned, each from another start.
    """
    draw = np.random.default_rng(3)
    mean = sample.mean(axis=0)
    centred = sample - mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, ::-1][:, :BITS]
    flat = centred @ axes
    parts = []
    for _ in range(-(-BITS // axes.shape[1])):
        turn = np.linalg.qr(draw.normal(size=(axes.shape[1],) * 2))[0]
        for _ in range(rounds):
            left, _, right = np.linalg.svd(np.where(flat @ turn > 0, 1.0, -1.0).T @ flat)
            turn = (left @ right).T
        parts.append(axes @ turn)
    codes = Codes(mean, np.concatenate(parts, axis=1)[:, :BITS], BITS)
    asked = np.arange(0, len(sample), max(1, len(sample) // SAMPLE_QUERIES))[:SAMPLE_QUERIES]
    own = codes.of(sample)
    far = []
    for i in asked:
        distance = ((sample - sample[i]) ** 2).sum(axis=1)
        near = np.argsort(distance, kind="stable")[1 : k + 1]
        far.append(np.bitwise_count(own[near] ^ own[i]))
    if far and sum(map(len, far)):
        codes.radius = int(np.quantile(np.concatenate(far), coverage))
    return codes


def _coded(codes: Codes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = np.array(batch.column("vector").values, float).reshape(len(batch), -1) if len(batch) else None
            code = codes.of(vectors).view(np.int64) if len(batch) else np.empty(0, np.int64)
            yield batch.append_column("code", pa.array(code))

    return run


def _probes(within: int) -> list[int]:
    """All masks of ``WIDTH`` bits with at most ``within`` set."""
    return [mask for mask in range(1 << WIDTH) if mask.bit_count() <= within]


def _bounded(codes: Codes, ids: np.ndarray, sample: np.ndarray, k: int):
    """Adds each query's code, and the distance of its k-th nearest row in the sample (infinite, if there are fewer)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _coded(codes)(batches):
            bounds = np.full(len(batch), np.inf)
            vectors = np.array(batch.column("vector").values, float).reshape(len(batch), -1) if len(batch) else ()
            for i, (vec_id, vector) in enumerate(zip(batch.column("vec_id").to_pylist(), vectors)):
                distance = np.sqrt(((sample[ids != vec_id] - vector) ** 2).sum(axis=1))
                if len(distance) >= k:
                    bounds[i] = np.partition(distance, k - 1)[k - 1]
            yield batch.append_column("bound", pa.array(bounds))

    return run


def _ranked(k: int, radius: int):
    """Rows sorted by index value (and salt), codes before the queries that probe it: a block of codes is kept, queries stream by."""
    # A bound that was added up in another order may differ in its last bits.
    slack = 1 + 1e-12

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, code, ids, vectors = None, [], [], []
        for batch in batches:
            if not len(batch):
                continue
            keys = np.stack([np.array(batch.column(c)) for c in ("part", "value", "salt", "kind")], axis=1).astype(np.int64)
            cuts = [0, *(np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1), len(batch)]
            of_code = np.array(batch.column("code")).view(np.uint64)
            of_id, bounds = np.array(batch.column("id")), np.array(batch.column("bound"))
            of_vector = np.array(batch.column("vector").values, float).reshape(len(batch), -1)
            found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for a, b in zip(cuts[:-1], cuts[1:]):
                if group != tuple(keys[a, :3]):
                    group, code, ids, vectors = tuple(keys[a, :3]), [], [], []
                if keys[a, 3] == 0:
                    code.append(of_code[a:b])
                    ids.append(of_id[a:b])
                    vectors.append(of_vector[a:b])
                    continue
                if not code:
                    continue
                code, ids, vectors = [np.concatenate(code)], [np.concatenate(ids)], [np.concatenate(vectors)]
                for i in range(a, b):
                    apart = code[0] ^ of_code[i]
                    hit = np.bitwise_count(apart) <= radius
                    # A code within the radius is found in several substrings; the first of them reports it.
                    for part in range(group[0]):
                        shift = np.uint64(BITS - WIDTH * (part + 1))
                        piece = (apart >> shift) & np.uint64((1 << WIDTH) - 1)
                        hit &= np.bitwise_count(piece) > radius // PARTS
                    at = np.flatnonzero(hit & (ids[0] != of_id[i]))
                    distance = np.sqrt(((vectors[0][at] - of_vector[i]) ** 2).sum(axis=1))
                    near = distance <= bounds[i] * slack
                    at, distance = at[near], distance[near]
                    order = np.lexsort((ids[0][at], distance))[: k + 1]
                    if len(order):
                        found.append((np.full(len(order), of_id[i]), ids[0][at][order], distance[order]))
            if found:
                columns = [pa.array(np.concatenate(x)) for x in zip(*found)]
                yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])

    return run


def search(embeddings: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest rows found for every row where ``is_query``.

    ``embeddings`` has vec_id and embedding. Every row is indexed and a candidate of every query but its own. Nearness
    is the Euclidean distance in double precision, ties go to the smaller vec_id; with fewer than k
    other rows all are returned. Vectors that are NULL, empty, zero, of another length than the most
    common one (ties: the longest), or hold NULL or a non-finite number take no part, nor do rows with
    NULL vec_id. Rows with one vec_id count once each; a query is not its own neighbour under any of them.
    Equal vectors are indexed once, with their k + 1 smallest ids: no more can be among the k nearest.
    """
    vector = F.col("embedding").cast("array<double>")
    rows = embeddings.select(F.col("vec_id").cast("long"), vector.alias("vector"), is_query.alias("asks")).where(
        F.col("vec_id").isNotNull() & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    empty = "query_id long, rank int, vec_id long, score double"
    if not sizes:
        return embeddings.sparkSession.createDataFrame([], empty)
    rows = rows.where(F.size("vector") == sizes[0]["size"])
    share = min(1.0, SAMPLE_ROWS / max(sizes[0]["count"], 1))
    drawn = rows.withColumn("draw", F.xxhash64("vec_id")).where(F.pmod("draw", F.lit(1 << 40)) < int(share * (1 << 40)))
    drawn = drawn.dropDuplicates(["vec_id", "vector"]).select("draw", "vec_id", "vector").toArrow().sort_by([("draw", "ascending"), ("vec_id", "ascending")])
    sample = np.array(drawn["vector"].to_pylist(), float).reshape(len(drawn), sizes[0]["size"])
    codes = learn(sample, k) if len(sample) else learn(np.ones((1, sizes[0]["size"])), k)
    known = np.array(drawn["vec_id"].to_pylist(), np.int64)

    # Equal vectors: the limit on the rank is applied in every map task before the shuffle.
    place = Window.partitionBy("vector").orderBy("vec_id")
    kept = rows.withColumn("place", F.row_number().over(place)).where(F.col("place") <= k + 1).drop("place", "asks")
    kept = stored(kept.mapInArrow(_coded(codes), "vec_id long, vector array<double>, code long"))
    asked = rows.where("asks").select("vec_id", "vector").mapInArrow(
        _bounded(codes, known, sample, k), "vec_id long, vector array<double>, code long, bound double"
    )
    asked = stored(asked.withColumnRenamed("vec_id", "query_id"))
    total = kept.count()

    found = stored(_probe(kept, asked, k, codes.radius, total))
    enough = found.groupBy("query_id").count().where(F.col("count") >= min(k, total - 1)).select("query_id")
    short = stored(asked.join(enough, "query_id", "left_anti"))
    if not short.isEmpty():
        found = found.join(enough, "query_id", "left_semi").unionByName(_probe(kept, short, k, BITS, total))
    return found.select("query_id", "rank", "vec_id", "score")


def _probe(kept: DataFrame, asked: DataFrame, k: int, radius: int, total: int) -> DataFrame:
    """The k nearest of all codes within the radius. At the full radius one substring finds every code."""
    parts = PARTS if radius < BITS else 1
    masks = _probes(min(radius // PARTS, WIDTH))
    part = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    cut = lambda code: F.expr(f"int(shiftrightunsigned({code}, {BITS - WIDTH} - {WIDTH} * part) & {(1 << WIDTH) - 1})")
    index = kept.select("vec_id", "vector", "code", part).withColumn("value", cut("code"))
    # At most PARTS << WIDTH counts. A value that many codes share is dealt out in blocks.
    counts = index.groupBy("part", "value").count().collect()
    if not counts:
        return kept.sparkSession.createDataFrame([], "query_id long, vec_id long, score double, rank int")
    blocks = F.create_map(*[x for r in counts for x in (F.lit(r.part << WIDTH | r.value), F.lit(-(-r["count"] // BLOCK_ROWS)))])
    of_value = F.try_element_at(blocks, (F.col("part") * (1 << WIDTH) + F.col("value")).cast("int"))
    index = index.select(
        "part", "value", F.pmod(F.xxhash64("vec_id", "code"), of_value).cast("int").alias("salt"), F.lit(0).alias("kind"),
        F.col("vec_id").alias("id"), "code", "vector", F.lit(0.0).alias("bound"),
    )
    probes = asked.select("query_id", "vector", "code", "bound", part).withColumn("own", cut("code"))
    probes = probes.select("*", F.explode(F.array(*[F.lit(m) for m in masks])).alias("mask"))
    probes = probes.withColumn("value", F.col("own").bitwiseXOR(F.col("mask"))).withColumn("blocks", of_value).where("blocks > 0")
    probes = probes.select(
        "part", "value", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("salt"), F.lit(1).alias("kind"),
        F.col("query_id").alias("id"), "code", "vector", "bound",
    )
    tasks = int(kept.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = index.unionByName(probes).repartition(tasks, "part", "value", "salt").sortWithinPartitions("part", "value", "salt", "kind")
    partial = dealt.mapInArrow(_ranked(k, radius), "query_id long, vec_id long, score double")
    nearest = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return partial.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
