"""Quality of a text from its bytes: a small convolutional network in numpy.

``FILTERS`` learned filters look at windows of ``WIDTH`` bytes. Their largest answers are taken over
chunks of two segments of ``SEGMENT`` bytes; neighbouring chunks overlap by one segment and together
cover the whole text. A layer over those maxima scores each chunk, and the mean and the worst
chunk score of a text together give one probability. Everything is learned together, with Adam, on a
bounded sample of labelled texts.

A filter over bytes is a table (place in the window, byte value), so applying it is adding up rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm import utf8

WIDTH = 6
FILTERS = 16
SEGMENT = 128
SAMPLE_ROWS = 1000  # of each label, about
SAMPLE_BYTES = 1 << 24  # of whole texts of each label, together
_TILE = 1 << 14


@dataclass
class QualityModel:
    filters: np.ndarray  # WIDTH x 256 x FILTERS
    bias: np.ndarray  # FILTERS
    layer: np.ndarray  # FILTERS
    chunk_bias: float
    mean_weight: float
    worst_weight: float
    offset: float
    prior: float  # log odds of label 1 in all labelled rows, less those in the sample


def _padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts with zero bytes behind each, so that a window starts at every byte; an empty text is one zero byte."""
    length = np.diff(offsets)
    room = np.maximum(length, 1) + WIDTH - 1
    starts = np.cumsum(room) - room
    out = np.zeros(int(room.sum()), np.uint8)
    out[np.arange(len(data)) + np.repeat(starts - offsets[:-1], length)] = data
    return out, starts, np.maximum(length, 1)


def _segments(starts: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and end position of every segment, and its text."""
    count = -(-length // SEGMENT)
    text = np.repeat(np.arange(len(length)), count)
    place = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    first = starts[text] + place * SEGMENT
    return first, np.minimum(first + SEGMENT, starts[text] + length[text]), text


def _answers(filters: np.ndarray, data: np.ndarray, first: int, end: int) -> np.ndarray:
    out = filters[0][data[first:end]]
    for k in range(1, WIDTH):
        out += filters[k][data[first + k : end + k]]
    return out


def _segment_maxima(filters: np.ndarray, data: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    out = np.empty((len(first), filters.shape[2]), np.float32)
    step = max(1, _TILE // SEGMENT)
    for i in range(0, len(first), step):
        a, b = first[i : i + step], end[i : i + step]
        base, stop = int(a[0]), int(b[-1])
        answers = _answers(filters, data, base, stop)
        # The gaps behind texts are not part of any segment.
        edges = np.stack([a, b], axis=1).ravel() - base
        edges = edges[:-1]
        out[i : i + step] = np.maximum.reduceat(answers, edges, axis=0)[::2]
    return out


def _chunks(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two segments of every chunk; a text of one segment has one chunk of it alone."""
    i = np.arange(len(text))
    same = np.append(text[1:] == text[:-1], False)
    lone = np.append(True, text[1:] != text[:-1]) & ~same
    chosen = i[same | lone]
    return chosen, np.where(same[chosen], np.minimum(chosen + 1, len(text) - 1), chosen)


def _combine(model: QualityModel, maxima: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    left, right = _chunks(text)
    hidden = np.maximum(np.maximum(maxima[left], maxima[right]) + model.bias, 0)
    score = hidden @ model.layer + model.chunk_bias
    of = text[left]
    begin = np.searchsorted(of, np.arange(n))
    mean = np.add.reduceat(score, begin) / np.bincount(of, minlength=n)
    worst = np.minimum.reduceat(score, begin)
    return model.mean_weight * mean + model.worst_weight * worst + model.offset + model.prior


def fit(rows: list[tuple[str, int]], epochs: int = 6, rate: float = 0.01, prior: float = 0.0) -> QualityModel:
    """Learn from (text, label) rows."""
    draw = np.random.default_rng(5)
    model = QualityModel(
        draw.normal(0, 0.1, (WIDTH, 256, FILTERS)).astype(np.float32), np.full(FILTERS, 0.1, np.float32),
        draw.normal(0, 0.3, FILTERS).astype(np.float32), 0.0, 0.5, 0.5, 0.0, prior,
    )
    texts = []
    for text, label in rows:
        raw = np.frombuffer((text or "").encode(), np.uint8)
        data, starts, length = _padded(raw, np.array([0, len(raw)]))
        n = int(length[0])
        texts.append((np.pad(data, (0, -n % SEGMENT)), n, label))
    names = ["filters", "bias", "layer", "chunk_bias", "mean_weight", "worst_weight", "offset"]
    moment = {k: np.zeros_like(np.asarray(getattr(model, k), np.float32)) for k in names}
    square = {k: v.copy() for k, v in moment.items()}
    steps = 0
    for epoch in range(epochs):
        order = draw.permutation(len(texts))
        for batch in (order[i : i + 16] for i in range(0, len(order), 16)):
            grad = {k: np.zeros_like(v) for k, v in moment.items()}
            for i in batch:
                _backward(model, *texts[i], grad)
            steps += 1
            step = rate * (1 - 0.9 * epoch / epochs)
            for k in names:
                g = grad[k] / len(batch)
                moment[k] += 0.1 * (g - moment[k])
                square[k] += 0.01 * (g * g - square[k])
                fresh = moment[k] / (1 - 0.9**steps) / (np.sqrt(square[k] / (1 - 0.99**steps)) + 1e-6)
                value = getattr(model, k) - step * fresh
                setattr(model, k, value if value.ndim else float(value))
    return model


def _backward(model: QualityModel, data: np.ndarray, n: int, label: int, grad: dict[str, np.ndarray]) -> None:
    """Add the gradient of one text's log loss."""
    answers = _answers(model.filters, data, 0, n)
    count = -(-n // SEGMENT)
    if count * SEGMENT > n:
        answers = np.concatenate([answers, np.full((count * SEGMENT - n, FILTERS), -np.inf, np.float32)])
    answers = answers.reshape(count, SEGMENT, FILTERS)
    at = answers.argmax(axis=1) + np.arange(count)[:, None] * SEGMENT
    maxima = answers.max(axis=1)
    left, right = _chunks(np.zeros(count, np.int64))
    from_left = maxima[left] >= maxima[right]
    peak = np.where(from_left, maxima[left], maxima[right])
    where = np.where(from_left, at[left], at[right])
    hidden = np.maximum(peak + model.bias, 0)
    score = hidden @ model.layer + model.chunk_bias
    worst = int(score.argmin())
    logit = model.mean_weight * score.mean() + model.worst_weight * score[worst] + model.offset
    wrong = 1 / (1 + math.exp(-max(-30.0, min(30.0, float(logit))))) - label
    grad["mean_weight"] += wrong * score.mean()
    grad["worst_weight"] += wrong * score[worst]
    grad["offset"] += wrong
    back = np.full(len(score), wrong * model.mean_weight / len(score), np.float32)
    back[worst] += wrong * model.worst_weight
    grad["chunk_bias"] += back.sum()
    grad["layer"] += hidden.T @ back
    below = (back[:, None] * model.layer) * (hidden > 0)
    grad["bias"] += below.sum(axis=0)
    filter_ = np.broadcast_to(np.arange(FILTERS), where.shape)
    for k in range(WIDTH):
        np.add.at(grad["filters"][k], (data[where + k], filter_), below)


def train(documents: DataFrame, labels: DataFrame) -> QualityModel:
    """A model from ``documents`` (doc_id, text) and ``labels`` (doc_id, quality 0 or 1).

    Of each label about ``SAMPLE_ROWS`` rows are read: those whose hash lies below a bound that follows from the
    number of rows. Of their texts, whole ones are taken in the order of the hash as long as they fit into ``SAMPLE_BYTES``, passing over
    those that do not. Rows without a label are left out, a NULL text counts as empty, a document with several texts counts with the
    smallest; without labels every text scores one half.
    """
    counts = {r.quality: r["count"] for r in labels.where("quality in (0, 1)").groupBy("quality").count().collect()}
    rows: list[tuple[str, int]] = []
    for label in sorted(counts):
        drawn = labels.where(F.col("quality") == label).select("doc_id", F.xxhash64("doc_id").alias("draw"))
        share = int(min(1.0, SAMPLE_ROWS / counts[label]) * (1 << 40))
        ids = drawn.where(F.pmod("draw", F.lit(1 << 40)) < share).distinct()
        # About SAMPLE_ROWS ids are broadcast, and as many sizes and digests come back before any text.
        found = documents.join(F.broadcast(ids), "doc_id").withColumn("text", F.coalesce("text", F.lit("")))
        sizes = found.groupBy("doc_id", "draw").agg(F.min(F.struct(F.octet_length("text").alias("size"), F.sha2("text", 256).alias("digest"))).alias("of"))
        room, chosen = SAMPLE_BYTES, []
        for r in sizes.orderBy("draw", "doc_id").collect():
            if r.of.size <= room:
                room -= r.of.size
                chosen.append(r.of.digest)
        texts = found.where(F.sha2("text", 256).isin(chosen)).select("text").distinct() if chosen else found.select("text").limit(0)
        by_digest = {hashlib.sha256(r.text.encode()).hexdigest(): r.text for r in texts.collect()}
        rows += [(by_digest[digest], int(label)) for digest in chosen]
    ones = sum(label for _, label in rows)
    zeros = len(rows) - ones
    prior = 0.0
    if ones and zeros:
        prior = math.log(counts[1] / counts[0]) - math.log(ones / zeros)
    return fit(rows, prior=prior)


def _scored(model: QualityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in utf8.texts(batch.column("text")):
                padded, starts, length = _padded(data, offsets)
                a, b, text = _segments(starts, length)
                logit = _combine(model, _segment_maxima(model.filters, padded, a, b), text, end - first)
                score = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(first, end - first), pa.array(score.astype(np.float64))], ["row", "score"]
                )

    return run


def score(documents: DataFrame, model: QualityModel, carry: list[str] | None = None) -> DataFrame:
    """``(*carry, score)`` of every row of ``documents`` (text, ...): the chance of label 1.

    Only the text counts. NULL and empty texts score alike, as an empty chunk does. ``carry`` names the
    columns to pass through (``doc_id`` by default).
    """
    carry = carry or ["doc_id"]
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col("text").cast("string"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, score double"
    return rows.mapInArrow(_scored(model), schema).select(*[F.col(f"row.`{c}`").alias(c) for c in carry], "score")
