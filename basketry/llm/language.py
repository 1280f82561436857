"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is lower-cased in A-Z; its subwords are the runs of ``GRAMS`` bytes that hold no ASCII digit, sign
or white space other than the word's edges (white space reads as one edge mark). Each subword is
hashed to a row of an embedding table, the rows are averaged over the whole text, and a linear
layer with softmax gives the language. Table and layer are learned together by stochastic gradient
descent in numpy, on a bounded sample of labelled texts: the executors count the subwords of each whole text, and
only the counts reach the driver, packed. Since both are linear their product is one
table of class scores, which is all that scoring needs.

Scores are calibrated on the part of the sample that did not train: a temperature makes them
honest, and the rejection threshold is the score that all but ``reject_share`` of the rightly
named calibration texts exceed.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm import utf8

GRAMS = (2, 3, 4)
BUCKETS = 1 << 15
SAMPLE_ROWS = 4000  # about so many texts, the languages alike
UNDETERMINED = "und"
EDGE = 0x20

# Letters keep their (lower-case) byte, and so does every byte of a longer UTF-8 sequence; the rest is an edge.
_LETTER = np.zeros(256, bool)
_LETTER[ord("a") : ord("z") + 1] = True
_LETTER[128:] = True
_FOLD = np.where(_LETTER[utf8.LOWER], utf8.LOWER, EDGE).astype(np.uint8)


@dataclass
class LanguageModel:
    languages: list[str]
    table: np.ndarray  # subword bucket x language
    bias: np.ndarray
    threshold: float  # scores below are rejected


def subwords(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the subwords of a run of texts, and the text each belongs to."""
    folded = _FOLD[data]
    letter = folded != EDGE
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    # Runs of edges shrink to one.
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    # What stands in the text before has no say.
    first = offsets[:-1][np.diff(offsets) > 0]
    keep[first] = letter[first]
    folded, text, letter = folded[keep].astype(np.uint64), text[keep], letter[keep]
    found, of = [], []
    for n in GRAMS:
        count = len(folded) - n + 1
        if count <= 0:
            continue
        key = np.full(count, n, np.uint64)
        for i in range(n):
            key = key * np.uint64(0x100000001B3) + folded[i : i + count]
        inner = text[: count] == text[n - 1 :]
        for i in range(1, n - 1):
            inner &= letter[i : i + count]
        found.append((utf8.mix(key[inner]) % np.uint64(BUCKETS)).astype(np.int32))
        of.append(text[:count][inner])
    if not found:
        return np.empty(0, np.int32), np.empty(0, np.int64)
    return np.concatenate(found), np.concatenate(of)


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    return x / x.sum(axis=-1, keepdims=True)


def fit(
    samples: list[tuple[np.ndarray, np.ndarray, str]], dim: int = 16, epochs: int = 5, rate: float = 0.5, reject_share: float = 0.001
) -> LanguageModel:
    """Learn from (subword buckets, how often each, language) of texts with subwords; every fifth calibrates."""
    languages = sorted({language for _, _, language in samples})
    draw = np.random.default_rng(11)
    bags = [(bag, count) for bag, count, _ in samples]
    answers = [languages.index(language) for _, _, language in samples]
    embedding = draw.normal(0, 1 / dim, (BUCKETS, dim)).astype(np.float32)
    layer = np.zeros((dim, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    train = [i for i in range(len(bags)) if i % 5]
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in draw.permutation(train):
            bag, count = bags[i]
            share = (count / count.sum()).astype(np.float32)
            hidden = share @ embedding[bag]
            wrong = _softmax(hidden @ layer + bias)
            wrong[answers[i]] -= 1
            back = layer @ wrong
            layer -= step * np.outer(hidden, wrong)
            bias -= step * 0.1 * wrong
            embedding[bag] -= (step * dim) * share[:, None] * back
    table = embedding @ layer
    held = [i for i in range(len(bags)) if not i % 5]
    scores = np.array([(c / c.sum()) @ table[b] + bias for b, c in (bags[i] for i in held)])
    truth = np.array([answers[i] for i in held])
    temperature, threshold = 1.0, 0.0
    if len(held):
        loss = {t: -np.log(_softmax(scores / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in np.geomspace(0.1, 10, 41)}
        temperature = min(loss, key=loss.get)
        chance = _softmax(scores / temperature)
        right = chance.max(axis=1)[chance.argmax(axis=1) == truth]
        if len(right):
            threshold = float(np.quantile(right, reject_share)) * 0.9
    return LanguageModel(languages, (table / temperature).astype(np.float32), bias / np.float32(temperature), threshold)


def _packed(bag: np.ndarray, count: np.ndarray) -> bytes:
    """Ascending buckets and how often each, in few bytes."""
    return zlib.compress(count.astype(np.int32).tobytes() + np.diff(bag, prepend=0).astype(np.uint16).tobytes(), 1)


def _unpacked(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    data = zlib.decompress(packed)
    n = len(data) // 6
    return np.cumsum(np.frombuffer(data, np.uint16, n, 4 * n), dtype=np.int32), np.frombuffer(data, np.int32, n)


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Subword counts of each whole text."""
    for batch in batches:
        for first, end, data, offsets in utf8.texts(batch.column("text")):
            bag, of = subwords(data, offsets)
            order = np.argsort(of, kind="stable")
            pieces = np.split(bag[order], np.searchsorted(of[order], np.arange(1, end - first)))
            counted = [np.unique(piece, return_counts=True) for piece in pieces]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c).slice(first, end - first) for c in ("lang", "draw")],
                    pa.array([_packed(*one) for one in counted], pa.binary()),
                ],
                ["lang", "draw", "bag"],
            )


def train(labelled: DataFrame) -> LanguageModel:
    """A model from ``labelled`` (doc_id, text, lang).

    Of each language about as many texts are read, ``SAMPLE_ROWS`` together: those whose hash lies below a bound that
    follows from the number of its rows, so a rare language is learned from all it has, and what reaches the driver
    is the same for any number of rows and tasks. Rows without text or language are left out, repeated rows count once; without
    any row there is no language to name.
    """
    rows = labelled.where("text is not null and lang is not null")
    # One row per language.
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return fit([])
    each = -(-SAMPLE_ROWS // len(counts))
    bounds = [x for lang, n in sorted(counts.items()) for x in (F.lit(lang), F.lit(int(min(1.0, each / n) * (1 << 40))))]
    rows = rows.select("lang", "text", F.xxhash64("doc_id", "text").alias("draw"))
    drawn = rows.where(F.pmod("draw", F.lit(1 << 40)) < F.element_at(F.create_map(*bounds), F.col("lang")))
    drawn = drawn.dropDuplicates(["lang", "draw"])
    table = drawn.mapInArrow(_bags, "lang string, draw long, bag binary").toArrow().sort_by([("draw", "ascending"), ("lang", "ascending")])
    bags = zip(map(_unpacked, table["bag"].to_pylist()), table["lang"].to_pylist())
    samples = [(bag, count, lang) for (bag, count), lang in bags if len(bag)]
    # The driver goes on for a long time after training.
    del table, bags
    pa.default_memory_pool().release_unused()
    return fit(samples)


def _named(model: LanguageModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in utf8.texts(batch.column("text")):
                n = end - first
                bag, of = subwords(data, offsets)
                count = np.bincount(of, minlength=n)
                logits = np.stack(
                    [np.bincount(of, model.table[bag, k], minlength=n) for k in range(len(model.languages))], axis=1
                ) / np.maximum(count, 1)[:, None] + model.bias
                chance = _softmax(logits)
                best = chance.argmax(axis=1)
                score = np.where(count > 0, chance.max(axis=1), 0.0)
                named = np.where(count > 0, np.array(model.languages, object)[best], model.languages[0])
                columns = [batch.column(c).slice(first, n) for c in batch.schema.names if c != "text"]
                names = [c for c in batch.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(named.tolist(), pa.string()), pa.array(score)], [*names, "lang_pred", "score"]
                )

    return run


def identify(documents: DataFrame, model: LanguageModel, carry: list[str] | None = None) -> DataFrame:
    """``(*carry, lang_pred, score, rejected)`` of every row of ``documents`` (text, ...).

    A text that is NULL or holds no letter is ``und`` with score 0 and rejected; so are all texts if
    the model knows no language. Only the text counts for the answer. ``carry`` names columns to pass
    through (``doc_id`` by default).
    """
    carry = carry or ["doc_id"]
    has_letter: Column = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    if not model.languages:
        return documents.select(*carry, F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), has_letter.alias("letters"), F.col("text").cast("string"))
    row_type = rows.schema["row"].dataType.simpleString()
    named = rows.mapInArrow(_named(model), f"row {row_type}, letters boolean, lang_pred string, score double")
    return named.select(
        *[F.col(f"row.`{c}`").alias(c) for c in carry],
        F.when(F.col("letters"), F.col("lang_pred")).otherwise(UNDETERMINED).alias("lang_pred"),
        F.when(F.col("letters"), F.col("score")).otherwise(0.0).alias("score"),
        (~F.col("letters") | (F.col("score") < model.threshold)).alias("rejected"),
    )
