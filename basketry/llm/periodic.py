"""Periodic runs of words: maximal pairs of the LCP-interval tree of each text.

A run is a stretch of words that repeats with a period q at least three times over and that no
neighbouring word continues. If it starts at s and has length L, the words from s on and from s + q on
agree for exactly L - q words, and the words before s and s + q differ: a maximal pair at distance q.
Turned around, a maximal pair whose words agree for l words at a distance d <= l / 2 is a stretch of
l + d words with period d that cannot be extended. So the maximal pairs of a text whose distance and
length satisfy the limits are its runs, each with its smallest period and with multiples of that; of
pairs that span the same stretch the smallest distance counts.

The pairs come from a walk over the LCP-interval tree from the leaves up. Every node holds the places
of its word sequence, each with the class of its left word, and where two children meet, places of
different children and different left classes make pairs. Of the tree only the part is built that can
hold a run: the shortest agreement that is long enough is two thirds of the least run, so suffixes
whose beginning of that length stands nowhere else in the text are no leaves.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm import utf8

LEAST_WORDS = 24
LEAST_REPEATS = 3
RUN_TYPE = "array<struct<start: bigint, length: bigint, period: bigint>>"


def _dense(keys: np.ndarray) -> np.ndarray:
    """Numbers from 0 on, equal for equal keys."""
    return np.unique(keys, return_inverse=True)[1].astype(np.int64)


def _ranks(words: np.ndarray, text: np.ndarray, long_enough: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Ranks of the sequences of 1, 2, 4, ... words from each place on, by prefix doubling inside each text.

    Sequences of one text have the same rank if and only if they are equal. A sequence that stands
    once in its text has its final rank; only the others are sorted again. Also returns, in suffix
    order, the places whose sequence of ``long_enough`` words recurs in their text.
    """
    n = len(words)
    place = np.arange(n)
    rank = np.zeros(n, np.int64)
    ranks: list[np.ndarray] = []
    leaves = np.empty(0, np.int64)
    active, width = place, 1
    key = text * (words.max(initial=0) + 1) + words
    while True:
        by = np.argsort(key, kind="stable")
        active, key = active[by], key[by]
        index = np.arange(len(active))
        old = rank[active]
        new_key = np.r_[True, key[1:] != key[:-1]]
        new_old = np.r_[True, old[1:] != old[:-1]]
        part, whole = (np.maximum.accumulate(np.where(new, index, 0)) for new in (new_key, new_old))
        rank[active] = old + part - whole
        ranks.append(rank.astype(np.int32 if n < 2**31 else np.int64))
        active = active[~(new_key & np.r_[new_key[1:], True])]
        if width == long_enough:
            leaves = active
        if len(active) == 0:
            return ranks, leaves[np.argsort(rank[leaves])]
        follows = np.minimum(active + width, n - 1)
        inside = (active + width < n) & (text[follows] == text[active])
        key = rank[active] * (n + 1) + np.where(inside, rank[follows] + 1, 0)
        width *= 2


def _common(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray, end: np.ndarray) -> np.ndarray:
    """How many words agree from the places a and b on; both stay before ``end``, the end of their text."""
    length = np.zeros(len(a), np.int64)
    last = len(ranks[0]) - 1
    for k in range(len(ranks) - 1, -1, -1):
        at = np.maximum(a, b) + length
        level = ranks[k]
        same = (at < end) & (level[np.minimum(a + length, last)] == level[np.minimum(b + length, last)])
        length += same << k
    return length


def _join(left: list[int], right: list[int], agree: int, left_word: list[int], least: int, found: dict) -> list[int]:
    """The places of two children of a node whose sequence has ``agree`` words; new pairs go to ``found``.

    Occurrences of a sequence at most half its length apart are equally spaced, and all but the
    first have the same left word. So of the places in reach before a place only the leftmost can
    have another left class, and of those after it at most one belongs to another child.
    """
    few, many = (left, right) if len(left) < len(right) else (right, left)
    reach = agree // 2
    pairs = []
    for x in few:
        class_ = left_word[x]
        low, here = bisect_left(many, x - reach), bisect_left(many, x)
        if low < here and left_word[many[low]] != class_:
            pairs.append((many[low], x))
        for y in many[here : bisect_right(many, x + reach)]:
            if left_word[y] != class_:
                pairs.append((x, y))
    for x, y in pairs:
        length = agree + y - x
        if length >= least:
            stretch = (x, length)
            found[stretch] = min(found.get(stretch, length), y - x)
    if 8 * len(few) > len(many):
        return sorted(many + few)
    for x in few:
        insort(many, x)
    return many


def _maximal_pairs(places: list[int], agree: list[int], left_word: list[int], shortest: int, least: int) -> dict[tuple[int, int], int]:
    """Stretches (start, length) with their smallest period, from the suffixes of one text in order.

    ``agree[i]`` is the number of words that suffix i shares with the one before it.
    """
    found: dict[tuple[int, int], int] = {}
    open_: list[tuple[int, list[int]]] = []
    node = [places[0]]
    for i in range(1, len(places) + 1):
        depth = agree[i] if i < len(places) else 0
        while open_ and open_[-1][0] >= max(depth, shortest):
            above, siblings = open_.pop()
            node = _join(siblings, node, above, left_word, least, found)
        if depth >= shortest:
            open_.append((depth, node))
        if i < len(places):
            node = [places[i]]
    return found


def runs_of(words: np.ndarray, starts: np.ndarray, least: int = LEAST_WORDS, repeats: int = LEAST_REPEATS) -> dict[int, list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each text that has any, by start, then period.

    ``words`` holds a number per word, ``starts`` where each text begins (and the end). A run has
    ``least`` words at least and ``repeats`` (3 or more) times its period.
    """
    # Length l + d >= least with d <= l / (repeats - 1).
    shortest = -(-least * (repeats - 1) // repeats)
    count = np.diff(starts)
    text = np.repeat(np.arange(len(count)), count)
    runs: dict[int, list[tuple[int, int, int]]] = {}
    if len(words) == 0:
        return runs
    ranks, order = _ranks(words, text, 1 << (shortest.bit_length() - 1))
    if len(order) == 0:
        return runs
    of = text[order]
    agree = np.zeros(len(order), np.int64)
    agree[1:] = _common(ranks, order[:-1], order[1:], starts[of[1:] + 1])
    agree[1:][of[1:] != of[:-1]] = 0
    cuts = np.flatnonzero(np.r_[True, of[1:] != of[:-1], True])
    for first, end in zip(cuts[:-1], cuts[1:]):
        t = int(of[first])
        begin = int(starts[t])
        # The left class of a text's first word is its own.
        left_word = np.r_[-1, ranks[0][begin : int(starts[t + 1]) - 1]].tolist()
        places = (order[first:end] - begin).tolist()
        pairs = _maximal_pairs(places, agree[first:end].tolist(), left_word, shortest, least)
        kept = sorted((s, d, n) for (s, n), d in pairs.items() if n >= repeats * d)
        if kept:
            runs[t] = [(s, n, d) for s, d, n in kept]
    return runs


def _dropped(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Whether each of n words stands in a run after its first period."""
    step = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        step[start + period] += 1
        step[start + length] -= 1
    return np.cumsum(step[:n]) > 0


def _collapse(least: int, repeats: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for first, end, data, offsets in utf8.texts(texts):
                hashes, starts = utf8.words(data, offsets, lower=False)
                found = runs_of(_dense(hashes), starts, least, repeats)
                runs, collapsed, counts = [], [], np.diff(starts)
                for t in range(end - first):
                    # Bytes split at exactly the white space that separates words.
                    kept = bytes(data[offsets[t] : offsets[t + 1]]).split()
                    if t in found:
                        kept = compress(kept, ~_dropped(len(kept), found[t]))
                    runs.append([{"start": s, "length": n, "period": d} for s, n, d in found.get(t, [])])
                    collapsed.append(b" ".join(kept))
                fields = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row").slice(first, end - first),
                        pa.array(counts, pa.int64()),
                        pa.array(runs, fields),
                        pa.array(collapsed, pa.binary()).cast(pa.string()),
                    ],
                    ["row", "n_words", "runs", "collapsed"],
                )

    return run


def collapse_runs(frame: DataFrame, text: str = "text", carry: list[str] | None = None, least: int = LEAST_WORDS, repeats: int = LEAST_REPEATS) -> DataFrame:
    """``(*carry, n_words, runs, collapsed)`` of every row: its periodic runs, and its text without the repeats.

    Words lie between ASCII white space and count as they stand. ``runs`` lists (start, length, period)
    in words, by start, then period: stretches of ``least`` words or more that hold their smallest
    period ``repeats`` (at least 3) times or more and that no neighbouring word continues. ``collapsed`` has each run's first period
    and all words outside runs, joined by one space. A NULL or blank text has no words, no runs and
    collapses to the empty text. ``carry`` names the columns to pass through (``doc_id`` by default);
    rows with equal or NULL ids are treated each by itself. No shuffle; a task holds one slice of
    texts (:data:`utf8.SLICE_BYTES`), or one longer text, at a time.
    """
    if repeats < 3:
        raise ValueError("a run repeats its period three times at least")
    carry = carry or ["doc_id"]
    rows = frame.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    found = rows.mapInArrow(_collapse(least, repeats), f"row {kind}, n_words long, runs {RUN_TYPE}, collapsed string")
    return found.select(*[F.col(f"row.`{c}`").alias(c) for c in carry], "n_words", "runs", "collapsed")


def with_planted_repeats(frame: DataFrame) -> DataFrame:
    """(doc_id, text) in which every tenth document, by the CRC of its id, repeats its own words from some place on.

    With h the CRC-32 of the decimal id, g = floor(h / 10) and n words, a document with h % 10 = 0 has
    from word a = g % n on the words a, ..., a + p - 1 over and over, p = 1 + floor((n - a) / (3 + g % 8)).
    Documents without an id or without words stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    planted = frame.select("doc_id", "text", F.when(h % 10 == 0, words).alias("words"), F.floor(h / 10).alias("g"))
    n = F.size("words")
    planted = planted.withColumn("a", F.when(n > 0, F.col("g") % n))
    planted = planted.withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).cast("long"))
    head = F.slice("words", F.lit(1), F.col("a").cast("int"))
    period = F.slice("words", (F.col("a") + 1).cast("int"), F.col("p").cast("int"))
    times = F.ceil((n - F.col("a")) / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(period, times)), F.lit(1), (n - F.col("a")).cast("int"))
    repeated = F.array_join(F.concat(head, tail), " ")
    return planted.select("doc_id", F.when(F.col("a").isNotNull(), repeated).otherwise(F.col("text")).alias("text"))


def run_digest(frame: DataFrame) -> DataFrame:
    """Per row of :func:`collapse_runs`: number of runs, the most repeated one, digests of runs and collapsed text.

    The most repeated run has the greatest exact length / period; ties go to the smallest start, then period.
    """
    run = F.col("runs")
    # Lengths and periods below 2^31: their cross products are exact.
    most = F.array_sort(
        run,
        lambda x, y: F.when(x["length"] * y["period"] > y["length"] * x["period"], -1)
        .when(x["length"] * y["period"] < y["length"] * x["period"], 1)
        .when(x["start"] < y["start"], -1)
        .when(x["start"] > y["start"], 1)
        .otherwise(F.when(x["period"] < y["period"], -1).when(x["period"] > y["period"], 1).otherwise(0)),
    )
    lines = F.transform(run, lambda r: F.concat_ws("", F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = frame.withColumn("best", F.get(most, F.lit(0)))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
