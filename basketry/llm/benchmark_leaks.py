"""Benchmark passages in documents: a generalised suffix automaton of the test items reads every text.

The automaton knows every sequence of words of the items. Reading a document word by word, it keeps
the longest sequence that ends at the current word and stands in some item. Wherever that is at least
a window long, all its words belong to windows of items; the suffix links lead from the current state
to that of the last window, which knows its items.
"""

from __future__ import annotations

import pickle
import re
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.storage import stored

WINDOW = 10
AUTOMATON_WORDS = 200_000
PIECE_WORDS = 10_000

# A-Z lose their case; of ASCII only letters and digits belong to words.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_WORD = re.compile(rb"[^ ]+")
SPAN_TYPE = "array<struct<begin: bigint, end: bigint>>"


def words_of(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and characters beyond ASCII; A-Z in lower case."""
    return (text or "").encode().translate(_PLAIN).split()


class Automaton:
    """Generalised suffix automaton over the words of items.

    A state stands for the sequences that end at the same places of the items: the longest has
    ``length[state]`` words, and the link leads to the state of the longest shorter one that ends
    at more places.
    """

    def __init__(self, items: Iterable[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.numbers: dict[bytes, int] = {}
        self.steps: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        coded = []
        for name, words in items:
            codes = [self.numbers.setdefault(w, len(self.numbers)) for w in words]
            coded.append((name, codes))
            state = 0
            for code in codes:
                state = self._extended(state, code)
        # Items per state of a window, and per (state, words) of an item shorter than a window.
        self.owners: dict[int, set[int]] = {}
        self.short_owners: dict[int, dict[int, set[int]]] = {}
        seen: dict[str, int] = {}
        for name, codes in coded:
            number = -1 if name is None else seen.setdefault(name, len(seen))
            self._own(number, codes)
        self.names = list(seen)
        self.ends_short = self._ends_short()

    def _new(self, length: int, steps: dict[int, int], link: int) -> int:
        self.steps.append(steps)
        self.length.append(length)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, before: int, code: int, state: int) -> int:
        """A state of its own for the sequence of ``before`` and one word, until now part of ``state``."""
        part = self._new(self.length[before] + 1, dict(self.steps[state]), self.link[state])
        self.link[state] = part
        while before >= 0 and self.steps[before].get(code) == state:
            self.steps[before][code] = part
            before = self.link[before]
        return part

    def _extended(self, last: int, code: int) -> int:
        """The state after one more word of the current item."""
        known = self.steps[last].get(code)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, code, known)
        state = self._new(self.length[last] + 1, {}, 0)
        while last >= 0 and code not in self.steps[last]:
            self.steps[last][code] = state
            last = self.link[last]
        if last >= 0:
            other = self.steps[last][code]
            if self.length[other] != self.length[last] + 1:
                other = self._split(last, code, other)
            self.link[state] = other
        return state

    def _own(self, number: int, codes: list[int]) -> None:
        state, length = 0, 0
        for code in codes:
            state, length = self.steps[state][code], min(length + 1, self.window)
            while self.length[self.link[state]] >= length:
                state = self.link[state]
            if length == self.window:
                self.owners.setdefault(state, set()).add(number)
        if 0 < len(codes) < self.window:
            self.short_owners.setdefault(state, {}).setdefault(length, set()).add(number)

    def _ends_short(self) -> list[bool]:
        """Whether a short item may end where a state is reached: it is the state's, or one of its links'."""
        ends = [False] * len(self.length)
        for state in np.argsort(self.length, kind="stable").tolist():
            ends[state] = state in self.short_owners or (self.link[state] >= 0 and ends[self.link[state]])
        return ends

    def matches(self, words: list[bytes]) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Of a document: words of its longest common sequence with an item, spans of window words, items."""
        steps, link, lengths, window, ends_short = self.steps, self.link, self.length, self.window, self.ends_short
        longest = state = length = 0
        ends = []
        for i, code in enumerate(map(self.numbers.get, words)):
            if code is None:
                state = length = 0
                continue
            step = steps[state].get(code)
            if step is None:
                # Every known word goes on from the empty sequence.
                while step is None:
                    state = link[state]
                    step = steps[state].get(code)
                length = lengths[state]
            state = step
            length += 1
            if length > longest:
                longest = length
            if length >= window or ends_short[state]:
                ends.append((i, state, length))
        spans, found = [], set()
        for i, state, length in ends:
            covered = 0
            if length >= window:
                covered = length
                while lengths[link[state]] >= window:
                    state = link[state]
                found |= self.owners[state]
            while state > 0 and ends_short[state]:
                for words_, owners in self.short_owners.get(state, {}).items():
                    if words_ <= length:
                        covered = max(covered, words_)
                        found |= owners
                state = link[state]
            if covered:
                spans.append((i - covered + 1, i + 1))
        return longest, merged(spans), {self.names[k] for k in found if k >= 0}


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans without overlaps, in order; touching ones become one."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((begin, end))
    return out


# ------------------------------------------------------ automata of the items


def _pieces(window: int):
    """Items in pieces of ``PIECE_WORDS`` words at most; neighbours share all but one word of a window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, parts, counts = [], [], []
            for name, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
                words = words_of(text)
                for first in range(0, max(len(words) - window + 1, 1) if words else 0, PIECE_WORDS):
                    part = words[first : first + PIECE_WORDS + window - 1]
                    names.append(name)
                    parts.append(b" ".join(part))
                    counts.append(len(part))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(parts, pa.binary()), pa.array(counts, pa.int64())],
                ["item", "words", "n_words"],
            )

    return run


def _built(window: int):
    def run(pieces: pd.DataFrame) -> pd.DataFrame:
        rows = sorted(zip(pieces["item"], pieces["words"]), key=lambda r: (r[0] is None, r[0] or "", r[1]))
        automaton = Automaton(((name, bytes(words).split()) for name, words in rows), window)
        return pd.DataFrame({"shard": [pieces["shard"].iloc[0]], "automaton": [pickle.dumps(automaton)]})

    return run


def automata(items: DataFrame, window: int = WINDOW, words_each: int = AUTOMATON_WORDS) -> tuple[DataFrame, int]:
    """Automata of ``items`` (item, text), each of about ``words_each`` words, built on the executors; their number."""
    pieces = stored(items.mapInArrow(_pieces(window), "item string, words binary, n_words long"))
    total = pieces.agg(F.sum("n_words")).first()[0] or 0
    n = max(1, -(-total // words_each))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("item", "words"), F.lit(n)))
    return stored(dealt.groupBy("shard").applyInPandas(_built(window), "shard long, automaton binary")), n


# --------------------------------------------------------------- documents

_loaded: tuple[str, Automaton] | None = None


def _automaton(key: str, packed: bytes) -> Automaton:
    """The automaton of a pass; a worker unpacks it once."""
    global _loaded
    if _loaded is None or _loaded[0] != key:
        _loaded = (key, pickle.loads(packed))
    return _loaded[1]


def _matching(key: str, packed):
    """Adds one automaton's matches to those of the passes before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(key, packed.value)
        for batch in batches:
            counts, longest, spans, items = [], [], [], []
            had = zip(*(batch.column(c) for c in ("text", "longest", "spans", "items")))
            for text, before, old_spans, old_items in had:
                words = words_of(text.as_py())
                most, new_spans, new_items = automaton.matches(words)
                counts.append(len(words))
                longest.append(max(most, before.as_py()))
                if len(old_spans):
                    new_spans = merged(new_spans + [(s["begin"], s["end"]) for s in old_spans.as_py()])
                spans.append([{"begin": b, "end": e} for b, e in new_spans])
                items.append(sorted(new_items.union(old_items.as_py()) if len(old_items) else new_items))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("text"),
                    pa.array(counts, pa.int64()),
                    pa.array(longest, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
                    pa.array(items, pa.list_(pa.string())),
                ],
                ["row", "text", "n_words", "longest", "spans", "items"],
            )

    return run


def _matched(documents: DataFrame, items: DataFrame, window: int, carry: list[str], words_each: int) -> DataFrame:
    """``(row, text, n_words, longest, spans, items)``; ``row`` holds the columns of ``carry``."""
    spark = documents.sparkSession
    named = items.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    packed, n = automata(named, window, words_each)
    found = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"),
        F.col("text").cast("string").alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.lit(0).cast("long").alias("longest"),
        F.array().cast(SPAN_TYPE).alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    for shard in range(n):
        row = packed.where(F.col("shard") == shard).select("automaton").first()
        automaton = spark.sparkContext.broadcast(bytes(row.automaton) if row else pickle.dumps(Automaton([], window)))
        if shard:
            found = stored(found)
        found = found.mapInArrow(_matching(uuid.uuid4().hex, automaton), found.schema)
    return found


def match_items(
    documents: DataFrame, items: DataFrame, window: int = WINDOW, carry: list[str] | None = None, words_each: int = AUTOMATON_WORDS
) -> DataFrame:
    """``(*carry, n_words, longest, spans, items)`` of every document (text, ...).

    ``items`` has columns (item_id, text). A window is ``window`` consecutive words of an item, or all words of an item that
    has fewer, but any. ``longest`` counts the words of the longest sequence that the document shares
    with an item; ``spans`` (begin, end) are the words inside occurrences of windows, numbered from 0,
    without overlaps; ``items`` the ids, as sorted strings, of the items whose windows occur. Texts that are NULL or
    hold no word match nothing. Items with equal ids count as one; those without an id match, but are
    not listed. Rows of ``documents`` are treated each by itself, whatever their ids.

    The words of the items are counted first. Up to ``words_each`` go into one automaton, which is
    broadcast; more items make more automata of that size, and a pass over the documents each.
    """
    carry = carry or ["doc_id"]
    found = _matched(documents, items, window, carry, words_each)
    return found.select(*[F.col(f"row.`{c}`").alias(c) for c in carry], "n_words", "longest", "spans", "items")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, spans in zip(batch.column("text"), batch.column("spans")):
            text = text.as_py()
            if len(spans):
                data = text.encode()
                words = [m.span() for m in _WORD.finditer(data.translate(_PLAIN))]
                kept, at = [], 0
                for span in spans.as_py():
                    kept.append(data[at : words[span["begin"]][0]])
                    at = words[span["end"] - 1][1]
                text = (b"".join(kept) + data[at:]).decode()
            texts.append(text)
        columns = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in batch.schema.names]
        yield pa.RecordBatch.from_arrays(columns, batch.schema.names)


def decontaminate(
    documents: DataFrame, items: DataFrame, window: int = WINDOW, longest_kept: int | None = None, coverage_kept: float = 0.5
) -> DataFrame:
    """The documents, with the same columns, without what they share with benchmark items.

    Spans of windows are cut out of the texts. A document goes altogether if more than the share ``coverage_kept`` of its
    words lies in such spans, or if it shares a sequence of more than ``longest_kept`` words with an item.
    """
    matched = _matched(documents, items, window, [c for c in documents.columns if c != "text"], AUTOMATON_WORDS)
    hit = words_in("spans")
    keep = hit <= F.lit(coverage_kept) * F.col("n_words")
    if longest_kept is not None:
        keep &= F.col("longest") <= longest_kept
    kept = matched.where(keep).select("row", "text", "spans")
    cut = kept.mapInArrow(_cut, kept.schema)
    return cut.select(*[F.col("text" if c == "text" else f"row.`{c}`").alias(c) for c in documents.columns])


def words_in(spans: str):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])


def leak_digest(matched: DataFrame) -> DataFrame:
    """Per row of :func:`match_items`: words, words in windows, items and a digest of their ids."""
    n_hit = words_in("spans")
    return matched.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
