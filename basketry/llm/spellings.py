"""Spelling variants of a corpus: words one edit apart, found in k-d trees over letter counts.

One inserted letter adds one to a single letter count; one replaced letter takes one off a count and
adds one to another. So of a word the words one edit away lie, as vectors of letter counts, at an L1
distance of one (lengths that differ by one) or two (equal lengths), with at most one count up and at most one
down. Words of a length are kept in k-d trees over these vectors; a range search leaves out every box
that needs more. Vectors at the right distance only say that the letters fit: their order is
compared last.

The upper part of the trees comes from a sample of the vocabulary and cuts it into cells; it travels with the tasks. Each
word goes to its own cell as a member, and as a query to every cell that its range meets. Below,
each task builds the lower part of the tree of a cell, and answers the queries as they stream by.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.storage import Steps, stored

SAMPLE_WORDS = 100_000
CELL_WORDS = 4_000
LEAF_POINTS = 64
QUERY_BLOCK = 2_048
PAIR_BLOCK = 1 << 19
PAIR_BYTES = 1 << 23

# The letters of words, as code points below 256.
LETTERS = [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]
_PLACE = np.full(256, -1)
_PLACE[LETTERS] = np.arange(len(LETTERS))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# -------------------------------------------------------------- vocabulary


def vocabulary(documents: DataFrame, least_letters: int = 6, least_count: int = 5, edit_every: int | None = None) -> DataFrame:
    """(word, n): words of ``least_letters`` or more and how often they occur, ``least_count`` times or more.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF; only A-Z lose their case. With
    ``edit_every`` m, a run loses a letter where the CRC-32 h of ``<doc_id>:<run>`` is divisible by m: the one at h modulo its
    length. Runs of documents without an id stay whole. NULL texts have no words.
    """
    runs = documents.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("([A-Za-zÀ-ÿ]+)"), F.lit(1))).alias("run"))
    runs = runs.where(F.length("run") >= least_letters)
    # Most runs are in lower case already, which is cheaper to see than to make.
    plain = F.when(F.lower("run") == F.col("run"), F.col("run")).otherwise(F.translate("run", UPPER, LOWER))
    words = runs.select("doc_id", plain.alias("word"))
    if edit_every is not None:
        h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("word")).cast("binary"))
        at = (h % F.length("word")).cast("int")
        shorter = F.concat(F.substring(F.col("word"), F.lit(1), at), F.substring(F.col("word"), at + 2, F.length("word")))
        words = words.select(F.when(h % edit_every == 0, shorter).otherwise(F.col("word")).alias("word"))
        words = words.where(F.length("word") >= least_letters)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _codes(words: list[str], length: int) -> np.ndarray:
    """Words of one length as rows of letters."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), length)


def _counts(codes: np.ndarray) -> np.ndarray:
    rows, length = codes.shape
    place = _PLACE[codes] + np.arange(rows)[:, None] * len(LETTERS)
    counts = np.bincount(place.ravel(), minlength=rows * len(LETTERS)).reshape(rows, len(LETTERS))
    return counts.astype(np.int16 if length < 2**15 else np.int32)


# -------------------------------------------------------------- k-d trees


@dataclass
class Tree:
    """A k-d tree: a box (low, high) per node, children or, for a leaf, its number."""

    low: list[np.ndarray] = field(default_factory=list)
    high: list[np.ndarray] = field(default_factory=list)
    children: list[tuple[int, int] | None] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)
    leaves: list[np.ndarray] = field(default_factory=list)

    def grow(self, points: np.ndarray, inside: np.ndarray, leaf_size: int, box: tuple[np.ndarray, np.ndarray] | None) -> int:
        """Add the node of the points numbered ``inside``; with ``box`` that is its box, else its points' own."""
        here = points[inside]
        low, high = box if box is not None else (here.min(axis=0), here.max(axis=0))
        node = len(self.low)
        self.low.append(low)
        self.high.append(high)
        self.children.append(None)
        self.leaf.append(-1)
        cut = _cut(here) if len(inside) > leaf_size else None
        if cut is None:
            self.leaf[node] = len(self.leaves)
            self.leaves.append(inside)
            return node
        letter, value = cut
        left = here[:, letter] <= value
        boxes = [None, None]
        if box is not None:
            below, above = high.copy(), low.copy()
            below[letter], above[letter] = value, value + 1
            boxes = [(low, below), (above, high)]
        self.children[node] = (
            self.grow(points, inside[left], leaf_size, boxes[0]),
            self.grow(points, inside[~left], leaf_size, boxes[1]),
        )
        return node

    def reached(self, queries: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
        """Each leaf whose box holds a vector with counts ``up`` above and ``down`` below a query's at most; the queries."""
        todo = [(0, np.arange(len(queries)))] if self.low else []
        while todo:
            node, active = todo.pop()
            here = queries[active]
            fits = np.maximum(self.low[node] - here, 0).sum(axis=1) <= up
            fits &= np.maximum(here - self.high[node], 0).sum(axis=1) <= down
            active = active[fits]
            if len(active) == 0:
                continue
            children = self.children[node]
            if children is None:
                yield self.leaf[node], active
            else:
                todo += [(child, active) for child in children]


def _cut(points: np.ndarray) -> tuple[int, int] | None:
    """The letter and count that part the points most evenly; None if all are equal."""
    half = len(points) // 2
    middle = np.partition(points, half, axis=0)[half]
    best = None
    for value in (middle, middle - 1):
        below = (points <= value).sum(axis=0)
        uneven = np.where((below > 0) & (below < len(points)), np.abs(2 * below - len(points)), len(points) + 1)
        letter = int(uneven.argmin())
        if uneven[letter] <= len(points) and (best is None or uneven[letter] < best[0]):
            best = (uneven[letter], letter, int(value[letter]))
    return None if best is None else best[1:]


# ------------------------------------------------------------------- cells


@dataclass
class Cells:
    """The upper trees by length; per leaf its first cell, and into how many its members are dealt by hash."""

    trees: dict[int, Tree]
    first: dict[int, list[int]]
    parts: dict[int, list[int]]
    number: int


def make_cells(sample: list[str], share: float, cell_words: int = CELL_WORDS) -> Cells:
    """Cells of about ``cell_words`` words for a vocabulary of which ``sample`` is the given share.

    A leaf that no letter count divides, because all its words are made of the same letters, is dealt into
    several cells, and its queries go to each.
    """
    by_length: dict[int, list[str]] = {}
    for word in sample:
        by_length.setdefault(len(word), []).append(word)
    size = max(1, math.ceil(cell_words * share))
    cells = Cells({}, {}, {}, 0)
    for length, words in sorted(by_length.items()):
        counts = _counts(_codes(words, length))
        tree = Tree()
        everything = np.zeros(len(LETTERS), counts.dtype), np.full(len(LETTERS), length, counts.dtype)
        tree.grow(counts, np.arange(len(words)), size, everything)
        parts = [-(-len(leaf) // size) for leaf in tree.leaves]
        cells.trees[length], cells.parts[length] = tree, parts
        cells.first[length] = (cells.number + np.cumsum([0, *parts[:-1]])).tolist()
        cells.number += sum(parts)
    return cells


def _routed(cells: Cells, lengths: set[int]):
    """Each word as a member (kind 0) of its cell and as a query (kind 1) of all cells that its range meets.

    A length of the vocabulary that the sample lacks is one cell.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, n, deal = (np.array(batch.column(c).to_pylist(), object) for c in ("word", "n", "deal"))
            length = np.array([len(w) for w in words], np.int64)
            to, kind, row = [], [], []

            def send(cell, rows: np.ndarray, as_kind: int) -> None:
                to.append(np.broadcast_to(cell, len(rows)))
                kind.append(np.full(len(rows), as_kind))
                row.append(rows)

            for own in np.unique(length).tolist():
                of_length = np.flatnonzero(length == own)
                counts = _counts(_codes(words[of_length].tolist(), own))
                # Searches: the other word's length, letter counts that go up, that go down.
                for other, up, down in ((own, 0, 0), (own, 1, 1), (own + 1, 1, 0), (own - 1, 0, 1)):
                    member = up == 0 and down == 0
                    if other not in lengths:
                        continue
                    if other not in cells.trees:
                        send(-other, of_length, 0 if member else 1)
                        continue
                    for leaf, active in cells.trees[other].reached(counts, up, down):
                        first, parts, rows = cells.first[other][leaf], cells.parts[other][leaf], of_length[active]
                        if member:
                            send(first + deal[rows].astype(np.int64) % parts, rows, 0)
                        else:
                            for part in range(parts):
                                send(first + part, rows, 1)
            if row:
                rows = np.concatenate(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(to), pa.int64()),
                        pa.array(np.concatenate(kind), pa.int8()),
                        pa.array(words[rows], pa.string()),
                        pa.array(n[rows], pa.int64()),
                    ],
                    ["cell", "kind", "word", "n"],
                )

    return run


# ------------------------------------------------------------- in one cell


class Cell:
    """The members of a cell, words of one length, with the lower part of the tree."""

    def __init__(self, words: list[str], n: list[int]):
        self.length = len(words[0])
        by = sorted(range(len(words)), key=lambda i: (-n[i], words[i]))
        # Members in the order in which they are preferred as forms.
        self.words, self.n = [words[i] for i in by], [n[i] for i in by]
        self.codes = _codes(self.words, self.length)
        self.points, of = np.unique(_counts(self.codes), axis=0, return_inverse=True)
        of = of.ravel()
        self.members = np.argsort(of, kind="stable")
        self.first = np.searchsorted(of[self.members], np.arange(len(self.points) + 1))
        self.tree = Tree()
        self.tree.grow(self.points, np.arange(len(self.points)), LEAF_POINTS, None)

    def near(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of query words of one length: how many members are one edit away, and the preferred one (or -1)."""
        counts = _counts(codes)
        number, best = np.zeros(len(codes), np.int64), np.full(len(codes), len(self.words))
        more = self.length - codes.shape[1]
        up, down = (1, 1) if more == 0 else (max(more, 0), max(-more, 0))
        for leaf, active in self.tree.reached(counts, up, down):
            inside = self.tree.leaves[leaf]
            for block in range(0, len(active), QUERY_BLOCK):
                some = active[block : block + QUERY_BLOCK]
                query, point = self._letters_fit(counts[some], inside, max(self.length, codes.shape[1]) - 1)
                if len(query):
                    self._count(codes, some[query], inside[point], number, best)
        return number, np.where(best < len(self.words), best, -1)

    def _letters_fit(self, queries: np.ndarray, inside: np.ndarray, common: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a query and a point that have ``common`` letters in common."""
        points = self.points[inside]
        low, high = points.min(axis=0), points.max(axis=0)
        same = low == high
        shared = np.minimum(queries[:, same], low[same]).sum(axis=1, dtype=np.int32)[:, None]
        shared = np.repeat(shared, len(points), axis=1)
        for letter in np.flatnonzero(~same):
            shared += np.minimum(queries[:, letter, None], points[None, :, letter])
        return np.nonzero(shared == common)

    def _count(self, codes: np.ndarray, query: np.ndarray, point: np.ndarray, number: np.ndarray, best: np.ndarray) -> None:
        """Compare the letters of each query with those of each member at the point, in blocks."""
        size = self.first[point + 1] - self.first[point]
        upto = np.cumsum(size)
        begin = 0
        while begin < len(size):
            done = upto[begin - 1] if begin else 0
            end = max(int(np.searchsorted(upto, done + PAIR_BLOCK, "right")), begin + 1)
            count = size[begin:end]
            total = int(count.sum())
            who = np.repeat(query[begin:end], count)
            place = np.arange(total) - np.repeat(np.cumsum(count) - count, count) + np.repeat(self.first[point[begin:end]], count)
            member = self.members[place]
            block = max(1, PAIR_BYTES // self.length)
            for piece in range(0, total, block):
                q, m = who[piece : piece + block], member[piece : piece + block]
                close = one_edit(codes[q], self.codes[m])
                number += np.bincount(q[close], minlength=len(number))
                np.minimum.at(best, q[close], m[close])
            begin = end


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the words in equal rows differ by exactly one letter, replaced or inserted."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    short, long_ = (a, b) if a.shape[1] < b.shape[1] else (b, a)
    before = np.cumprod(short == long_[:, :-1], axis=1, dtype=np.int8).sum(axis=1, dtype=np.int64)
    after = np.cumprod((short == long_[:, 1:])[:, ::-1], axis=1, dtype=np.int8).sum(axis=1, dtype=np.int64)
    return before + after >= short.shape[1]


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell, members first: the members of a cell are kept, its queries answered as they come."""
    cell, members, n, index = None, [], [], None
    for batch in batches:
        number = np.asarray(batch.column("cell"))
        kind = np.asarray(batch.column("kind"))
        change = np.flatnonzero((np.diff(number) != 0) | (np.diff(kind) != 0)) + 1
        for begin, end in zip([0, *change], [*change, len(number)]):
            if begin == end:
                continue
            if number[begin] != cell:
                cell, members, n, index = number[begin], [], [], None
            words = batch.column("word").slice(begin, end - begin).to_pylist()
            if kind[begin] == 0:
                members += words
                n += batch.column("n").slice(begin, end - begin).to_pylist()
                continue
            if not members:
                continue
            if index is None:
                index = Cell(members, n)
            length = np.array([len(w) for w in words])
            for size in np.unique(length).tolist():
                some = [words[i] for i in np.flatnonzero(length == size)]
                near, best = index.near(_codes(some, size))
                hit = np.flatnonzero(near)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([some[i] for i in hit], pa.string()),
                        pa.array(near[hit], pa.int64()),
                        pa.array([index.n[best[i]] for i in hit], pa.int64()),
                        pa.array([index.words[best[i]] for i in hit], pa.string()),
                    ],
                    ["word", "n_near", "form_n", "form"],
                )


# ------------------------------------------------------------------ groups


def nearest_spellings(words: DataFrame, sample_words: int = SAMPLE_WORDS, cell_words: int = CELL_WORDS) -> DataFrame:
    """(word, n_near, form_n, form) of each of ``words`` (word, n) that has a word one edit away.

    Words are distinct and made of a-z and U+00C0 to U+00FF. ``form`` is the near word of largest n
    (ties: the smallest), ``n_near`` their number. The upper trees are fitted to about ``sample_words`` words, drawn by hash;
    they decide which cells there are, not what is found.
    """
    # One row per length.
    lengths = {r.length: r["count"] for r in words.groupBy(F.length("word").alias("length")).count().collect()}
    size = sum(lengths.values())
    share = min(1.0, sample_words / max(size, 1))
    drawn = words.where(F.pmod(F.xxhash64("word", F.lit("sample")), F.lit(1 << 30)) < int(share * (1 << 30)))
    cells = make_cells(sorted(r.word for r in drawn.select("word").collect()), share, cell_words)
    dealt = words.select("word", "n", F.pmod(F.xxhash64("word"), F.lit(1 << 20)).alias("deal"))
    routed = dealt.mapInArrow(_routed(cells, set(lengths)), "cell long, kind byte, word string, n long")
    placed = routed.repartition(max(cells.number, 1), "cell").sortWithinPartitions("cell", "kind")
    found = placed.mapInArrow(_search, "word string, n_near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form"))).alias("best")
    merged = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return merged.select("word", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.form").alias("form"))


def spelling_groups(words: DataFrame, times: int = 5, sample_words: int = SAMPLE_WORDS, cell_words: int = CELL_WORDS) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of each of ``words`` (word, n).

    The form of a word is its near word of largest n, if that is ``times`` (2 or more) its own n or more; the root is the last
    word that following forms leads to. n grows with every step, so chains are short: pointers are doubled
    until none moves on. Words without a near word have ``n_near`` 0.
    """
    words = stored(words)
    steps = Steps(words.sparkSession)
    near = words.join(nearest_spellings(words, sample_words, cell_words), "word", "left")
    followed = F.col("form_n") >= times * F.col("n")
    near = stored(
        near.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(followed, F.col("form")).alias("form"), F.when(followed, F.col("form_n")).alias("form_n"),
        )
    )
    pointers = steps.keep(near.where("form is not null").select("word", F.col("form").alias("root")))
    while True:
        onward = pointers.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = steps.keep(pointers.join(onward, "root", "left").select("word", "root", "next"))
        if moved.where("next is not null").isEmpty():
            break
        pointers = steps.keep(moved.select("word", F.coalesce("next", "root").alias("root")))
    grouped = stored(near.join(pointers, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")))
    steps.clear()
    return grouped
