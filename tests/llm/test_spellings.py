"""Spelling variants against all one-edit changes of every word, and the vocabulary against plain Python."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from basketry.llm import spellings
from basketry.llm.queries import op13_spelling_variants

SMALL = "/root/testdata/sf0.001"
FOLD = str.maketrans(spellings.UPPER, spellings.LOWER)


def brute_vocabulary(rows: list[tuple], letters: int = 6, count: int = 5, every: int | None = 199) -> dict[str, int]:
    seen: Counter = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(FOLD)
            h = 1 if doc_id is None or every is None else zlib.crc32(f"{doc_id}:{run}".encode())
            if every and h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= letters and n >= count}


def brute_groups(n: dict[str, int], times: int = 5) -> dict[str, tuple]:
    """Near words meet where a letter is taken out, or two words agree but for one place."""
    holes: dict[tuple, set[str]] = {}
    for w in n:
        for i in range(len(w)):
            holes.setdefault(("replaced", w[:i], w[i + 1 :]), set()).add(w)
            holes.setdefault(("deleted", w[:i] + w[i + 1 :]), set()).add(w)
    near = {w: set() for w in n}
    for w in n:
        for i in range(len(w)):
            near[w] |= holes["replaced", w[:i], w[i + 1 :]]
            if w[:i] + w[i + 1 :] in n:
                near[w].add(w[:i] + w[i + 1 :])
        near[w] |= holes.get(("deleted", w), set())
        near[w].discard(w)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= times * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def groups(frame) -> dict[str, tuple]:
    rows = frame.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def random_vocabulary(draw: random.Random, size: int) -> dict[str, int]:
    """Words of few letters: anagrams, repeated letters, chains of edits, ties, and long ones."""
    words = {"".join(draw.choice("abé") for _ in range(draw.randrange(4, 9))) for _ in range(size)}
    base = "".join(draw.sample("abcdefghijklmnopqrstuvwxyz", 10))
    words |= {"".join(draw.sample(base, 10)) for _ in range(size)}
    for _ in range(size):
        w = draw.choice(sorted(words))
        i = draw.randrange(len(w))
        words.add(draw.choice([w[:i] + w[i + 1 :], w[:i] + draw.choice("abzÿÀ") + w[i:], w[:i] + "ß" + w[i + 1 :]]))
    long_ = "xy" * 3000
    words |= {long_, long_[1:], long_[:-1], long_ + "z", "z" + long_[1:], "a", "b"}
    words.discard("")
    return {w: draw.choice([5, 5, 6, 30, 31, 160, 4000, 10**6]) for w in words}


@pytest.mark.parametrize("sample_words, cell_words", [(spellings.SAMPLE_WORDS, spellings.CELL_WORDS), (120, 40), (spellings.SAMPLE_WORDS, 7), (0, 10)])
def test_groups_equal_brute_force(spark, sample_words, cell_words):
    n = random_vocabulary(random.Random(cell_words), 250)
    frame = spark.createDataFrame(list(n.items()), "word string, n long")
    got = groups(spellings.spelling_groups(frame, sample_words=sample_words, cell_words=cell_words))
    assert got == brute_groups(n)


def test_every_letter_and_other_factors(spark):
    n = {chr(c) * 6: 5 for c in spellings.LETTERS} | {"aaaaab": 10, "aaaabb": 21, "baaaaa": 40}
    frame = spark.createDataFrame(list(n.items()), "word string, n long")
    assert groups(spellings.spelling_groups(frame, times=2)) == brute_groups(n, 2)


def test_a_long_chain_of_forms(spark):
    words = ["a" * 20 + "b" * i for i in range(12)]
    n = {w: 5 * 6**i for i, w in enumerate(words)}
    frame = spark.createDataFrame(list(n.items()), "word string, n long")
    got = groups(spellings.spelling_groups(frame))
    assert got == brute_groups(n) and {r[1] for r in got.values()} == {words[-1]}


def test_a_cell_of_anagrams_is_dealt_out():
    draw = random.Random(5)
    words = sorted({"".join(draw.sample("abcdefgh", 8)) for _ in range(500)})
    cells = spellings.make_cells(words, 1.0, 50)
    assert len(cells.trees[8].leaves) == 1 and cells.number == cells.parts[8][0] == -(-len(words) // 50)


def test_one_edit():
    pairs = [("abc", "abd", True), ("abc", "abc", False), ("abc", "bca", False), ("aab", "aaab", True), ("abc", "bcda", False), ("abcd", "acd", True)]
    for a, b, expected in pairs:
        assert spellings.one_edit(spellings._codes([a], len(a)), spellings._codes([b], len(b))).tolist() == [expected]
    assert spellings.one_edit(np.zeros((0, 3), np.uint8), np.zeros((0, 4), np.uint8)).tolist() == []


def test_vocabulary_of_awkward_texts(spark):
    draw = random.Random(3)
    runs = ["".join(draw.choice("abcdéÀ×÷ßÿXYZ") for _ in range(draw.randrange(3, 9))) for _ in range(60)]
    rows = [(i, draw.choice([" ", "-", "1", "漢"]).join(draw.choice(runs) for _ in range(60))) for i in range(80)]
    rows += [(None, "nobody " * 7), (None, None), (3, ""), (4, "12 !?"), (5, "Long" * 4000 + " "), *[(6, "Longer" * 500)] * 6, rows[0], rows[0]]
    documents = spark.createDataFrame([(*r, "w", 1) for r in rows], "doc_id long, text string, word string, n int")
    for every in (199, 3, None):
        got = dict(spellings.vocabulary(documents, edit_every=every).collect())
        assert got == brute_vocabulary(rows, every=every)


def test_empty_tables(spark):
    documents = spark.createDataFrame([], "doc_id long, text string")
    assert spellings.spelling_groups(spellings.vocabulary(documents)).collect() == []


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    frame = op13_spelling_variants(spark, SMALL)
    assert frame.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = groups(frame)
    assert got == brute_groups(brute_vocabulary(rows)) and len(got) > 100
