"""Periodic runs against a search of all periods and starts, and the query's digests against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from basketry.llm import periodic
from basketry.llm.queries import op11_periodic_runs

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, row string, runs string, n_words int"


def brute_runs(words: list, least: int = 24, repeats: int = 3) -> list[tuple[int, int, int]]:
    """Every stretch with a period, by trying each period; the smallest period of a stretch counts."""
    found: dict[tuple[int, int], int] = {}
    n = len(words)
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if length >= max(least, repeats * q):
                found.setdefault((start, length), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_row(doc_id: int | None, text: str | None) -> tuple:
    """One row of the query, by its contract."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    collapsed = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (
        len(runs),
        *(best or (None, None, None)),
        1000 * best[1] // best[2] if best else None,
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(collapsed.encode()).hexdigest(),
    )


def random_words(draw: random.Random) -> list[int]:
    """Words over a small or large alphabet, with repeated and nested pieces, some of them with a fault."""
    out: list[int] = []
    alphabet = draw.choice([1, 2, 3, 50])
    for _ in range(draw.randrange(1, 6)):
        piece = [draw.randrange(alphabet) for _ in range(draw.randrange(1, 14))]
        if draw.random() < 0.4:
            piece = piece * draw.randrange(2, 5) + [draw.randrange(alphabet)]
        out += piece * draw.randrange(1, 12)
        if draw.random() < 0.3:
            out[draw.randrange(len(out))] = draw.randrange(alphabet)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_brute_force(seed):
    draw = random.Random(seed)
    for _ in range(60):
        texts = [random_words(draw) if draw.random() < 0.9 else [] for _ in range(draw.randrange(1, 5))]
        words = np.array([w for text in texts for w in text], np.int64)
        starts = np.cumsum([0, *map(len, texts)])
        for least, repeats in ((24, 3), (6, 3), (10, 4)):
            got = periodic.runs_of(words, starts, least, repeats)
            assert got == {t: r for t, text in enumerate(texts) if (r := brute_runs(text, least, repeats))}


def test_a_passage_between_changing_words_is_no_run():
    passage = list(range(100, 130))
    words = np.array([w for i in range(300) for w in [*passage, 1000 + i]], np.int64)
    assert periodic.runs_of(words, np.array([0, len(words)])) == {}


def test_long_texts_of_one_word_and_of_one_line():
    for q in (1, 7):
        words = np.arange(60_000) % q
        assert periodic.runs_of(words, np.array([0, 60_000])) == {0: [(0, 60_000, q)]}


@pytest.fixture(scope="module")
def awkward(spark):
    draw = random.Random(1)
    prose = " ".join(f"w{draw.randrange(500)}" for _ in range(300))
    texts = [
        None, "", " \n\t ", "one", "ha " * 24, "ha " * 23, "Ha ha " * 20, prose, prose, f"{prose} {'a b c ' * 30}{prose} {'x y z\n' * 9}",
        "line one of the page\r\n" * 500 + "the end", "é ü 漢字 😀 " * 40, "a " * 30 + "b " * 30, *[" ".join(map(str, random_words(draw))) for _ in range(60)],
    ]
    rows = [(i, t, "r", "s", 3) for i, t in enumerate(texts)]
    rows += [(None, "no id " * 20, None, None, None), rows[9], (9, "another text " * 12, "r", "s", 3)]
    return rows, spark.createDataFrame(rows, SCHEMA)


def found_rows(frame) -> list[tuple]:
    return sorted(map(repr, ((r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) for r in frame.collect())))


def test_query_equals_brute_force_on_awkward_rows(awkward):
    rows, frame = awkward
    got = periodic.run_digest(periodic.collapse_runs(periodic.with_planted_repeats(frame)))
    assert found_rows(got) == sorted(repr((r[0], *brute_row(r[0], r[1]))) for r in rows)
    assert [t for _, t in got.dtypes] == ["bigint"] * 6 + ["string"] * 2


def test_query_equals_brute_force_on_documents(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert found_rows(op11_periodic_runs(spark, SMALL)) == sorted(repr((r.doc_id, *brute_row(r.doc_id, r.text))) for r in documents)


def test_operator_keeps_rows_and_carried_columns(spark, awkward):
    rows, frame = awkward
    got = periodic.collapse_runs(frame, carry=["doc_id", "row", "runs"]).drop("runs")
    assert got.columns[:2] == ["doc_id", "row"] and got.count() == len(rows)
    texts = {r.doc_id: r.collapsed for r in periodic.collapse_runs(frame).collect()}
    assert texts[0] == texts[1] == texts[2] == "" and texts[4] == "ha" and texts[5] == " ".join(["ha"] * 23)
    assert texts[12] == "a b" and texts[10] == "line one of the page the end"
    assert periodic.collapse_runs(frame.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic.collapse_runs(frame, repeats=2)
