"""Benchmark passages against a search for every window, and against SQL."""

from __future__ import annotations

import hashlib
import random
import re

import duckdb
import pytest

from basketry.llm import benchmark_leaks as leaks
from basketry.llm.oracle import BENCHMARK_LEAKS
from basketry.llm.queries import op12_benchmark_leaks

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, items string, spans int, n_words string"


def brute_words(text: str | None) -> list[str]:
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(doc: list, items: list[tuple], window: int = 10) -> tuple[int, set[int], list]:
    """Longest common sequence, words hit, items met."""
    hit, met, longest = set(), set(), 0
    for name, words in items:
        n = min(window, len(words))
        parts = {tuple(words[j : j + n]) for j in range(len(words) - n + 1)} if words else set()
        for i in range(len(doc)):
            if n and tuple(doc[i : i + n]) in parts:
                hit |= set(range(i, i + n))
                met.add(name)
            for j in range(len(words)):
                k = 0
                while i + k < len(doc) and j + k < len(words) and doc[i + k] == words[j + k]:
                    k += 1
                longest = max(longest, k)
    return longest, hit, sorted(x for x in met if x is not None)


def covered(spans: list[tuple[int, int]]) -> set[int]:
    return {i for begin, end in spans for i in range(begin, end)}


@pytest.mark.parametrize("seed", range(4))
def test_automaton_equals_brute_force(seed):
    draw = random.Random(seed)
    for _ in range(60):
        size = draw.choice([1, 2, 3, 8])
        text = lambda n: [b"w%d" % draw.randrange(size) for _ in range(draw.randrange(n))]
        window = draw.choice([2, 4, 10])
        items = [(str(draw.randrange(4)) if draw.random() < 0.9 else None, text(18)) for _ in range(draw.randrange(5))]
        doc = text(60)
        for _ in range(draw.randrange(3)):
            if items:
                at = draw.randrange(len(doc) + 1)
                doc[at:at] = draw.choice(items)[1]
        doc += [b"unknown"] * draw.randrange(2) + text(10)
        longest, spans, met = leaks.Automaton(items, window).matches(doc)
        assert (longest, covered(spans), sorted(met)) == brute(doc, items, window)
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


@pytest.fixture(scope="module")
def tables(spark):
    draw = random.Random(8)
    say = lambda n: " ".join(f"w{draw.randrange(60)}" for _ in range(n))
    items = [(i, say(draw.choice([12, 30, 80]))) for i in range(12)]
    items += [(12, "The Short-item: Ünder 10"), (13, "one"), (14, None), (15, " ... "), (None, say(15)), (3, say(14)), (16, items[0][1]), (17, "Über " * 11)]
    texts = [None, "", " !? ", "ONE", "one", "the short item, ünder 10 words", "the short item Ünder 10 words", say(20_000), "über " * 30, "Über " * 30]
    for _ in range(40):
        words = say(draw.randrange(5, 60)).split()
        for _ in range(draw.randrange(3)):
            leak = (draw.choice(items)[1] or "").split()
            words[draw.randrange(len(words)) :][:0] = leak
            cut = draw.randrange(len(leak) + 1)
            at = draw.randrange(len(words) + 1)
            words[at:at] = leak[cut : cut + draw.randrange(8, 14)]
        texts.append(draw.choice([" ", ", ", "\n"]).join(words).upper())
    rows = [(i, t, "x", 1, "y") for i, t in enumerate(texts)] + [(None, items[0][1], None, None, None), (20, texts[20], "x", 1, "y"), (20, items[1][1], "x", 1, "y")]
    return rows, items, spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, "item_id long, text string")


def expected_rows(rows, items) -> list[str]:
    known = [(None if name is None else str(name), brute_words(text)) for name, text in items]
    out = []
    for doc_id, text, *_ in rows:
        words = brute_words(text)
        _, hit, met = brute(words, known) if len(words) < 5000 else (0, *brute_fast(words, known))
        out.append(repr((doc_id, len(words), len(hit), len(met), hashlib.sha256(",".join(met).encode()).hexdigest(), bool(hit))))
    return sorted(out)


def brute_fast(doc, items):
    places: dict[tuple, list[int]] = {}
    hit, met = set(), set()
    for n in {min(10, len(w)) for _, w in items if w}:
        places = {}
        for i in range(len(doc) - n + 1):
            places.setdefault(tuple(doc[i : i + n]), []).append(i)
        for name, words in items:
            if words and min(10, len(words)) == n:
                for j in range(len(words) - n + 1):
                    for i in places.get(tuple(words[j : j + n]), ()):
                        hit |= set(range(i, i + n))
                        met.add(name)
    return hit, sorted(x for x in met if x is not None)


def found_rows(frame) -> list[str]:
    return sorted(repr((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)) for r in frame.collect())


@pytest.mark.parametrize("words_each", [leaks.AUTOMATON_WORDS, 150])
def test_documents_equal_brute_force(tables, words_each):
    rows, items, documents, benchmark = tables
    got = leaks.leak_digest(leaks.match_items(documents, benchmark, words_each=words_each))
    assert found_rows(got) == expected_rows(rows, items)


def test_items_in_pieces_lose_no_window(tables, monkeypatch):
    rows, items, documents, benchmark = tables
    monkeypatch.setattr(leaks, "PIECE_WORDS", 7)
    pieces = [r for b in [benchmark.select(benchmark.item_id.cast("string").alias("item"), "text").toArrow()] for r in b.to_batches()]
    parts = [row for batch in leaks._pieces(10)(iter(pieces)) for row in batch.to_pylist()]
    assert max(p["n_words"] for p in parts) <= 16
    automaton = leaks.Automaton(((p["item"], p["words"].split()) for p in parts))
    whole = leaks.Automaton((None if n is None else str(n), leaks.words_of(t)) for n, t in items)
    for row in rows:
        assert automaton.matches(leaks.words_of(row[1]))[1:] == whole.matches(leaks.words_of(row[1]))[1:]


def test_no_items_and_no_documents(tables):
    rows, _, documents, benchmark = tables
    got = leaks.leak_digest(leaks.match_items(documents, benchmark.limit(0))).collect()
    assert len(got) == len(rows) and not any(r.contaminated or r.n_items for r in got)
    assert {r.doc_id: r.n_words for r in got}[7] == 20_000
    assert leaks.match_items(documents.limit(0), benchmark).count() == 0


def test_decontaminated_documents(spark):
    draw = random.Random(2)
    item = " ".join(f"leak{i}" for i in range(30))
    own = " ".join(f"own{draw.randrange(9)}" for _ in range(50))
    documents = spark.createDataFrame(
        [(1, f"{own}.\nLeak0 {item}! {own}", "a"), (2, item, "b"), (3, own, "c"), (4, None, "d"), (5, "", None), (6, f"{item[:100]} {own}", "e")],
        "doc_id long, text string, spans string",
    )
    benchmark = spark.createDataFrame([(0, item)], "item_id long, text string")
    kept = {r.doc_id: r.text for r in leaks.decontaminate(documents, benchmark).collect()}
    assert kept == {1: f"{own}.\nLeak0 ! {own}", 3: own, 4: None, 5: "", 6: kept[6]}
    assert "leak3" not in kept[6] and kept[6].endswith(own)
    strict = leaks.decontaminate(documents, benchmark, longest_kept=29)
    assert strict.columns == documents.columns and {r.doc_id for r in strict.collect()} == {3, 4, 5, 6}


def test_query_equals_sql(spark):
    connection = duckdb.connect()
    for name in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    frame = op12_benchmark_leaks(spark, SMALL)
    expected = connection.execute(BENCHMARK_LEAKS)
    assert [c[0] for c in expected.description] == frame.columns
    assert sorted(map(tuple, frame.collect())) == sorted(expected.fetchall())
