"""The corpus operators against brute force, round trips and held-out accuracy, on small tables."""

from __future__ import annotations

import hashlib
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import html_text, language, licences, line_dedup, mixing, nearest, pieces, quality, syncmers, utf8
from basketry.llm.graph import components
from basketry.llm.line_dedup import dedup_lines, line_classes
from basketry.llm.shingle_join import near_documents, one_per_component
from basketry.llm.storage import Steps

SMALL = "/root/testdata/sf0.001"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, id long, component long"
VOCABULARY = [f"w{i:02d}" for i in range(40)]


def words(draw: random.Random, n: int) -> list[str]:
    return [draw.choice(VOCABULARY) for _ in range(n)]


def awkward_texts() -> list[str | None]:
    """NULL, empty, blank, one word, very long, copies, near copies, unspaced."""
    draw = random.Random(4)
    base = words(draw, 120)
    near = []
    for _ in range(12):
        copy = list(base)
        for _ in range(draw.randrange(1, 4)):
            copy[draw.randrange(len(copy))] = draw.choice(VOCABULARY)
        near.append(" ".join(copy))
    return [
        None, "", "  \n\t ", "one", "ONE", "two words", "two  Words", " ".join(base), " ".join(base), *near,
        " ".join(words(draw, 20_000)), "x" * 5000, "123 456 !!", "first line\nsecond line\n\nFIRST line ", "é ü 漢字 😀",
    ]


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [(i, t, None, ["a", "b", None][i % 3], None if t is None else len(t), "r", 7, 8) for i, t in enumerate(awkward_texts())]
    rows.append((None, "no id here", "en", None, 10, "r", 7, 8))
    rows.append(rows[7])  # a repeated row
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def brute_components(texts: dict[int, str | None], k: int, percent: int) -> dict[int, int]:
    sets = {}
    for i, text in texts.items():
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((top(i), top(j)))
                up[b] = a
    return {i: top(i) for i in sets}


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 120)] + [(5, 5)]
    found = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert found == {**{i: 0 for i in range(31)}, **{i: 100 for i in range(100, 120)}}


@pytest.mark.parametrize("length, rounds", [(30, 12), (300, 18), (3000, 26)])
def test_components_of_chains_take_few_rounds(spark, length, rounds, monkeypatch):
    made = []
    keep = Steps.keep
    monkeypatch.setattr(Steps, "keep", lambda self, frame: made.append(1) or keep(self, frame))
    names = list(range(length + 1))
    random.Random(length).shuffle(names)
    for ids in (list(range(length + 1)), names):
        made.clear()
        links = spark.createDataFrame(list(zip(ids, ids[1:])), "a long, b long")
        begin = time.perf_counter()
        found = components(links, finish=2)
        assert {r.component for r in found.collect()} == {0} and found.count() == length + 1
        assert time.perf_counter() - begin < 120
        # Each round stores its choice, its links and its ends; three tables come on top.
        assert len(made) <= 3 * rounds + 3


def test_components_are_those_of_any_graph(spark):
    draw = random.Random(3)
    links = [(draw.randrange(400), draw.randrange(400)) for _ in range(260)] + [(None, 3), (4, None), (7, 7)]
    frame = spark.createDataFrame(links, "a long, b long")
    up = list(range(400))
    for a, b in links:
        if a is not None and b is not None:
            low, high = sorted((up[a], up[b]))
            up = [low if u == high else u for u in up]
    linked = {i for a, b in links for i in (a, b) if a is not None and b is not None and a != b}
    expected = {i: up[i] for i in linked}
    assert dict(components(frame, finish=2).collect()) == dict(components(frame).collect()) == expected
    assert components(frame.limit(0)).count() == 0


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80)])
def test_shingle_join_is_exact(spark, awkward, k, percent):
    got = near_documents(awkward, words_per_shingle=k, threshold=str(percent / 100)).collect()
    expected = brute_components({r.doc_id: r.text for r in awkward.collect() if r.doc_id is not None}, k, percent)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == expected
    assert len(got) == awkward.count()
    assert [r.component_id for r in got if r.doc_id is None] == [None]


def test_shingle_join_on_documents(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = near_documents(documents, words_per_shingle=3, threshold="0.9").collect()
    expected = brute_components({r.doc_id: r.text for r in documents.collect()}, 3, 90)
    assert {r.doc_id: r.component_id for r in got} == expected


def test_one_document_of_each_group_stays(awkward):
    kept = one_per_component(awkward, words_per_shingle=5, threshold="0.8")
    assert kept.columns == awkward.columns
    expected = brute_components({r.doc_id: r.text for r in awkward.collect() if r.doc_id is not None}, 5, 80)
    assert {r.doc_id for r in kept.collect()} == {i for i, c in expected.items() if i == c} | {None}


def test_fuzzy_lines(spark):
    draw = random.Random(9)
    base = " ".join(words(draw, 60))
    edited = base.replace(base.split()[7], "other", 1)
    rows = [(0, f"{base}\nalone in the corpus"), (1, f"{base.upper()}\n\nanother line here"), (2, edited), (3, None), (4, " \n "), (5, f"{base}\n")]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    lines = line_classes(documents).collect()
    assert len({r.class_id for r in lines if r.line == 0}) == 1
    assert [(r.doc_id, r.line) for r in sorted(lines) if r.kept] == [(0, 0), (0, 1), (1, 2)]
    kept = dict(dedup_lines(documents).collect())
    assert kept == {0: rows[0][1], 1: "\nanother line here", 3: None, 4: " \n "}


def test_lines_of_documents_without_a_name_of_their_own(spark):
    """A NULL or repeated doc_id: each text keeps its own lines."""
    copy = "the same opening line in two of the texts"
    rows = [(None, "only in the text without an id\nand another"), (2, f"a unique opening that nobody else has\n{copy}"), (2, f"{copy}\nsome more words"),
            (5, "twice the same row\nwith two lines"), (5, "twice the same row\nwith two lines"), (None, None), (None, ""), (None, copy)]
    documents = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, line string")
    report = line_dedup.line_report(documents).collect()
    assert sorted((r.doc_id or 0, r.n_lines, r.n_kept) for r in report) == [(0, 0, 0), (0, 0, 0), (0, 1, 1), (0, 2, 2), (2, 2, 1), (2, 2, 1), (5, 2, 2), (5, 2, 2)]
    assert [tuple(r) for r in report if r.n_lines == 0] == [(None, 0, 0, None, None)] * 2
    kept = Counter(r.text for r in dedup_lines(documents).collect())
    assert kept == Counter([rows[0][1], "a unique opening that nobody else has", "some more words", rows[3][1], rows[4][1], None, "", copy])


def test_line_classes_against_brute_force(spark):
    """Every line's class, wrong merges included, and the report's columns."""
    draw = random.Random(12)
    texts = []
    for _ in range(60):
        lines = [" ".join(words(draw, draw.randrange(1, 14))) for _ in range(draw.randrange(4))]
        if texts and draw.random() < 0.7:
            lines.append(draw.choice(draw.choice(texts).split("\n")) + draw.choice(["", " x", "\r", " w01"]))
        texts.append("\n".join(lines + [""] * draw.randrange(2)))
    sets: dict[str, set] = {}
    for text in texts:
        for line in (part.strip(" \t\n\x0b\x0c\r") for part in text.split("\n")):
            if line:
                sets[line] = {line[i : i + 8] for i in range(max(len(line) - 7, 1))}
    group = {line: line for line in sets}
    for a in sets:
        for b in sets:
            if group[a] != group[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                old, new = sorted((group[a], group[b]), reverse=True)
                group = {line: new if g == old else g for line, g in group.items()}
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen: dict[str, int] = {}
    for r in sorted(line_dedup.line_report(documents).collect()):
        found = [(i, group[line]) for i, line in enumerate(part.strip(" \t\n\x0b\x0c\r") for part in texts[r.doc_id].split("\n")) if line]
        assert r.n_lines == len(found) == r.n_kept + len(r.dropped_lines or [])
        dropped = []
        for (i, name), class_ in zip(found, r.class_ids or []):
            if name in seen:
                dropped.append(i)
            assert seen.setdefault(name, class_) == class_
        assert (r.dropped_lines or []) == dropped
    assert len(set(seen.values())) == len(seen)


def test_shingles_of_spans_in_any_order():
    draw = random.Random(1)
    for _ in range(200):
        lines = ["".join(draw.choice("abé漢😀") for _ in range(draw.randrange(1, 20))) for _ in range(draw.randrange(1, 6))]
        data = np.frombuffer("|".join(lines).encode(), np.uint8)
        ends = np.cumsum([len(x.encode()) + 1 for x in lines]) - 1
        starts = ends - [len(x.encode()) for x in lines]
        chars, order = draw.choice([1, 2, 3, 5, 8]), np.array(draw.sample(range(len(lines)), len(lines)))
        hashes, line = line_dedup._shingles(data, starts[order], ends[order], chars)
        got = [set(hashes[line == i].tolist()) for i in range(len(lines))]
        expected = [{x[i : i + chars] for i in range(len(x) - chars + 1)} or {x} for x in (lines[k] for k in order)]
        assert [len(g) for g in got] == [len(e) for e in expected]
        assert [len(a & b) for a in got for b in got] == [len(a & b) for a in expected for b in expected]


def test_line_recall_against_brute_force(spark):
    draw = random.Random(2)
    lines = []
    for _ in range(60):
        base = words(draw, 40)
        lines.append(" ".join(base))
        copy = list(base)
        copy[draw.randrange(40)] = draw.choice(VOCABULARY)
        lines.append(" ".join(copy))
    shingles = [{line[i : i + 8] for i in range(len(line) - 7)} for line in lines]
    pairs = [
        (i, j) for i in range(len(lines)) for j in range(i) if len(shingles[i] & shingles[j]) >= 0.8 * len(shingles[i] | shingles[j])
    ]
    found = {r.doc_id: r.class_id for r in line_classes(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")).collect()}
    assert pairs and sum(found[i] == found[j] for i, j in pairs) >= 0.97 * len(pairs)


def test_mix_meets_its_targets(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.mix(documents).collect()
    sizes, taken, target = Counter(), Counter(), {}
    for r in rows:
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken <= 2 * r["size"]
    left, weight = 1.5 * sum(sizes.values()), {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(sizes))}
    full: dict[str, float] = {}
    while True:
        open_ = {s: w for s, w in weight.items() if s not in full}
        share = (left - sum(full.values())) / sum(open_.values())
        over = {s: 2.0 * sizes[s] for s, w in open_.items() if share * w > 2 * sizes[s]}
        if not over:
            break
        full |= over
    for s in sizes:
        assert target[s] == pytest.approx(full.get(s, share * weight[s]))
        assert taken[s] == pytest.approx(target[s], rel=0.1)
    assert sorted(rows) == sorted(mixing.mix(documents.repartition(5)).collect())


def test_mix_matches_its_sql(spark, awkward, tmp_path):
    """Documents of the sample, and NULL ids, sources and texts; a repeated doc_id must be equal in text for the SQL."""
    import duckdb

    from basketry.llm.oracle import llm_oracles
    from basketry.llm.queries import llm_queries

    awkward.coalesce(1).write.parquet(f"{tmp_path}/odd/documents.parquet")
    for folder in (SMALL, f"{tmp_path}/odd"):
        got = llm_queries()["op2_mix_sources"](spark, folder)
        with duckdb.connect() as connection:
            files = f"{folder}/documents.parquet" + ("" if folder == SMALL else "/*.parquet")
            connection.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{files}')")
            expected = connection.sql(f"SELECT {', '.join(got.columns)} FROM ({llm_oracles()['op2_mix_sources']})").fetchall()
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)


def test_mixed_rows_are_whole(awkward):
    mixed = mixing.mixed_documents(awkward)
    assert mixed.columns == awkward.columns
    rows = {tuple(r) for r in awkward.collect()}
    assert all(tuple(r) in rows for r in mixed.collect())
    counts = {r.doc_id: r.copies for r in mixing.mix(awkward.dropDuplicates()).collect()}
    alone = Counter(r.doc_id for r in mixing.mixed_documents(awkward.dropDuplicates()).collect())
    assert {i: n for i, n in counts.items() if n} == alone


def vectors(n: int, d: int) -> np.ndarray:
    return np.random.default_rng(1).normal(size=(n, d))


@pytest.mark.parametrize("d", [5, 64, 96])
def test_nearest_recall(spark, d):
    x = vectors(600, d)
    x[500:520] = x[0]
    rows = [(i, [float(v) for v in row], "extra") for i, row in enumerate(x)]
    rows += [(1000, None, ""), (1001, [0.0] * d, ""), (1002, [float("nan")] * d, ""), (1003, [None] * d, ""), (1004, [1.0], ""), (None, rows[0][1], "")]
    found = nearest.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string"), F.col("vec_id") % 100 == 0)
    by: dict[int, list] = {}
    for r in sorted(found.collect()):
        by.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert sorted(by) == [0, 100, 200, 300, 400, 500]
    hit = 0
    for q, got in by.items():
        distance = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((np.arange(600), distance)) if i != q][:10]
        assert len(got) == 10 and all(s == pytest.approx(distance[v]) for v, s in got)
        hit += len(set(order) & {v for v, _ in got})
        if q == 0:
            assert [v for v, _ in got] == list(range(500, 510))
    assert hit >= 0.9 * 60


@pytest.mark.parametrize("sample", [8000, 50, 0])
def test_nearest_with_any_sample_and_block(spark, monkeypatch, sample):
    """Ties between different vectors, repeated ids, a hot vector in several blocks; the bound loses nothing."""
    monkeypatch.setattr(nearest, "SAMPLE_ROWS", sample)
    monkeypatch.setattr(nearest, "BLOCK_ROWS", 20)
    x = np.round(vectors(240, 6), 1)
    x[x.any(axis=1) == 0] = 1.0
    x[60:150] = x[0]
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)] + [(7, [float(v) for v in x[3]]), (7, [float(v) for v in x[7]])]
    got: dict[int, list] = {}
    for r in sorted(nearest.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 100 == 0).collect()):
        got.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 9)))
    hit = 0
    for q in (0, 100, 200):
        all_ = sorted({(round(float(np.sqrt(((np.array(v) - x[q]) ** 2).sum())), 9), i) for i, v in rows if i != q})
        wanted = [(i, d) for d, i in all_[:10]]
        assert len(got[q]) == 10 and [d for _, d in got[q]] == sorted(d for _, d in got[q])
        hit += len(set(wanted) & set(got[q]))
    assert hit >= 27 and got[0] == [(i, 0.0) for i in range(60, 70)]


def test_nearest_with_few_rows(spark):
    table = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 3.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in nearest.search(table, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 1.0)]
    assert nearest.search(table.where("false"), F.col("vec_id") == 0).collect() == []


def test_quality_on_held_out_rows(spark, awkward, nothing):
    draw = random.Random(3)
    good = [" ".join(words(draw, 80)) for _ in range(150)]
    poor = [" ".join(w.upper() + "!!" for w in words(draw, 80)) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(good + poor)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 150), "x") for i, _ in rows if i % 4], "doc_id long, quality int, text string")
    model = quality.train(documents, labels.select("doc_id", "quality"))
    scores = dict(quality.score(documents, model).collect())
    held = [i for i, _ in rows if i % 4 == 0]
    assert sum((scores[i] >= 0.7) == (i < 150) for i in held) >= 0.95 * len(held)
    odd = quality.score(awkward, model, carry=["doc_id", "row"]).collect()
    assert len(odd) == awkward.count() and all(0 <= r.score <= 1 for r in odd)
    assert quality.score(nothing, model).collect() == []
    assert quality.train(nothing, labels.select("doc_id", "quality")).prior == 0


def test_quality_network_sees_whole_texts():
    model = quality.fit([("good text " * 60, 1), ("BAD!! " * 90, 0)] * 8, epochs=8)
    data = [b"good text " * 500, b"good text " * 400 + b"BAD!! " * 60]
    padded, starts, length = quality._padded(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
    first, end, text = quality._segments(starts, length)
    clean, spoiled = quality._combine(model, quality._segment_maxima(model.filters, padded, first, end), text, 2)
    assert spoiled < clean


def test_languages(spark, awkward, nothing):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = language.train(documents.where(~held).select("doc_id", "text", "lang"))
    named = language.identify(documents.where(held), model, carry=["doc_id", "lang"]).collect()
    assert sum(r.lang == r.lang_pred for r in named) >= 0.98 * len(named)
    assert sum(r.rejected for r in named) <= 0.02 * len(named)
    odd = {r.doc_id: r for r in language.identify(awkward, model).collect()}
    for i, text in enumerate(awkward_texts()):
        assert (odd[i].lang_pred == "und") == (text is None or not re.search(r"[^\W\d_]", text))
    assert language.identify(nothing, model).collect() == []
    assert {r.lang_pred for r in language.identify(awkward, language.train(nothing)).collect()} == {"und"}


PAGES = [
    (
        '<html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body><header>Site</header><nav><ul><li><a href="/">'
        'Home</a></li></ul></nav><div class="ad">Buy</div><article><h1>A &amp; B</h1><p><b>Bold\n start<br>next<p>Second &copy; it.</p><p>Ok.</p>'
        '<div class="comments"><p>First!</p></div></article><aside>More</aside><footer>&copy; us</footer></body></html>',
        "A & B\n\nBold start next\n\nSecond © it.\n\nOk.",
    ),
    ("<p>" + "long text " * 30 + "</p><ul>" + "<li><a href=x>m</a></li>" * 12 + "</ul>", ("long text " * 30).strip()),
    ("<article><p>cut off &am", "cut off &am"),
    ("<form><input><button>Go</button></form>", ""),
    ("", ""),
    (None, ""),
]


def test_main_text(spark):
    pages = spark.createDataFrame([(i, f"u{i}", html, "old", "r") for i, (html, _) in enumerate(PAGES)], "page_id long, url string, html string, text string, row string")
    got = html_text.extract(pages)
    assert got.columns == ["page_id", "url", "row", "text"]
    assert {r.page_id: r.text for r in got.collect()} == {i: text for i, (_, text) in enumerate(PAGES)}


def test_edited_fingerprints(spark, awkward):
    documents = awkward.where("doc_id is not null").dropDuplicates(["doc_id"])
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    order = sorted(texts, reverse=True)
    got = {r.doc_id: r for r in syncmers.edited_likeness(documents).collect()}
    assert sorted(got) == sorted(texts)
    for i, doc in enumerate(order):
        text, after = texts[doc], texts[order[(i + 1) % len(order)]]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        assert got[doc].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[doc].n_chars == len(text)
        assert 0 <= got[doc].near_next <= 1
    assert got[7].fingerprint == got[8].fingerprint and got[0].fingerprint == ""
    assert got[21].near_edited > 0.4 > got[21].near_next
    assert syncmers.edited_likeness(documents.where("false")).collect() == []
    assert syncmers.edited_likeness(awkward).count() == awkward.count()


def test_next_document_of_repeats_edges_and_one(spark):
    def edited(rows):
        found = syncmers.edited_likeness(spark.createDataFrame(rows, "doc_id long, text string"))
        return sorted((r.doc_id is not None, r.doc_id or 0, r.n_chars, r.edited_sha256) for r in found.collect())

    def sha(*texts):
        return [hashlib.sha256(t.encode()).hexdigest() for t in texts]

    rows = [(5, "aaabbbccc"), (9, "xyz"), (9, "uvw"), (2, "one"), (2, "one"), (None, "nul")]
    one, again, five, uvw, xyz = sha("onu", "onu", "aaabbbone", "uva", "xya")
    assert edited(rows) == sorted(
        [(False, 0, 3, *sha("nu")), (True, 2, 3, one), (True, 2, 3, again), (True, 5, 9, five), (True, 9, 3, uvw), (True, 9, 3, xyz)]
    )
    assert edited([(7, "abc")]) == [(True, 7, 3, *sha("aba"))]
    many = [(i * 3, f"{i:05d}") for i in range(300)]
    wanted = [(True, i * 3, 5, *sha(f"{i:05d}"[:4] + f"{(i - 1) % 300:05d}"[:1])) for i in range(300)]
    assert edited(many) == wanted


def test_syncmers_are_context_free(spark):
    draw = random.Random(6)
    base = words(draw, 300)
    rows = spark.createDataFrame([(0, " ".join(base)), (1, " ".join(["new", *base]))], "doc_id long, text string")
    a, b = (r.anchors for r in syncmers.fingerprints(rows).orderBy("doc_id").collect())
    moved = {(x.place + 1, x.hash) for x in a}
    assert moved <= {(x.place, x.hash) for x in b}
    assert max(y.place - x.place for x, y in zip(a, a[1:])) <= syncmers.K - syncmers.S + 1


@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrstuvwxyz", "漢字仮名交文東京都市大学生活動", "ABCDEF0123456789+/é"])
def test_unspaced_texts_that_begin_differently_are_alike(spark, letters):
    draw = random.Random(8)
    base = "".join(draw.choice(letters) for _ in range(4000))
    rows = spark.createDataFrame([(0, base), (1, letters[3] + base), (2, base[700:])], "doc_id long, text string")
    marks = {r.doc_id: {a.hash for a in r.anchors} for r in syncmers.fingerprints(rows).collect()}
    assert len(marks[0]) > 100
    assert len(marks[0] & marks[1]) >= 0.95 * len(marks[0] | marks[1])
    assert len(marks[0] & marks[2]) >= 0.95 * len(marks[2])


def pieces_of(text: str) -> list[str]:
    """Words, and pieces of words longer than the limit, each ending with an end character."""
    ends = re.compile("[aeiouyAEIOUY02468\u0100-\U0010ffff]")
    out = []
    for word in re.findall(r"[^\x20\x09-\x0D]+", text or ""):
        piece = word if len(word) <= syncmers.PIECE else ""
        for c in word if not piece else "":
            piece += c
            if ends.match(c):
                out.append(piece)
                piece = ""
        out += [piece] if piece else []
    return out


def test_syncmers_against_brute_force(spark, awkward):
    """Anchors, places and likenesses from plain lists; only the hashes themselves are Spark's."""
    documents = awkward.where("doc_id is not null and (text is null or length(text) < 20000)").dropDuplicates(["doc_id"])
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    texts[50] = "x" * 30 + "unspacedwordsthatgoonandonwithoutanyend" * 3 + " " + " ".join(VOCABULARY[:9])
    documents = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    order = sorted(texts, reverse=True)
    after = {doc: texts[order[(i + 1) % len(order)]] for i, doc in enumerate(order)}
    edited = {d: t[: len(t) - len(t) // 3] + after[d][: len(t) // 3] for d, t in texts.items()}
    parts = {t: pieces_of(t) for t in {*texts.values(), *edited.values()}}
    vocabulary = sorted({w for p in parts.values() for w in p})
    of_word = {r.w: r.h for r in spark.createDataFrame([(w,) for w in vocabulary], "w string").select("w", F.xxhash64("w").alias("h")).collect()}
    pairs = {(of_word[a], of_word[b]) for p in parts.values() for a, b in zip(p, p[1:])}
    of_pair = {(r.a, r.b): r.h for r in spark.createDataFrame(sorted(pairs), "a long, b long").select("a", "b", F.xxhash64("a", "b").alias("h")).collect()}
    k, inner = syncmers.K, syncmers.K - 1
    found = {}
    for text, p in parts.items():
        h = [of_word[w] for w in p]
        runs = [of_pair[x] for x in zip(h, h[1:])]
        places = [i for i in range(len(h) - k + 1) if min(runs[i : i + inner]) in (runs[i], runs[i + inner - 1])] if len(h) >= k else [0] if h else []
        found[text] = [(i, tuple(h[i : i + k])) for i in places]
    grams = sorted({g for anchors in found.values() for _, g in anchors})
    hashed = spark.createDataFrame([(list(g),) for g in grams], "g array<long>").select("g", F.hash("g").alias("h")).collect()
    of_gram = {tuple(r.g): r.h for r in hashed}
    marks = {text: [(i, of_gram[g]) for i, g in anchors] for text, anchors in found.items()}

    def printed(anchors):
        return " ".join(f"{i - before}-{h & 0xFFFFFFFF:08x}" for (i, h), before in zip(anchors, [0, *[i for i, _ in anchors]]))

    def alike(a, b):
        a, b = {h for _, h in a}, {h for _, h in b}
        return len(a & b) / len(a | b) if a | b else 1.0

    got = {r.doc_id: r for r in syncmers.edited_likeness(documents).collect()}
    assert len(got) == len(texts)
    for d, text in texts.items():
        own, changed, next_ = marks[text], marks[edited[d]], marks[after[d]]
        assert got[d].fingerprint == printed(own) and got[d].edited_fingerprint == printed(changed)
        assert got[d].near_edited == pytest.approx(alike(own, changed)) and got[d].near_next == pytest.approx(alike(own, next_))


def naive_language(model, text: str) -> tuple[str, float]:
    """One text, subword by subword."""
    bytes_ = [c + 32 if 65 <= c <= 90 else c for c in text.encode()]
    folded: list[int] = []
    for c in bytes_:
        letter = 97 <= c <= 122 or c >= 128
        if letter or (folded and folded[-1] != 32):
            folded.append(c if letter else 32)
    logits, n = np.zeros(len(model.languages)), 0
    for size in language.GRAMS:
        for i in range(len(folded) - size + 1):
            gram = folded[i : i + size]
            if 32 not in gram[1:-1]:
                key = size
                for c in gram:
                    key = (key * 0x100000001B3 + c) % 2**64
                bucket = int(utf8.mix(np.array([key], np.uint64))[0]) % language.BUCKETS
                logits += model.table[bucket]
                n += 1
    chance = np.exp(logits / max(n, 1) + model.bias)
    chance /= chance.sum()
    return model.languages[int(chance.argmax())], float(chance.max())


def test_languages_against_a_naive_scorer(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = language.train(documents.select("doc_id", "text", "lang"))
    texts = [r.text[:400] for r in documents.limit(40).collect() if r.text] + [" leading", "ab", "x", " 1 é", "“Quoted” text", "A\n\nB  c"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    for r in language.identify(frame, model).collect():
        name, score = naive_language(model, texts[r.doc_id])
        if r.score:
            assert r.lang_pred == name and r.score == pytest.approx(score, abs=1e-4)


def test_quality_against_a_naive_scorer(spark):
    model = quality.fit([("good text " * 60, 1), ("BAD!! " * 90, 0), ("more of it " * 200, 1)] * 6, epochs=3)
    texts = ["", "a", "good text " * 12 + "é", "x" * 127, "y" * 128, "BAD!! " * 60, "z" * 700 + " good text"]

    def naive(text: str) -> float:
        data = list(text.encode()) or [0]
        padded = data + [0] * quality.WIDTH
        answers = np.array([sum(model.filters[k][padded[i + k]] for k in range(quality.WIDTH)) for i in range(len(data))])
        segments = [answers[i : i + quality.SEGMENT].max(axis=0) for i in range(0, len(data), quality.SEGMENT)]
        chunks = [np.maximum(a, b) for a, b in zip(segments, segments[1:])] or segments
        scores = [np.maximum(c + model.bias, 0) @ model.layer + model.chunk_bias for c in chunks]
        logit = model.mean_weight * np.mean(scores) + model.worst_weight * min(scores) + model.offset + model.prior
        return 1 / (1 + np.exp(-logit))

    got = dict(quality.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect())
    assert [got[i] for i in range(len(texts))] == pytest.approx([naive(t) for t in texts], abs=1e-4)


def test_rare_languages_are_learned_and_samples_bounded(spark, monkeypatch):
    """A language of few rows next to a frequent one; what is drawn does not grow with the rows."""
    draw = random.Random(4)
    rows = [(i, " ".join(words(draw, 30)), "w") for i in range(3000)]
    rows += [(5000 + i, " ".join(f"zz{draw.choice('äöü')}q" for _ in range(30)), "z") for i in range(12)] + [rows[0]] * 50
    monkeypatch.setattr(language, "SAMPLE_ROWS", 200)
    seen = []
    fit = language.fit
    monkeypatch.setattr(language, "fit", lambda samples: seen.append(len(samples)) or fit(samples))
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["w", "z"] and 70 <= seen[0] <= 190
    named = language.identify(spark.createDataFrame([(1, "zzäq zzöq"), (2, rows[7][1])], "doc_id long, text string"), model)
    assert {r.doc_id: r.lang_pred for r in named.collect()} == {1: "z", 2: "w"}


def test_licences(spark):
    rows = [
        ("a/LICENSE", "Released under the MIT License."), ("a/b/c/code", "int main;"), ("a/b/own", "x\nLicensed under the Apache License, Version 2.0.\ny"),
        ("z/code", "Licensed to no one in particular."), (None, "plain"), ("a/empty", None), ("a/b/LICENSE", "All rights reserved."),
    ]
    files = spark.createDataFrame([(i, *r, 0) for i, r in enumerate(rows)], "doc_id long, path string, text string, line int")
    got = {r.doc_id: (r.licence, r.origin, r.line, r.licence_file) for r in licences.scan(files, carry=["doc_id"]).collect()}
    assert got == {
        0: ("MIT", "own", 0, None), 1: ("proprietary", "inherited", None, "a/b/LICENSE"), 2: ("Apache-2.0", "own", 1, None), 3: (None, None, None, None),
        4: (None, None, None, None), 5: ("MIT", "inherited", None, "a/LICENSE"), 6: ("proprietary", "own", 0, None),
    }
    assert licences.scan(files.where("false"), carry=["doc_id"]).collect() == []


def brute_licences(files: list[tuple], threshold: float, templates) -> list[tuple]:
    """Own licence and line of every (path, text), by TF-IDF cosine of every line and text to every template."""
    split = lambda text: re.findall(licences.TERM, (text or "").lower())
    held = Counter(w for _, text in files for w in set(split(text)))

    def vector(words):
        weights = {w: n * (np.log((1 + len(files)) / (1 + held[w])) + 1) for w, n in Counter(words).items()}
        norm = np.sqrt(sum(x * x for x in weights.values()))
        return {w: x / norm for w, x in weights.items()}

    known = [(name, vector(split(text))) for name, text in templates]

    def best(text):
        of = vector(split(text)) if split(text) else {}
        return max((round(float(sum(x * of.get(w, 0.0) for w, x in v.items())), 9), name) for name, v in known)

    out = []
    for path, text in files:
        found = [(*best(line), -i, i) for i, line in enumerate((text or "").split("\n"))]
        found = [(score, up, name, i) for score, name, up, i in found if score >= threshold]
        score, name = best(text)
        whole = [(score, 0, name, None)] if score >= threshold else []
        top = max(found + whole, key=lambda f: (f[0], f[1], f[2], f[3] is not None), default=None)
        out.append((path, top[2], round(top[0], 6), top[3]) if top else (path, None, None, None))
    return out


def test_licences_are_tf_idf_cosines(spark):
    draw = random.Random(6)
    base = [t for _, t in licences.TEMPLATES]
    lines = [t.replace("\n", " ") for t in base] + ["Copyright 2020 Example. This file is licensed under the Apache License, Version 2.0."]
    say = lambda n: " ".join(draw.choice(["the", "of", "licence", "rights", "x1", "ß", "foo", "software"]) for _ in range(n))
    files = [(f"p{i}/f{i}", "\n".join(draw.choice([say(12), say(3), draw.choice(lines), ""]) for _ in range(draw.randrange(6)))) for i in range(120)]
    files += [(f"q{i}/LICENCE", text) for i, text in enumerate(base)] + [("r/a", None), ("r/b", ""), ("r/c", "word " * 20_000), ("r/d", "\n \n")]
    files += [files[3], files[3], ("r/e", lines[-1]), ("r/f", f"{lines[0]}\n{lines[0]}")]
    frame = spark.createDataFrame([(*f, "x", 1) for f in files], "path string, text string, unit string, files int")
    found = [(r.path, r.licence, None if r.score is None else round(r.score, 6), r.line) for r in licences.scan(frame).collect() if r.origin != "inherited"]
    expected = [r for r in brute_licences(files, 0.6, licences.TEMPLATES)]
    inherited = Counter((r.path, None, None, None) for r in licences.scan(frame).collect() if r.origin == "inherited")
    assert Counter(map(repr, found)) == Counter(map(repr, expected)) - Counter({repr(k): n for k, n in inherited.items()})
    names = {r[0]: r[1] for r in found}
    assert names["r/e"] == "Apache-2.0"
    assert all(names[f"q{i}/LICENCE"] == name for i, (name, _) in enumerate(licences.TEMPLATES))


def test_pieces_agree_with_sentencepiece(spark, awkward):
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = [t or "" for t in awkward_texts()] + ["  Hello   world\n foo\tbar ", "<s> </s> <0x41>", "▁▁ x ▁"]
    ours = pieces.build_tokenizer(open(MODEL, "rb").read())
    ids = [e.ids if t else [] for t, e in zip(texts, ours.encode_batch_fast(texts, add_special_tokens=False))]
    assert ids == processor.encode(texts)
    assert [ours.decode(i, skip_special_tokens=False) for i in ids] == processor.decode(ids)
    encoded = pieces.encode(awkward, MODEL, carry=["doc_id", "row"]).collect()
    assert len(encoded) == awkward.count() and all(r.round_trip and r.decoded is not None for r in encoded)


def test_rebuilt_unigram_model(tmp_path):
    """A unigram model file, written field by field, with a normaliser that squeezes spaces."""

    def field(number: int, kind: int, value) -> bytes:
        if kind == 0:
            return bytes([number << 3]) + bytes([value])
        return bytes([number << 3 | kind]) + (bytes([len(value)]) + value if kind == 2 else value)

    def piece(text: str, score: float, kind: int = 1) -> bytes:
        import struct

        return field(1, 2, field(1, 2, text.encode()) + field(2, 5, struct.pack("<f", score)) + field(3, 0, kind))

    content = b"".join([piece("<unk>", 0, 2), piece("▁a", -1.0), piece("▁ab", -1.5), piece("b", -2.0), piece("▁", -3.0), piece("a", -2.5)])
    content += field(2, 2, field(3, 0, 1)) + field(3, 2, field(3, 0, 1) + field(4, 0, 1) + field(5, 0, 1))
    tokenizer = pieces.build_tokenizer(content)
    assert tokenizer.encode(" ab   a ").ids == [2, 1]
    import sentencepiece

    assert sentencepiece.SentencePieceProcessor(model_proto=content).encode(" ab   a ") == [2, 1]


def test_pipeline_stages(spark, awkward, tmp_path):
    import corpus_pipeline

    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == documents.columns
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert last.count() == docs.count() and last.where("not round_trip").count() == 0
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, awkward.select(*documents.columns), SMALL).collect()
        stage(spark, documents.where("false"), SMALL).collect()
