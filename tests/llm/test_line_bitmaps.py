"""Which candidate lines are verified: no similar pair is passed over, few others are left."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from basketry.llm import line_dedup
from basketry.llm.line_dedup import line_classes


def _shingles(line: str) -> set[str]:
    return {line[i : i + 8] for i in range(max(len(line) - 7, 1))}


def _edited(line: str, edits: int, draw: random.Random) -> str:
    for _ in range(edits):
        at = draw.randrange(len(line))
        line = line[:at] + draw.choice(["", "xy", "q"]) + line[at + draw.randrange(3) :]
    return line


def _jaccard(a: str, b: str) -> float:
    a, b = _shingles(a), _shingles(b)
    return len(a & b) / len(a | b)


def test_bitmaps_pass_all_similar_pairs_and_few_others(spark):
    draw = random.Random(5)
    lines = ["a", "ab", "a longer line"]
    for size in (30, 64, 72, 130, 500, 515, 1030):
        base = "".join(draw.choice("abcdefghij klmnop") for _ in range(size))
        lines += [base, *(_edited(base, draw.randrange(1, 3 + size // 40), draw) for _ in range(24))]
    lines = sorted(set(lines))
    rows = spark.createDataFrame([(i, line.encode()) for i, line in enumerate(lines)], "id long, value binary")
    described = rows.mapInArrow(line_dedup._described(8), line_dedup.DESCRIBED)
    possible = line_dedup._may_reach(0.8)(lambda c: F.col(f"l.{c}"), lambda c: F.col(f"r.{c}"))
    pairs = described.alias("l").join(described.alias("r"), F.col("l.id") < F.col("r.id"))
    passed = {(r[0], r[1]) for r in pairs.where(possible).select("l.id", "r.id").collect()}
    likeness = {(i, j): _jaccard(lines[i], lines[j]) for j in range(len(lines)) for i in range(j)}
    similar = {pair for pair, x in likeness.items() if x >= 0.8}
    assert len(similar) > 100 and similar <= passed
    unlike = {pair for pair, x in likeness.items() if 0.6 <= x < 0.7}
    assert len(unlike) > 300 and len(unlike & passed) < 0.1 * len(unlike)
    assert {r.id: r.n for r in described.collect()} == {i: len(_shingles(line)) for i, line in enumerate(lines)}


def test_many_copies_too_far_from_their_original(spark):
    """Half of a large group is too unlike to be linked: classes as brute force finds them, each pair that links is met."""
    draw = random.Random(8)
    base = "".join(draw.choice("abcdefghij klmnop") for _ in range(300))
    lines = sorted({base, *(_edited(base, draw.choice([1, 2, 9]), draw) for _ in range(120))})
    group = list(range(len(lines)))
    for i in range(len(lines)):
        for j in range(i):
            if group[i] != group[j] and _jaccard(lines[i], lines[j]) >= 0.8:
                group = [group[j] if g == group[i] else g for g in group]
    documents = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    found = {r.doc_id: r.class_id for r in line_classes(documents).collect()}
    assert 10 < len(set(group)) < 110
    assert len(set(zip(group, found.values(), strict=True))) >= len(set(group))
    # Links of one bucket at least are found: nothing is joined that brute force keeps apart, and the large class is whole.
    together: dict[int, set[int]] = {}
    for i, c in found.items():
        together.setdefault(c, set()).add(group[i])
    assert all(len(g) == 1 for g in together.values())
    large = max(set(group), key=group.count)
    assert len({found[i] for i, g in enumerate(group) if g == large}) == 1
