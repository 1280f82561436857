"""Which licence a file is under: TF-IDF cosine to templates, then the nearest licence file above it.

Every line of every file is compared with the templates, and so is each whole text, since a licence file
is little else. Words weigh by the number of files that hold them, counted over all files, those of
lines and texts like those of templates. No cosine is larger than the length of the template's vector over the words
that a text holds, so texts and lines that hold too few of every template's words are passed over; that loses nothing. Vectors are sparse: a
row per line and word, joined with the words' weights. A file without a licence of its own takes the one of the
nearest directory above it that holds a licence file. SQL functions only.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.licence_texts import TEMPLATES
from basketry.llm.storage import stored

TERM = r"[a-z0-9]+(?:\.[0-9]+)*"
SCORE_PLACES = 12  # sums in any order round to the same


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), 0)


class Weights:
    """Unit vectors of the templates (a bounded table), from counts of the files that hold their words."""

    def __init__(self, counts: dict[str, int], files: int, templates: list[tuple[str, str]], threshold: float) -> None:
        self.names = [name for name, _ in templates]
        bags = [Counter(re.findall(TERM, text.lower())) for _, text in templates]
        idf = {w: math.log((1 + files) / (1 + counts.get(w, 0))) + 1 for w in set().union(*bags)}
        self.threshold = threshold
        self.vectors = []
        for bag in bags:
            weight = {w: n * idf[w] for w, n in bag.items()}
            norm = math.sqrt(sum(x * x for x in weight.values()))
            self.vectors.append({w: x / norm for w, x in weight.items()})
        self.words = sorted(set().union(*self.vectors))

    def may_reach(self, terms: Column) -> Column:
        """Whether an array of words holds enough of some template for the threshold."""
        squares = [x for w in self.words for x in (F.lit(w), F.array(*[F.lit(v.get(w, 0.0) ** 2) for v in self.vectors]))]
        table = F.create_map(*squares)
        held = F.array_intersect(terms, F.array(*[F.lit(w) for w in self.words]))
        add = lambda total, w: F.zip_with(total, F.element_at(table, w), lambda x, y: x + y)
        none = F.array(*[F.lit(0.0)] * len(self.vectors))
        return F.aggregate(held, none, add, lambda total: F.array_max(total) >= self.threshold**2 - 1e-9)

    def of_word(self, word: Column) -> Column:
        """The weight of a word in each template; NULL if none has it."""
        entries = [x for w in self.words for x in (F.lit(w), F.array(*[F.lit(v.get(w, 0.0)) for v in self.vectors]))]
        return F.try_element_at(F.create_map(*entries), word)


def _counted(terms: DataFrame, words: DataFrame, files: int, weights: Weights, threshold: float) -> DataFrame:
    """``(unit, score, licence)`` of the units of ``terms`` (unit, word), one row per occurrence, that reach the threshold."""
    sparse = terms.groupBy("unit", "word").agg(F.count("*").alias("n")).join(words, "word")
    weight = F.col("n") * (F.log(F.lit(1.0 + files) / (1 + F.col("files"))) + 1)
    known = sparse.select("unit", weight.alias("weight"), weights.of_word(F.col("word")).alias("of"))
    products = [F.sum(F.col("weight") * F.coalesce(F.get("of", F.lit(i)), F.lit(0.0))).alias(f"p{i}") for i in range(len(weights.names))]
    sums = known.groupBy("unit").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("norm"), *products)
    each = [
        F.struct(F.round(F.col(f"p{i}") / F.col("norm"), SCORE_PLACES).alias("score"), F.lit(name).alias("licence"))
        for i, name in enumerate(weights.names)
    ]
    return sums.select("unit", F.array_max(F.array(*each)).alias("best")).where(F.col("best.score") >= threshold).select("unit", "best.*")


def scan(
    files: DataFrame, threshold: float = 0.6, carry: list[str] | None = None, templates: list[tuple[str, str]] | None = None
) -> DataFrame:
    """``(*carry, path, licence, score, line, origin, licence_file)`` of every row of ``files`` (path, text).

    ``origin`` is ``own`` if a line (number ``line``, from 0) or the whole text reaches the threshold, ``inherited``
    if the nearest licence file above does, else NULL like the rest. A licence file is one whose whole
    text reaches the threshold; of several in one directory the nearest to a template counts, ties to the
    smaller path, and it speaks for its own directory and all below. Of equally near templates the name that sorts last counts, of equally near
    lines the first. Texts that are NULL or empty have
    no licence of their own, rows with NULL path inherit none. Rows with equal texts answer alike.
    """
    carry = carry or []
    templates = templates or TEMPLATES
    columns = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)]
    rows = files.select(F.struct(F.lit(0).alias("_"), *columns).alias("row"), F.col("path").cast("string"), F.col("text").cast("string"))
    words = rows.select(F.explode(F.array_distinct(_terms(F.col("text")))).alias("word"))
    words = stored(words.groupBy("word").agg(F.count("*").alias("files")))
    n_files = rows.count()
    known = sorted({w for _, text in templates for w in re.findall(TERM, text.lower())})
    # Words of templates only.
    counts = {r.word: r.files for r in words.where(F.col("word").isin(known)).collect()}
    weights = Weights(counts, n_files, templates, threshold)

    # Of a row that holds too little neither text nor key goes on.
    told = rows.withColumn("tells", F.coalesce(weights.may_reach(_terms(F.col("text"))), F.lit(False)))
    marked = stored(
        told.select(
            "row", "path", F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("folder"),
            F.when(F.col("tells"), F.sha2(F.col("text").cast("binary"), 256)).alias("unit"),
            F.when(F.col("tells"), F.col("text")).alias("text"),
        )
    )
    texts = marked.where("unit is not null").select("unit", "text").dropDuplicates(["unit"])
    lines = texts.select(F.col("unit").alias("of"), F.posexplode(F.split("text", "\n", -1)).alias("line", "text"))
    lines = lines.where(weights.may_reach(_terms(F.col("text"))))
    lines = stored(lines.select("of", "line", "text", F.sha2(F.col("text").cast("binary"), 256).alias("unit")))
    units = texts.unionByName(lines.select("unit", "text")).dropDuplicates(["unit"])
    terms = units.select("unit", F.explode(_terms(F.col("text"))).alias("word"))
    scores = stored(_counted(terms, words, n_files, weights, threshold))

    found = F.struct("score", (-F.col("line")).alias("up"), "licence")
    by_line = lines.join(scores, "unit").groupBy("of").agg(F.max(found).alias("by_line")).withColumnRenamed("of", "unit")
    by_whole = scores.select("unit", F.struct("score", F.lit(0).alias("up"), "licence").alias("by_whole"))
    own = marked.drop("text").join(by_line.join(by_whole, "unit", "full"), "unit", "left")
    own = stored(own.withColumn("own", F.greatest("by_line", "by_whole")))

    named = own.where("by_whole is not null and path is not null")
    folders = named.groupBy("folder").agg(F.max("by_whole.score").alias("top"))
    folders = named.join(folders, "folder").where(F.col("by_whole.score") == F.col("top")).groupBy("folder").agg(
        F.min(F.struct(F.col("path").alias("licence_file"), F.col("by_whole.licence").alias("licence"), F.col("by_whole.score").alias("score"))).alias("given")
    )
    # Each folder in use looks up its ancestors; folders are far fewer than files.
    used = own.where("path is not null").select("folder").distinct()
    steps = F.split("folder", "/")
    above = used.select("folder", F.posexplode(F.transform(F.sequence(F.lit(1), F.size(steps)), lambda n: F.array_join(F.slice(steps, 1, n), "/"))).alias("depth", "above"))
    above = above.unionByName(used.select("folder", F.lit(-1).alias("depth"), F.lit("").alias("above")).where("folder <> ''"))
    nearest = (
        above.join(folders.withColumnRenamed("folder", "above"), "above")
        .groupBy("folder").agg(F.max(F.struct("depth", "given")).alias("nearest"))
        .select("folder", F.col("nearest.given").alias("given"))
    )
    answer = own.join(nearest, "folder", "left")
    inherits = F.col("own").isNull() & F.col("given").isNotNull() & F.col("path").isNotNull()
    return answer.select(
        *[F.col(f"row.c{i}").alias(c) for i, c in enumerate(carry)],
        "path",
        F.coalesce("own.licence", F.when(inherits, F.col("given.licence"))).alias("licence"),
        F.coalesce("own.score", F.when(inherits, F.col("given.score"))).alias("score"),
        F.when(F.col("own") == F.col("by_line"), -F.col("own.up")).alias("line"),
        F.when(F.col("own").isNotNull(), "own").when(inherits, "inherited").alias("origin"),
        F.when(inherits, F.col("given.licence_file")).alias("licence_file"),
    )
