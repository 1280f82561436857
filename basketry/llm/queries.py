"""The corpus operators as queries over the sample tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import benchmark_leaks, html_text, language, licences, nearest, periodic, pieces, quality, spellings, syncmers
from basketry.llm.line_dedup import line_report
from basketry.llm.mixing import mix
from basketry.llm.shingle_join import near_documents


PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_report(_table(spark, folder, "documents").select("doc_id", "text"))


def op2_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mix(_table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op3_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return nearest.search(_table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    labels = _table(spark, folder, "labels").where(~_held_out(4, 2)).select("doc_id", "quality")
    scores = quality.score(documents, quality.train(documents, labels))
    return scores.select(
        "doc_id", _held_out(4, 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op5_html_text(spark: SparkSession, folder: str) -> DataFrame:
    texts = html_text.extract(_table(spark, folder, "pages").select("page_id", "url", "html"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def op6_syncmers(spark: SparkSession, folder: str) -> DataFrame:
    return syncmers.edited_likeness(_table(spark, folder, "documents").select("doc_id", "text"))


def op7_licences(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as files ``source/lang/doc_id``."""
    documents = _table(spark, folder, "documents")
    return licences.scan(documents.withColumn("path", F.concat_ws("/", "source", "lang", "doc_id")), carry=["doc_id"])


def op8_pieces(spark: SparkSession, folder: str) -> DataFrame:
    encoded = pieces.encode(_table(spark, folder, "documents").select("doc_id", "text"), PIECE_MODEL)
    return encoded.select("doc_id", "piece_ids", "n_pieces", "round_trip")


def op9_shingle_join(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    return near_documents(documents, words_per_shingle=3, threshold="0.9")


def _held_out(of: int, remainder: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % of == remainder


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    model = language.train(documents.where(~_held_out(5, 0)).select("doc_id", "text", "lang"))
    named = language.identify(documents, model)
    return named.select("doc_id", _held_out(5, 0).alias("held_out"), "lang_pred", "score", "rejected")


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    documents = periodic.with_planted_repeats(_table(spark, folder, "documents"))
    return periodic.run_digest(periodic.collapse_runs(documents))


def op12_benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    documents, items = _table(spark, folder, "documents"), _table(spark, folder, "benchmark")
    return benchmark_leaks.leak_digest(benchmark_leaks.match_items(documents, items))


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    words = spellings.vocabulary(_table(spark, folder, "documents"), edit_every=199)
    return spellings.spelling_groups(words).select("word", "form", "root", "n", "n_near", "form_n")


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_line_dedup": op1_line_dedup,
        "op2_mix_sources": op2_mix_sources,
        "op3_nearest": op3_nearest,
        "op4_quality": op4_quality,
        "op5_html_text": op5_html_text,
        "op6_syncmers": op6_syncmers,
        "op7_licences": op7_licences,
        "op8_pieces": op8_pieces,
        "op9_shingle_join": op9_shingle_join,
        "op10_language_id": op10_language_id,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_benchmark_leaks": op12_benchmark_leaks,
        "op13_spelling_variants": op13_spelling_variants,
    }
