"""A training-corpus pipeline: five stages, each one operator of ``basketry.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basketry.llm import language
from basketry.llm.line_dedup import dedup_lines
from basketry.llm.mixing import mixed_documents
from basketry.llm.pieces import encode
from basketry.llm.shingle_join import one_per_component

PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def name_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model rejects go; it learns from the labelled ones."""
    model = language.train(docs.select("doc_id", "text", "lang"))
    named = language.identify(docs, model, carry=docs.columns)
    return named.where("not rejected").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each near-duplicate line of the whole corpus stays once; documents left without lines go."""
    return dedup_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies stays (five-word shingles, similarity 0.8)."""
    return one_per_component(docs, words_per_shingle=5, threshold="0.8")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixed_documents(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of each document of the mix, and whether they stand for exactly its text."""
    encoded = encode(docs, PIECE_MODEL, carry=["doc_id", "lang", "source"])
    return encoded.select("doc_id", "lang", "source", "piece_ids", "n_pieces", "round_trip")


STAGES = [
    ("language ID", name_languages),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode_pieces),
]

# Components, models and tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
