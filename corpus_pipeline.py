"""Corpus pipeline: quality rules, exact and near duplicates, mixing, tokenisation.

``STAGES`` lists the stages in order.  Each takes (spark, docs, sf_dir) and
returns a frame that is written as Parquet and read again as the next stage's
docs.  All but the last return the columns of ``documents``; the last returns
one row per document that is left, with its encoding read back.

Nulls, empty and very long texts, ties, repeated rows, empty tables and extra
columns are handled as the operators' docstrings state: a document without
words fails the quality rules, one of equal (or near) texts stays, ties go to
the smallest id, and an empty table passes through as an empty table.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from credit_signals.llm import exact_dedup, mixing, quality_rules, sentencepiece_codec, simhash
from credit_signals.llm.common import materialise
from credit_signals.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the longest original, then the smallest id."""
    return exact_dedup.drop_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the smallest id."""
    return simhash.drop_near_duplicates(docs, shingle=3, max_bits=2)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to tempered source, language and topic shares."""
    return mixing.sample(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document that is left."""
    return sentencepiece_codec.round_trip(docs, tokenizer_path("piece_bpe_32k.model"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality), ("exact_dedup", exact), ("simhash_near_dedup", near), ("source_mixing", mixture),
    ("sentencepiece", tokens)]

# SentencePiece encoding, XXH64 and the raking rounds have no SQL form; tests/llm holds a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each stage returns is written below the shared folder first."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
