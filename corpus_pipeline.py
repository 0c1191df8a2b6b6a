"""Cleaning of a document corpus in five stages, each over all that its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes it as Parquet to the shared scratch
folder and hands what it reads back to the next one. All stages but the last keep the columns of
documents. Working tables of a stage are deleted when the next one begins, unless its documents are read from them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm import decontamination, exact_dedup, language, pieces, simhash
from aerolith.llm.common import drop_unread, noting, stored

# The language models and the piece encoder have no SQL form; tests compare with a plain version.
ORACLE_SQL = None

_working: list[str] = []  # folders of the stages before


def _tidy(stage: Callable) -> Callable:
    @wraps(stage)
    def tidied(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_unread(_working, docs)
        with noting(_working):
            return stage(spark, docs, sf_dir)

    return tidied


@_tidy
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    return language.known_language(docs)


@_tidy
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return exact_dedup.without_copies(docs)


@_tidy
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints link: the smallest id."""
    return simhash.without_near_copies(docs)


@_tidy
def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_tidy
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with token count and hashes of token ids and decoded text, which must be the text."""
    coded = pieces.with_digests(docs)
    return coded.select(
        "doc.doc_id",
        "doc.lang",
        "doc.source",
        F.col("digest.n_tokens").alias("n_tokens"),
        F.col("digest.ids_sha256").alias("ids_sha256"),
        F.col("digest.decoded_sha256").alias("decoded_sha256"),
    )


STAGES = [
    ("language", identify_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("pieces", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        made: list[str] = []
        result = stage(spark, docs, sf_dir)
        with noting(made):
            docs = stored(result, name)
        drop_unread(_working, docs)
        _working.extend(made if name != STAGES[-1][0] else [])  # goes once the next stage is written
    return docs
