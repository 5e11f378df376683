"""A corpus pipeline: quality, near-duplicates, benchmark passages, mixture, token ids.

Each stage takes what its predecessor kept, and its decisions take effect. Stages but the last
return the columns of `documents`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.llm import decontaminate, mixing, near_dedup, quality, tokens
from patronage.staging import _application_folder, stage

KEPT_QUALITY = 0.5


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches KEPT_QUALITY; learned from `labels` outside the held-out fold."""
    model = quality.train(docs, _table(spark, sf_dir, "labels"))
    return quality.score(docs, model, "quality_score_").where(F.col("quality_score_") >= KEPT_QUALITY).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the least doc_id."""
    return near_dedup.deduplicate(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return decontaminate.decontaminate(docs, _table(spark, sf_dir, "benchmark")).select(*docs.columns)


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture as documents: whole ones once per pass, and runs of chosen words as shorter ones."""
    return mixing.mixture(docs).select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from the files of token ids."""
    files = f"{_application_folder(spark)}/token-ids-{uuid.uuid4().hex}"
    tokens.write_token_ids(docs, files)
    return tokens.read_digests(spark, files)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixture", source_mixture),
    ("token_ids", token_ids),
]

#: The classifier and the tokenizer have no SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
