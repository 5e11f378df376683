"""One query per operator: the operator over its whole table, with production parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from patronage.llm import (
    compression_model,
    decontaminate,
    exact_dedup,
    html_text,
    mixing,
    near_dedup,
    packing,
    quality,
    resampling,
    spelling,
    tokens,
    vector_dedup,
)
from patronage.staging import _application_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents"), width=5, percent=85)


def op2_compression_scores(spark: SparkSession, folder: str) -> DataFrame:
    return compression_model.score(table(spark, folder, "documents"), compression_model.held_out())


def op3_quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, folder, "labels"))
    return quality.score(docs, model).select(
        "doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op4_remove_repeats(spark: SparkSession, folder: str) -> DataFrame:
    rows = exact_dedup.remove_repeats(table(spark, folder, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["high"] - s["low"])
    return rows.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256"
    )


def op5_benchmark_matches(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op6_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    files = f"{_application_folder(spark)}/token-ids-{uuid.uuid4().hex}"
    tokens.write_token_ids(table(spark, folder, "documents"), files)
    return tokens.read_digests(spark, files)


def op8_main_text(spark: SparkSession, folder: str) -> DataFrame:
    texts = html_text.extract(table(spark, folder, "pages").select("page_id", "url", "html"))
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))


def op9_vector_links(spark: SparkSession, folder: str) -> DataFrame:
    return vector_dedup.vector_links(table(spark, folder, "embeddings"))


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = tokens.token_counts(table(spark, folder, "documents"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 512)


def op11_resample(spark: SparkSession, folder: str) -> DataFrame:
    rows = resampling.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"), percent=5, least_words=20, seed=42)
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


def op12_pack(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), "byte_bpe_50k.json", end_id=0, size=1024, digest=True)


def op13_spelling_forms(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_forms(table(spark, folder, "documents"), spoil=31, times=10)


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_near_duplicates, op2_compression_scores, op3_quality_scores, op4_remove_repeats, op5_benchmark_matches,
        op6_mix_sources, op7_token_ids, op8_main_text, op9_vector_links, op10_token_counts,
        op11_resample, op12_pack, op13_spelling_forms, pipeline,
    )
}
