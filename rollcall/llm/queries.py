"""The operators applied to whole test tables, with production parameters."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rollcall.llm import (
    filter_audit, lexical_search, lines, mixing, near_text, near_vectors, packing, secret_scan, sharding, substrings, token_files, top_scores, toxicity,
)
from rollcall.storage import shared_folder

TOKENIZER = "word_bpe_49k.json"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.op1_sharding(documents(spark, sf_dir))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_text.op2_minhash_near_dedup(documents(spark, sf_dir))


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.op3_embedding_near_dedup(embeddings(spark, sf_dir))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/rollcall/{uuid.uuid4().hex}/token_files"
    return token_files.op4_token_files(documents(spark, sf_dir), path, public_tokenizers.path(TOKENIZER))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op5_mixing(documents(spark, sf_dir), labels(spark, sf_dir))


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_scores.op6_exact_top_k(embeddings(spark, sf_dir))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.op7_substring_dedup(documents(spark, sf_dir))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.op8_toxicity(documents(spark, sf_dir), labels(spark, sf_dir))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.op9_line_dedup(documents(spark, sf_dir))


def packed(docs: DataFrame, kept_words: int | None = None) -> DataFrame:
    return packing.op10_best_fit_packing(docs, public_tokenizers.path(TOKENIZER), kept_words=kept_words)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir))


def op11_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.op11_secret_scans(documents(spark, sf_dir))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.op12_lexical_search(documents(spark, sf_dir), benchmark(spark, sf_dir))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.op13_filter_audit(documents(spark, sf_dir), labels(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        op1_sharding, op2_minhash_near_dedup, op3_embedding_near_dedup, op4_token_files, op5_mixing, op6_exact_top_k,
        op7_substring_dedup, op8_toxicity, op9_line_dedup, op10_best_fit_packing, op11_secret_scans, op12_lexical_search,
        op13_filter_audit,
    )
}
