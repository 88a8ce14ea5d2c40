"""The registered queries of the operators, with the parameters of their contracts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pitchside.llm import (
    captures,
    classifier,
    decontaminate,
    language,
    manifest,
    mixing,
    near_dups,
    outliers,
    pseudonyms,
    sql,
    token_counts,
    token_store,
    toxicity,
    whitening,
)
from pitchside.llm.common import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def token_ids(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Write the token store of ``docs`` and report on it from its files."""
    folder = scratch_path(spark, "token-store")
    token_store.write_store(
        docs, folder, public_tokenizers.path("word_bpe_49k.json"), end_id=2, by_word=True
    )
    return token_store.store_report(spark, folder, 2)


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_ids(spark, table(spark, sf_dir, "documents"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_report(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


#: A key for the query alone; real ones come from a store of secrets.
QUERY_KEY = "key of the registered query"


def op5_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonyms.with_pseudonyms(docs, QUERY_KEY)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_report(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 512
    )


def op7_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return captures.archive_report(table(spark, sf_dir, "pages"), scratch_path(spark, "archive"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.with_sample(table(spark, sf_dir, "documents"), carry=["doc_id"])


def op9_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return outliers.with_verdicts(docs, carry=["doc_id"]).drop("distance")


def op10_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leak_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.quality_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest_report(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.with_components(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    return {
        "op1_token_store": op1_token_store,
        "op2_near_duplicates": op2_near_duplicates,
        "op3_language": op3_language,
        "op4_toxicity": op4_toxicity,
        "op5_pseudonyms": op5_pseudonyms,
        "op6_token_counts": op6_token_counts,
        "op7_captures": op7_captures,
        "op8_mixing": op8_mixing,
        "op9_quality_outliers": op9_quality_outliers,
        "op10_benchmark_leaks": op10_benchmark_leaks,
        "op11_quality_classifier": op11_quality_classifier,
        "op12_merkle_manifest": op12_merkle_manifest,
        "op13_whitening": op13_whitening,
    }


def oracle_sql() -> dict[str, str]:
    return sql.oracle_sql()
