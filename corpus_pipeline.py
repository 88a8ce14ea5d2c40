"""The corpus pipeline: documents to a mixed, clean token store, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pitchside.llm import stages
from pitchside.llm.common import drop_path, scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality rules", stages.quality),
    ("near-duplicates", stages.near_duplicates),
    ("benchmark decontamination", stages.decontaminated),
    ("mixing", stages.mixed),
    ("token store", stages.tokens),
]

#: SQL has no MinHash join, alignment or token store; the tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written before the next begins."""
    docs, held = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if held:
            drop_path(spark, held)
        held = path
    return docs
