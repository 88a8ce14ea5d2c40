"""The stages of the corpus pipeline: each takes documents and gives those that stay.

A stage reads all documents of its predecessor and returns them with the columns they came with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pitchside.llm import decontaminate, mixing, near_dups, outliers
from pitchside.llm.common import stored
from pitchside.llm.queries import table, token_ids

#: Five words and a similarity of 0.8. So many of 64 coordinates agree in all but one of 830,000 such pairs.
ALIKE = near_dups.Likeness(percent=80, matches=35)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or lie too far from their language and source go."""
    rows = docs.withColumn("_row", F.struct("*"))
    return outliers.with_verdicts(rows, carry=["_row"]).where("kept").select("_row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document with the least id stays."""
    verdicts = near_dups.near_duplicates(docs.select("doc_id", "text"), like=ALIKE)
    # Stored, so Spark knows the size of the ids and broadcasts them only below its threshold.
    gone = stored(verdicts.where(~F.col("kept")).select("doc_id").distinct(), "gone")
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark text go."""
    found = decontaminate.with_items(docs, table(spark, sf_dir, "benchmark"), name="_items")
    return found.where(F.size("_items") == 0).drop("_items")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample by the probabilities that bring sources, languages and topics to their targets."""
    rows = docs.withColumn("_row", F.struct("*"))
    return mixing.with_sample(rows, carry=["_row"]).where("kept").select("_row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token store of what is left, reported from its files."""
    return token_ids(spark, docs)
