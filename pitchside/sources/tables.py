"""Stored tables and file manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Layer -> database (fixed values). A layer that is not listed keeps its own name.
LAYERS = {
    "raw": "raw",
    "staging": "staging",
    "dimensions": "marts",
    "facts": "marts",
    "marts": "marts",
}


def table_name(layer: str, name: str, databases: dict[str, str] = LAYERS) -> str:
    return f"{databases.get(layer, layer).strip()}.{name}"


def read_table(spark: SparkSession, layer: str, name: str) -> DataFrame:
    return spark.table(table_name(layer, name))


def parquet_tables(spark: SparkSession, folder: str, *names: str) -> dict[str, DataFrame]:
    """Scans of ``folder/name.parquet``."""
    return {n: spark.read.parquet(f"{folder}/{n}.parquet") for n in names}


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """Lexicon ``(token, valence)`` from tab-separated text; columns after these are left out."""
    return spark.read.schema("token STRING, valence DOUBLE").csv(path, sep="\t", quote="")


def list_files(spark: SparkSession, folder: str, pattern: str = "*.json") -> DataFrame:
    """File names of a folder, listed by Spark without reading the files."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(folder)
    )
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file_name"))


def unseen_files(listing: DataFrame, manifest: DataFrame, name: str = "file_name") -> DataFrame:
    """Listed files that the manifest does not hold."""
    return listing.join(manifest.select(name).distinct(), name, "left_anti")
