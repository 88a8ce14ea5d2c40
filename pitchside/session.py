"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """Session for tests and the bench. On a cluster, use the session the cluster gives."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("pitchside")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own: executors on other
    machines could not read back what was written to a local disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pitchside-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch folder."""
    return os.path.join(scratch_root(spark), f"{label}-{uuid.uuid4().hex}")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the scratch folder and return a scan of it.

    Cuts the lineage in a way that survives lost executors, fixes the values of partition-dependent
    expressions, and gives the planner exact sizes for its broadcast decision.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, label: str, key: str) -> DataFrame:
    """``stored`` in buckets of ``key``, as many as there are shuffle partitions.

    Joins and groupings by ``key`` read such tables without a shuffle. Rows that come dealt by ``key`` are
    written as they are; all rows of a key lie in one bucket.
    """
    return appended_by([df], label, key)


def appended_by(loads: Sequence[DataFrame], label: str, key: str) -> DataFrame:
    """``stored_by`` of several loads of the same columns, appended one after the other."""
    spark = loads[0].sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name, path = f"{label}_{uuid.uuid4().hex}", scratch_path(spark, label)
    for load in loads:
        (
            load.repartition(buckets, key).write.mode("append").format("parquet")
            .bucketBy(buckets, key).option("path", path).saveAsTable(name)
        )
    return spark.table(name)
