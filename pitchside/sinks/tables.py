"""Stored tables: create, rebuild, append, replace by key, upsert."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import (
    Column, DataFrame, Observation, SparkSession, Window, functions as F, types as T,
)

from pitchside.operators.keyed import insert_new_keys, upsert_by_key
from pitchside.session import stored
from pitchside.sinks.redo import Redo
from pitchside.sources.tables import read_table, table_name

BUCKET = "key_bucket"


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    """Storage bucket of a key, equal in every run."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def create_if_absent(
    spark: SparkSession, layer: str, name: str, schema: T.StructType, bucketed: bool = False
) -> None:
    """Typed empty table, if there is none; ``bucketed`` adds the storage bucket as partition."""
    target = table_name(layer, name)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {target.split('.')[0]}")
    if bucketed:
        schema = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
    if not spark.catalog.tableExists(target):
        writer = spark.createDataFrame([], schema).write.format("parquet")
        if bucketed:
            writer = writer.partitionBy(BUCKET)
        writer.saveAsTable(target)


def rebuild_table(df: DataFrame, layer: str, name: str) -> DataFrame:
    """Write the whole table anew and return a scan of it.

    The rows are written as a version of their own beside the one that is read; then the table is
    pointed there. A run that ends before leaves the table as it was. The version replaced stays for
    those who still read it, and goes when the next one has been written.
    """
    spark, target = df.sparkSession, table_name(layer, name)
    database = target.split(".")[0]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    versions = f"{spark.catalog.getDatabase(database).locationUri}/{name}_versions"
    path = f"{versions}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    replaced = None
    if spark.catalog.tableExists(target):
        before = spark.table(target)
        replaced = _location(spark, target)
        if before.dtypes == df.dtypes:
            spark.sql(f"ALTER TABLE {target} SET LOCATION '{path}'")
        else:
            spark.sql(f"DROP TABLE {target}")
    if not spark.catalog.tableExists(target):
        spark.catalog.createTable(target, path=path, source="parquet")
    spark.catalog.refreshTable(target)
    _drop_versions(spark, versions, {path, replaced})
    return spark.table(target)


def _location(spark: SparkSession, target: str) -> str | None:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {target}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def _drop_versions(spark: SparkSession, versions: str, kept: set[str | None]) -> None:
    """Delete all versions of a table but those in ``kept``."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(versions)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = {path.rstrip("/").rsplit("/", 1)[-1] for path in kept if path}
    for status in store.listStatus(folder):
        if status.getPath().getName() not in names:
            store.delete(status.getPath(), True)


def append_rows(df: DataFrame, layer: str, name: str, partition: str | None = None) -> DataFrame:
    """Append to a table, which is created by the first call, partitioned if so asked."""
    target = table_name(layer, name)
    df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {target.split('.')[0]}")
    writer = df.write.mode("append").format("parquet")
    (writer.partitionBy(partition) if partition else writer).saveAsTable(target)
    return df.sparkSession.table(target)


def in_buckets_of(
    table: DataFrame, rows: DataFrame, keys: Sequence[str], buckets: int
) -> DataFrame:
    """The part of a table of so many storage buckets that can hold the keys of ``rows``."""
    wanted = _buckets(rows.select(key_bucket(keys, buckets).alias(BUCKET)))
    return table.where(F.col(BUCKET).isin(wanted))


def load_new_keys(
    incoming: DataFrame, layer: str, name: str, keys: Sequence[str]
) -> dict[str, int]:
    """Append the rows of keys the table does not hold; held rows are never updated.

    Returns how many rows were ``inserted`` and ``skipped``, counted while they were written.
    """
    existing = read_table(incoming.sparkSession, layer, name)
    counts = Observation()
    append_rows(insert_new_keys(existing, incoming, keys, counts), layer, name)
    seen = counts.get
    return {"inserted": seen["incoming"] - seen["skipped"], "skipped": seen["skipped"]}


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Inserts overwrite only the partitions they have rows for. ``insertInto`` reads this from the
    session, it does not know the writer option of the same name."""
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def load_replacing(
    incoming: DataFrame, layer: str, name: str, keys: Sequence[str], buckets: int
) -> None:
    """Replace all rows of the incoming keys; an empty input changes nothing.

    Rows of keys that the table does not hold are appended. Only the storage buckets of held keys
    are rewritten; each then holds an incoming row, so the dynamic overwrite reaches it. The
    incoming rows are laid out by bucket as they are stored, where the rebalance splits a bucket that a
    hot key has made large; only where some of their keys are held and some are not, they move again. An overwrite that a crash has cut short is finished first, and keys of an append that was cut
    short are held when it runs again.
    """
    spark = incoming.sparkSession
    target = table_name(layer, name)
    redo = _redo(spark, layer, name)

    def apply(contents: dict[str, DataFrame]) -> None:
        with _dynamic_overwrite(spark):
            contents["content"].write.mode("overwrite").insertInto(target)

    redo.finish(apply)
    incoming = incoming.withColumn(BUCKET, key_bucket(keys, buckets))
    incoming = stored(incoming.hint("rebalance", BUCKET), "incoming")
    table = read_table(spark, layer, name)
    bucketed_keys = [*keys, BUCKET]
    in_reach = table.where(F.col(BUCKET).isin(_buckets(incoming)))
    wanted = stored(incoming.select(*bucketed_keys).distinct(), "wanted")
    held = in_reach.select(*bucketed_keys).join(wanted, bucketed_keys, "left_semi")
    held = stored(held.distinct(), "held")
    rewritten = _buckets(held)
    all_held = held.count() == wanted.count()
    known, unknown = incoming, incoming
    if rewritten and not all_held:
        known = incoming.join(held, bucketed_keys, "left_semi").hint("rebalance", BUCKET)
        unknown = incoming.join(held, bucketed_keys, "left_anti").hint("rebalance", BUCKET)
    if rewritten:
        existing = table.where(F.col(BUCKET).isin(rewritten))
        kept = _without(existing, held, keys, len(rewritten))
        redo.run({"content": kept.unionByName(known.select(*table.columns))}, apply)
    if not all_held:
        unknown.select(*table.columns).write.mode("append").insertInto(target)


def _without(existing: DataFrame, held: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """Rows of so many storage buckets without the ``held`` keys, by one shuffle that leaves few buckets
    to a task.

    A bucket is cut into slots by its keys, so that there are as many of them as shuffle partitions.
    """
    slots = max(1, int(existing.sparkSession.conf.get("spark.sql.shuffle.partitions")) // buckets)
    slot = F.pmod(F.shiftright(F.xxhash64(*keys), 32), F.lit(slots)).alias("_slot")
    rows = existing.select("*", F.lit(False).alias("_gone"), slot).unionByName(
        held.select("*", F.lit(True).alias("_gone"), slot), allowMissingColumns=True
    )
    of_key = Window.partitionBy(BUCKET, "_slot", *keys)
    marked = rows.repartition(BUCKET, "_slot").withColumn("_gone", F.max("_gone").over(of_key))
    return marked.where(~F.col("_gone")).select(*existing.columns)


def _buckets(df: DataFrame) -> list[int]:
    """Storage buckets of the rows, at most as many as the table has."""
    return [row[0] for row in df.select(BUCKET).distinct().collect()]


def _redo(spark: SparkSession, layer: str, name: str) -> Redo:
    """Staging folder beside the table, so that it belongs to this table alone."""
    database = spark.catalog.getDatabase(table_name(layer, name).split(".")[0])
    return Redo(spark, f"{database.locationUri}/_redo_{name}")


def upsert_rows(source: DataFrame, layer: str, name: str, keys: Sequence[str]) -> None:
    """Update or insert rows of a small log table, which is rewritten as a whole."""
    spark = source.sparkSession
    redo = _redo(spark, layer, name)

    def apply(contents: dict[str, DataFrame]) -> None:
        contents["content"].write.mode("overwrite").format("parquet").saveAsTable(table_name(layer, name))

    redo.finish(apply)
    redo.run({"content": upsert_by_key(read_table(spark, layer, name), source, keys)}, apply)
