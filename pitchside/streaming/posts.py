"""Micro-batches of posts: score, land, append, keep the latest version, refresh the days.

What a batch costs follows the batch. Of each post's latest version a narrow row is held, in hash buckets
of the post's id; a batch reads and rewrites its own buckets. Texts stay in the raw table. A day's
sentiment is held as counts of its labels and scores: a version that replaces another takes the old
one's count off its day and adds its own, so no day's posts are read again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from pitchside.functions.sentiment import Rules, score_posts
from pitchside.operators.picks import latest_per_key
from pitchside.plans.marts import daily_from_counts, value_counts
from pitchside.plans.staging import POST_ORDER, post_versions
from pitchside.schemas import RAW_POSTS
from pitchside.session import stored
from pitchside.sinks.landing import land_batch, with_audit
from pitchside.sinks.redo import Redo

TRIGGER = "15 minutes"


@dataclass(frozen=True)
class PostPaths:
    """Folders of the pipeline, all on shared storage."""

    root: str
    #: Hash buckets of the latest versions. Choose so many that one is some megabytes.
    buckets: int = 64

    @property
    def landing(self) -> str:
        return f"{self.root}/landing"

    @property
    def raw(self) -> str:
        return f"{self.root}/raw_posts"

    @property
    def latest(self) -> str:
        return f"{self.root}/latest_post"

    @property
    def daily(self) -> str:
        return f"{self.root}/daily_sentiment"

    @property
    def redo(self) -> str:
        return f"{self.root}/redo"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/checkpoint"


RAW_BATCHES = T.StructType([*RAW_POSTS.fields, T.StructField("batch_id", T.LongType())])


def _posts_schema(spark: SparkSession) -> T.StructType:
    return post_versions(spark.createDataFrame([], RAW_POSTS)).schema


def _held_schema(spark: SparkSession) -> T.StructType:
    return narrow_versions(spark.createDataFrame([], _posts_schema(spark)), 1).schema


def _counts_schema(spark: SparkSession) -> T.StructType:
    return value_counts(spark.createDataFrame([], _posts_schema(spark))).schema


def _scan(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def _overwrite_partitions(df: DataFrame, path: str, column: str) -> None:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )


def read_raw_posts(spark: SparkSession, paths: PostPaths) -> DataFrame:
    """All loaded versions of all posts."""
    return _scan(spark, paths.raw, RAW_BATCHES)


def narrow_versions(versions: DataFrame, buckets: int) -> DataFrame:
    """What is held of versions: their order, day, label and score, and the bucket of their post."""
    whole = [F.col(name) for name in versions.columns if name != "loaded_at"]
    return versions.select(
        "post_id", *POST_ORDER, F.xxhash64(*whole).alias("version"), "post_date", "sentiment_label",
        "sentiment_score", F.pmod(F.xxhash64("post_id"), F.lit(buckets)).cast("int").alias("bucket"),
    )


def read_held(spark: SparkSession, paths: PostPaths) -> DataFrame:
    """The narrow rows of all latest versions."""
    return _scan(spark, paths.latest, _held_schema(spark))


def read_latest(spark: SparkSession, paths: PostPaths) -> DataFrame:
    """The latest version of each post; posts without an id count as one, as in a batch build.

    The raw versions are cut down to the held ones, whose texts are read with them.
    """
    posts = post_versions(read_raw_posts(spark, paths))
    whole = [F.col(name) for name in posts.columns if name != "loaded_at"]
    held = read_held(spark, paths).select(F.col("post_id").alias("_id"), F.col("version").alias("_version"))
    same = F.col("post_id").eqNullSafe(F.col("_id")) & (F.xxhash64(*whole) == F.col("_version"))
    # Versions that are equal but for their time of load are one.
    return latest_per_key(posts.join(held, same, "left_semi"), ["post_id"], POST_ORDER)


def read_daily(spark: SparkSession, paths: PostPaths) -> DataFrame:
    """The daily mart, from the counts of its days."""
    return daily_from_counts(_scan(spark, paths.daily, _counts_schema(spark)))


def post_models(spark: SparkSession, paths: PostPaths) -> dict[str, DataFrame]:
    """The post tables by model name, for the declared checks."""
    return {
        "raw_posts": read_raw_posts(spark, paths),
        "latest_post": read_latest(spark, paths),
        "daily_sentiment": read_daily(spark, paths),
    }


def create_post_tables(spark: SparkSession, paths: PostPaths) -> None:
    """Empty tables, where there are none, so that the first batch can read them."""
    schemas = {
        paths.raw: RAW_BATCHES,
        paths.latest: _held_schema(spark),
        paths.daily: _counts_schema(spark),
    }
    for path, schema in schemas.items():
        spark.createDataFrame([], schema).write.mode("append").parquet(path)


def _in_days(df: DataFrame, days: list) -> DataFrame:
    wanted = F.col("post_date").isin([d for d in days if d is not None])
    return df.where(wanted | F.col("post_date").isNull() if None in days else wanted)


def replaced_versions(fresh: DataFrame, held: DataFrame) -> DataFrame:
    """Rows of ``fresh`` that are newer than the post's row in ``held``, with its values as ``_old_*``."""
    old = held.select(*[F.col(name).alias(f"_old_{name}") for name in held.columns])
    same = (F.col("bucket") == F.col("_old_bucket")) & F.col("post_id").eqNullSafe(F.col("_old_post_id"))
    order = [*POST_ORDER, "version"]
    newer = F.struct(*order) > F.struct(*[F.col(f"_old_{name}").alias(name) for name in order])
    return fresh.join(old, same, "left").where(F.col("_old_bucket").isNull() | newer)


def signed_counts(moved: DataFrame) -> DataFrame:
    """What replaced versions change in the days' counts: minus the old ones, plus the new ones."""
    fields = ["post_date", "sentiment_label", "sentiment_score"]
    new = F.struct(*fields, F.lit(1).alias("sign"))
    old = F.struct(*[F.col(f"_old_{x}").alias(x) for x in fields], F.lit(-1).alias("sign"))
    both = F.when(F.col("_old_bucket").isNull(), F.array(new)).otherwise(F.array(new, old))
    rows = moved.select(F.explode(both).alias("r")).select("r.*")
    return value_counts(rows, F.col("sign")).where("posts <> 0")


def refresh_posts(spark: SparkSession, paths: PostPaths, versions: DataFrame) -> None:
    """Merge new versions into the held ones and their changes into the counts of their days.

    Only the buckets of the new versions' posts are read and overwritten, and of the counts only the
    days that change. New contents are staged as a whole before the first of them is applied, so what
    a crash cut short is finished by the next call, and the same versions again change nothing. A day
    keeps an empty row, because the overwrite leaves a partition alone that receives no row.
    """

    def apply(contents: dict[str, DataFrame]) -> None:
        _overwrite_partitions(contents["latest"], paths.latest, "bucket")
        _overwrite_partitions(contents["daily"], paths.daily, "post_date")

    redo = Redo(spark, paths.redo, ["latest", "daily"])
    redo.finish(apply)
    narrow = narrow_versions(versions, paths.buckets)
    fresh = stored(latest_per_key(narrow, ["post_id"], [*POST_ORDER, "version"]), "fresh")
    # At most as many numbers as there are buckets.
    buckets = [r["bucket"] for r in fresh.select("bucket").distinct().collect()]
    held = read_held(spark, paths).where(F.col("bucket").isin(buckets))
    moved = stored(replaced_versions(fresh, held), "moved")
    changes = stored(signed_counts(moved), "changes")
    if moved.isEmpty():
        return
    gone = moved.where("_old_bucket is not null").select(
        F.col("_old_bucket").alias("_in"), F.col("_old_post_id").alias("_id")
    )
    same = (F.col("bucket") == F.col("_in")) & F.col("post_id").eqNullSafe(F.col("_id"))
    latest = held.join(gone, same, "left_anti").unionByName(moved.select(*held.columns))
    # Calendar days: the list is as short as the calendar, however many posts there are.
    days = [r["post_date"] for r in changes.select("post_date").distinct().collect()]
    counts = _scan(spark, paths.daily, _counts_schema(spark))
    daily = value_counts(_in_days(counts, days).unionByName(changes), F.col("posts"))
    empty = spark.createDataFrame([(d, 0) for d in days], "post_date DATE, posts LONG")
    daily = daily.where("posts <> 0").unionByName(empty, allowMissingColumns=True)
    redo.run(
        {"latest": latest.hint("rebalance", "bucket"), "daily": daily.hint("rebalance", "post_date")},
        apply,
    )


def run_sentiment_stream(
    posts: DataFrame,
    paths: PostPaths,
    lexicon: DataFrame | None = None,
    rules: Rules | None = None,
    trigger: dict | None = None,
    after_batch: Callable[[SparkSession], None] | None = None,
) -> StreamingQuery:
    """Start the micro-batch pipeline on a stream of posts.

    Without ``lexicon`` the posts already carry their scores. Batches run one after the other, every
    15 minutes unless ``trigger`` says otherwise. A batch that runs again after a failure replaces its
    own raw rows and landed files, and changes nothing else that it has changed before.
    ``after_batch`` runs once all of that is done, for instance to write the run log.
    """
    spark = posts.sparkSession
    create_post_tables(spark, paths)

    def process(batch: DataFrame, batch_id: int) -> None:
        if lexicon is not None:
            batch = stored(batch, "batch")  # so that the responses are read and parsed once
        if batch.isEmpty():
            return
        scored = score_posts(batch, lexicon, rules) if lexicon is not None else batch
        load_id = f"batch-{batch_id:012d}"
        landed = f"{paths.landing}/batch={batch_id}"
        raw = with_audit(scored, load_id, landed).withColumn("batch_id", F.lit(batch_id))
        _overwrite_partitions(raw, paths.raw, "batch_id")
        # From here on the batch is read back from its partition, so scoring runs once.
        stored_batch = _scan(spark, f"{paths.raw}/batch_id={batch_id}", RAW_POSTS)
        land_batch(stored_batch.select(*scored.columns), "fetched_at", paths.landing, batch_id)
        refresh_posts(spark, paths, post_versions(stored_batch))
        if after_batch:
            after_batch(spark)

    return (
        posts.writeStream.foreachBatch(process)
        .option("checkpointLocation", paths.checkpoint)
        .trigger(**(trigger or {"processingTime": TRIGGER}))
        .start()
    )
