"""Landed post responses: ``{"data": [post, ...], "fetched_at": ...}``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from pitchside.functions.columns import utc_from_epoch, utc_from_iso
from pitchside.schemas import POST_RESPONSE, as_text

CORRUPT = "_corrupt"
#: Values are read as text, so that one of another type does not spoil its post or response.
RESPONSE = T.StructType([*as_text(POST_RESPONSE).fields, T.StructField(CORRUPT, T.StringType())])

_NUMBER = r"^\s*[-+]?[0-9]+([.][0-9]*)?([eE][-+]?[0-9]+)?\s*$"


def _created(post: str) -> Column:
    return F.col(f"{post}.created_utc").cast("string")


def _misdated(post: str) -> Column:
    """A time of creation that is there and is no number. A missing one is the epoch."""
    return F.coalesce(~_created(post).rlike(_NUMBER), F.lit(False))


def post_records(responses: DataFrame) -> DataFrame:
    """One row per post of each response; an empty or missing list gives none.

    Numbers may be written as text; what is no number is NULL. Posts whose time of creation cannot be
    read are left to ``rejected_posts``.
    """
    posts = responses.select(F.explode("data").alias("p"), "fetched_at").where(~_misdated("p"))
    return posts.select(
        F.col("p.id").alias("post_id"),
        F.col("p.title").alias("post_title"),
        F.col("p.author").alias("post_author"),
        F.col("p.subreddit").alias("subreddit"),
        F.col("p.url").alias("post_url"),
        F.coalesce("p.selftext", F.lit("")).alias("post_body"),
        F.col("p.score").try_cast("long").alias("score"),
        F.col("p.upvote_ratio").try_cast("double").alias("upvote_ratio"),
        F.col("p.num_comments").try_cast("long").alias("num_comments"),
        utc_from_epoch(_created("p").try_cast("double")).alias("created_utc"),
        utc_from_iso("fetched_at").alias("fetched_at"),
    )


def rejected_posts(responses: DataFrame) -> DataFrame:
    """``text, reason``: responses that are no JSON as a whole, and posts without a readable date."""
    malformed = responses.where(
        F.col(CORRUPT).isNotNull() & F.col("data").isNull() & F.col("fetched_at").isNull()
    )
    posts = responses.select(F.explode("data").alias("p")).where(_misdated("p"))
    return malformed.select(
        F.col(CORRUPT).alias("text"), F.lit("malformed response").alias("reason")
    ).unionByName(
        posts.select(F.to_json("p").alias("text"), F.lit("unreadable date").alias("reason"))
    )


def parse_responses(df: DataFrame, json_col: str) -> DataFrame:
    """Responses that lie in a text column, for ``post_records`` and ``rejected_posts``."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return df.select(F.inline(F.array(F.from_json(json_col, RESPONSE, options))))


def read_responses(
    spark: SparkSession, path: str, streaming: bool = False, files_per_batch: int | None = None
) -> DataFrame:
    """The responses below ``path``, as a batch or as a file stream.

    A stream reads each file once and takes ``files_per_batch`` files at a time.
    """
    reader = spark.readStream if streaming else spark.read
    reader = (
        reader.schema(RESPONSE)
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    if streaming and files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def read_posts(
    spark: SparkSession, path: str, streaming: bool = False, files_per_batch: int | None = None
) -> DataFrame:
    """Posts of the responses below ``path``; what cannot be read is told by ``rejected_posts``."""
    return post_records(read_responses(spark, path, streaming, files_per_batch))
