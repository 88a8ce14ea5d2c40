"""Nested match documents: one JSON object per match, the file name's stem is the match id."""

from __future__ import annotations

from pyspark.sql import (
    Column, DataFrame, DataFrameReader, SparkSession, functions as F, types as T,
)
from pyspark.sql.streaming import DataStreamReader

from pitchside.functions.columns import first_key, first_of, not_empty
from pitchside.schemas import MATCH_DOCUMENT, as_text

CORRUPT = "_corrupt"
_READ_SCHEMA = T.StructType(
    [*as_text(MATCH_DOCUMENT).fields, T.StructField(CORRUPT, T.StringType())]
)


def split_docs(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sound documents, and the rejected: malformed ones and those without their header.

    Values are read as text and cast where they are used, so a value of another type is NULL and the
    document stays.
    """
    bad = F.col("info").isNull()
    good = docs.where(~bad).select("match_id", "info", "innings")
    return good, docs.where(bad).select("match_id", F.col(CORRUPT).alias("document"))


def _scan(reader: DataFrameReader | DataStreamReader, path: str) -> DataFrame:
    return (
        reader.schema(_READ_SCHEMA)
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("pathGlobFilter", "*.json")
        .json(path)
        .withColumn("match_id", F.regexp_extract("_metadata.file_name", r"^(.*)\.json$", 1))
    )


def scan_match_docs(spark: SparkSession, path: str) -> DataFrame:
    """All documents of a folder as they were read, for ``split_docs``."""
    return _scan(spark.read, path)


def read_match_docs(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Documents ``(match_id, info, innings)`` of a folder, and the rejected files.

    Malformed files and files without ``info`` are rejected; the others are read all the same.
    """
    return split_docs(_scan(spark.read, path))


def stream_match_docs(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    """Documents of a folder as a stream that reads each file once; a batch is for ``split_docs``."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _scan(reader, path)


def parse_match_docs(df: DataFrame, id_col: str, json_col: str) -> tuple[DataFrame, DataFrame]:
    """The same for documents that already lie in a text column, one per row."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    doc = F.from_json(json_col, _READ_SCHEMA, options)
    # As a generator the parse runs once per row, and not again for every field and filter.
    return split_docs(df.select(F.col(id_col).alias("match_id"), F.inline(F.array(doc))))


def whole(value: Column) -> Column:
    """A whole number; NULL for anything else."""
    return value.try_cast("int")


def match_headers(docs: DataFrame) -> DataFrame:
    """One row per match; every missing field is NULL but the season, which is then empty."""
    info = F.col("info")
    fields: dict[str, Column] = {
        "match_id": F.col("match_id"),
        "match_date": first_of(info["dates"]).try_cast("date"),
        "season": F.coalesce(info["season"], F.lit("")),
        "team1": first_of(info["teams"]),
        "team2": F.get(info["teams"], F.lit(1)),
        "venue": info["venue"],
        "city": info["city"],
        "toss_winner": info["toss"]["winner"],
        "toss_decision": info["toss"]["decision"],
        "match_winner": info["outcome"]["winner"],
        "win_by_runs": whole(info["outcome"]["by"]["runs"]),
        "win_by_wickets": whole(info["outcome"]["by"]["wickets"]),
        "player_of_match": first_of(info["player_of_match"]),
        "event_name": info["event"]["name"],
        "event_stage": info["event"]["stage"],
        "event_match_number": whole(info["event"]["match_number"]),
    }
    return docs.select(*[value.alias(name) for name, value in fields.items()])


def deliveries(docs: DataFrame) -> DataFrame:
    """One row per ball: innings count from 1, balls of an over from 0, first wicket only."""
    innings = docs.select("match_id", F.posexplode("innings").alias("i", "inning"))
    overs = innings.select(
        "match_id",
        (F.col("i") + 1).alias("inning_number"),
        F.col("inning.team").alias("batting_team"),
        F.explode("inning.overs").alias("over"),
    )
    balls = overs.select(
        "match_id",
        "inning_number",
        "batting_team",
        whole(F.col("over.over")).alias("over_number"),
        F.posexplode("over.deliveries").alias("ball_number", "ball"),
    )
    ball, runs = F.col("ball"), F.col("ball.runs")
    wicket = first_of("ball.wickets")
    return balls.select(
        "match_id",
        "inning_number",
        "batting_team",
        "over_number",
        "ball_number",
        ball["batter"].alias("batter"),
        ball["bowler"].alias("bowler"),
        ball["non_striker"].alias("non_striker"),
        F.coalesce(whole(runs["batter"]), F.lit(0)).alias("runs_batter"),
        F.coalesce(whole(runs["extras"]), F.lit(0)).alias("runs_extras"),
        F.coalesce(whole(runs["total"]), F.lit(0)).alias("runs_total"),
        first_key("ball.extras").alias("extras_type"),
        not_empty("ball.wickets").alias("is_wicket"),
        wicket["kind"].alias("wicket_kind"),
        wicket["player_out"].alias("player_out"),
        first_of(wicket["fielders"])["name"].alias("fielder"),
    )
