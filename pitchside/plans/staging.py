"""Staging models: typed, renamed and derived columns over the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pitchside.functions.columns import map_values
from pitchside.operators.picks import latest_per_key

# The two season spellings that are normalised; all others stay as they are.
SEASON_NAMES = {"2007/08": "2008", "2009/10": "2010"}


def stg_matches(raw_matches: DataFrame) -> DataFrame:
    """One row per match with a normalised season and the kind of result."""
    result_type = (
        F.when(F.col("win_by_runs").isNotNull(), "runs")
        .when(F.col("win_by_wickets").isNotNull(), "wickets")
        .otherwise("tie/no result")
    )
    return raw_matches.select(
        "match_id",
        F.col("match_date").cast("date").alias("match_date"),
        map_values("season", SEASON_NAMES).alias("season"),
        "team1",
        "team2",
        "venue",
        "city",
        "toss_winner",
        "toss_decision",
        "match_winner",
        F.col("win_by_runs").cast("int").alias("win_by_runs"),
        F.col("win_by_wickets").cast("int").alias("win_by_wickets"),
        "player_of_match",
        "event_name",
        "event_stage",
        "event_match_number",
        result_type.alias("result_type"),
        "loaded_at",
    )


def stg_deliveries(raw_deliveries: DataFrame) -> DataFrame:
    """One row per ball with boundary flags."""
    whole = ["inning_number", "over_number", "ball_number"]
    runs = ["runs_batter", "runs_extras", "runs_total"]
    typed = {c: F.col(c).cast("int") for c in whole + runs}
    typed["is_wicket"] = F.col("is_wicket").cast("boolean")
    return raw_deliveries.withColumns(typed).select(
        "match_id",
        "inning_number",
        "batting_team",
        "over_number",
        "ball_number",
        "batter",
        "bowler",
        "non_striker",
        *runs,
        "extras_type",
        "is_wicket",
        "wicket_kind",
        "player_out",
        "fielder",
        (F.col("runs_batter") >= 4).alias("is_boundary"),
        (F.col("runs_batter") == 6).alias("is_six"),
        (F.col("runs_batter") == 4).alias("is_four"),
        "loaded_at",
    )


# Staged name -> raw name of the post columns, in output order.
POST_COLUMNS = {
    "post_id": "post_id",
    "title": "post_title",
    "author": "post_author",
    "body": "post_body",
    "reddit_score": "score",
    "num_comments": "num_comments",
    "post_created_at": "created_utc",
    "fetched_at": "fetched_at",
    "loaded_at": "pipeline_loaded_at",
    "sentiment_score": "sentiment_compound",
    "sentiment_label": "sentiment_label",
    "sentiment_pos": "sentiment_positive",
    "sentiment_neg": "sentiment_negative",
    "sentiment_neu": "sentiment_neutral",
}

# A later fetch wins; then the greater load id; then the later load of the same batch.
POST_ORDER = ["fetched_at", "version_tie", "loaded_at"]


def post_versions(raw_posts: DataFrame) -> DataFrame:
    """Every fetched version of every post, renamed, with its calendar day."""
    return raw_posts.select(
        *[F.col(raw).alias(name) for name, raw in POST_COLUMNS.items()],
        F.to_date("created_utc").alias("post_date"),
        F.col("pipeline_load_id").alias("version_tie"),
    )


def latest_post(raw_posts: DataFrame) -> DataFrame:
    """The latest fetched version of each post."""
    newest = latest_per_key(post_versions(raw_posts), ["post_id"], POST_ORDER)
    return newest.drop("version_tie")
