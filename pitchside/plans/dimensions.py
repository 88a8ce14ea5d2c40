"""Dimensions with dense surrogate keys in name order."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pitchside.operators.entities import entity_union, surrogate_key


def dim_teams(stg_matches: DataFrame) -> DataFrame:
    names = entity_union(stg_matches, ["team1", "team2"], "team_name")
    return surrogate_key(names, "team_name", "team_id")


def dim_venues(stg_matches: DataFrame) -> DataFrame:
    """One row per ground; the city is the greatest one recorded for it."""
    grounds = (
        stg_matches.where(F.col("venue").isNotNull()).groupBy("venue").agg(F.max("city").alias("city"))
    )
    return surrogate_key(grounds, "venue", "venue_id")


def dim_players(stg_deliveries: DataFrame) -> DataFrame:
    """Everyone who faced or bowled a ball; non-strikers and fielders alone get no id."""
    names = entity_union(stg_deliveries, ["batter", "bowler"], "player_name")
    return surrogate_key(names, "player_name", "player_id")
