"""Facts: staging rows with dimension ids and match context."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from pitchside.operators.entities import role_join
from pitchside.operators.keyed import incremental_append


def fct_match_results(
    stg_matches: DataFrame,
    dim_teams: DataFrame,
    dim_venues: DataFrame,
    hot: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """One row per match with the ids of both teams, the winner and the ground.

    ``hot`` names values of the roles that hold many matches (``entities.hot_keys``).
    """
    matches = stg_matches.select(
        "match_id", "match_date", "season", "team1", "team2", "venue", "city", "toss_winner",
        "toss_decision", "match_winner", "win_by_runs", "win_by_wickets", "result_type",
        "player_of_match", "event_name", "event_stage", "event_match_number",
    )
    columns = matches.columns
    with_teams = role_join(
        matches,
        dim_teams,
        "team_name",
        "team_id",
        {"team1": "team1_id", "team2": "team2_id", "match_winner": "winner_id"},
        hot,
    )
    with_venue = role_join(with_teams, dim_venues, "venue", "venue_id", {"venue": "venue_id"}, hot)
    return with_venue.select(*columns, "team1_id", "team2_id", "winner_id", "venue_id")


def fct_deliveries(
    stg_deliveries: DataFrame,
    dim_players: DataFrame,
    fct_match_results: DataFrame,
    target: DataFrame | None = None,
    loaded: DataFrame | None = None,
) -> DataFrame:
    """One row per ball with player ids and match context.

    With ``target`` (the stored fact) only balls of matches it does not hold are built; with ``loaded``
    (the ``match_id`` of this run's matches) only of these.
    """
    balls = incremental_append(target, stg_deliveries, "match_id", loaded).drop("loaded_at")
    columns = balls.columns
    with_players = role_join(
        balls,
        dim_players,
        "player_name",
        "player_id",
        {"batter": "batter_id", "bowler": "bowler_id"},
    )
    context = fct_match_results.select("match_id", "season", "match_date", "venue", "result_type")
    return with_players.join(context, "match_id", "left").select(
        *columns, "batter_id", "bowler_id", "season", "match_date", "venue", "result_type"
    )
