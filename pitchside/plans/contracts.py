"""Declared data checks of every model (fixed values: columns and allowed lists)."""

from __future__ import annotations

from pitchside.operators.quality import Accepted, Rules

TOSS_DECISIONS = ["bat", "field"]
RESULT_TYPES = ["runs", "wickets", "tie/no result"]
EXTRAS_TYPES = ["wides", "noballs", "byes", "legbyes", "penalty"]
WICKET_KINDS = [
    "caught",
    "bowled",
    "run out",
    "lbw",
    "stumped",
    "hit wicket",
    "obstructing the field",
    "timed out",
    "caught and bowled",
    "retired hurt",
    "retired out",
    "handled the ball",
]
SENTIMENT_LABELS = ["POSITIVE", "NEGATIVE", "NEUTRAL"]

RULES: dict[str, Rules] = {
    "raw_posts": Rules(not_null=["post_id"]),
    "stg_matches": Rules(
        not_null=["match_id", "match_date", "season", "team1", "team2", "toss_winner",
                  "toss_decision", "result_type"],
        unique=["match_id"],
        accepted=[
            Accepted("toss_decision", TOSS_DECISIONS),
            Accepted("result_type", RESULT_TYPES),
        ],
    ),
    "stg_deliveries": Rules(
        not_null=["match_id", "inning_number", "batting_team", "over_number", "ball_number",
                  "batter", "bowler", "runs_batter", "runs_extras", "runs_total", "is_wicket",
                  "is_boundary", "is_six", "is_four"],
        accepted=[
            Accepted("extras_type", EXTRAS_TYPES, "extras_type is not null"),
            Accepted("wicket_kind", WICKET_KINDS, "wicket_kind is not null"),
        ],
    ),
    "latest_post": Rules(
        not_null=["post_id"],
        unique=["post_id"],
        accepted=[Accepted("sentiment_label", SENTIMENT_LABELS)],
    ),
    "dim_teams": Rules(not_null=["team_id", "team_name"], unique=["team_id", "team_name"]),
    "dim_venues": Rules(not_null=["venue_id", "venue"], unique=["venue_id", "venue"]),
    "dim_players": Rules(
        not_null=["player_id", "player_name"], unique=["player_id", "player_name"]
    ),
    "fct_match_results": Rules(
        not_null=["match_id", "match_date", "season", "team1", "team2", "toss_winner",
                  "toss_decision", "result_type", "team1_id", "team2_id", "venue_id"],
        unique=["match_id"],
    ),
    "fct_deliveries": Rules(
        not_null=["match_id", "inning_number", "over_number", "ball_number", "batter", "bowler",
                  "batter_id", "bowler_id"],
    ),
    "batting_stats": Rules(
        not_null=["player_name", "season", "innings_played", "total_runs", "balls_faced"]
    ),
    "bowling_stats": Rules(
        not_null=["player_name", "season", "balls_bowled", "runs_conceded", "total_wickets"]
    ),
    "team_performance": Rules(
        not_null=["team_name", "season", "matches_played", "matches_won"]
    ),
    "titles_won": Rules(not_null=["team_name", "titles_won"], unique=["team_name"]),
    "player_career": Rules(not_null=["player_name", "career_runs"], unique=["player_name"]),
    "daily_sentiment": Rules(not_null=["post_date", "total_posts"], unique=["post_date"]),
}
