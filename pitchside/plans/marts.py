"""Stat marts.

``deliveries`` is the ball fact and ``matches`` the match fact. The marts read only columns that
the facts take over one-to-one from staging, so the staging frames serve as well. Balls are summed
per match before they meet the match table: ``match_id`` is unique there, so the sums are the same
and the join moves far fewer rows. Balls without a match drop out in that inner join.

The sums per match (``PARTS``) can be stored: a match's balls come at once, so the sums of new matches are
appended and the marts are merged from all of them, without the balls of earlier matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pitchside.functions.columns import count_when, ordered_listagg, ratio, rounded
from pitchside.operators.distinct import distinct_of
from pitchside.operators.entities import unpivot_roles
from pitchside.operators.picks import best_pair, best_value


def _with_season(per_match: DataFrame, matches: DataFrame) -> DataFrame:
    return per_match.join(matches.select("match_id", "season"), "match_id")


def batting_innings(deliveries: DataFrame) -> DataFrame:
    """Batter by match and innings: runs, balls, fours and sixes."""
    return deliveries.groupBy("batter", "match_id", "inning_number").agg(
        F.sum("runs_batter").alias("runs"),
        F.count(F.lit(1)).alias("balls"),
        count_when(F.col("is_four")).alias("fours"),
        count_when(F.col("is_six")).alias("sixes"),
    )


def bowling_matches(deliveries: DataFrame) -> DataFrame:
    """Bowler by match: balls, runs conceded (extras included) and wicket balls."""
    return deliveries.groupBy("bowler", "match_id").agg(
        F.count(F.lit(1)).alias("balls"),
        F.sum("runs_total").alias("runs"),
        count_when(F.col("is_wicket")).alias("wickets"),
    )


def team_runs(deliveries: DataFrame) -> DataFrame:
    """Batting team by match: all its runs."""
    return deliveries.groupBy("match_id", "batting_team").agg(F.sum("runs_total").alias("match_runs"))


#: What marts keep of the balls of a match.
PARTS = {
    "batting_innings": batting_innings,
    "bowling_matches": bowling_matches,
    "team_runs": team_runs,
}


def batting_stats(deliveries: DataFrame, matches: DataFrame) -> DataFrame:
    """Batter by season. Every ball counts as faced; the average is per innings."""
    return batting_of(batting_innings(deliveries), matches)


def batting_of(innings: DataFrame, matches: DataFrame) -> DataFrame:
    """``batting_stats`` from the rows of ``batting_innings``."""
    return (
        _with_season(innings, matches)
        .groupBy("batter", "season")
        .agg(
            F.count(F.lit(1)).alias("innings_played"),
            F.sum("runs").alias("total_runs"),
            F.sum("balls").alias("balls_faced"),
            F.sum("fours").alias("fours"),
            F.sum("sixes").alias("sixes"),
            F.sum(F.col("fours") + F.col("sixes")).alias("boundary_count"),
            F.max("runs").alias("highest_score"),
        )
        .select(
            F.col("batter").alias("player_name"),
            "season",
            "innings_played",
            "total_runs",
            "balls_faced",
            ratio(F.col("total_runs"), F.col("balls_faced"), 2, 100).alias("strike_rate"),
            ratio(F.col("total_runs"), F.col("innings_played"), 2).alias("average"),
            "fours",
            "sixes",
            "boundary_count",
            "highest_score",
        )
    )


def bowling_per_match(deliveries: DataFrame, matches: DataFrame) -> DataFrame:
    """Bowler by match, with its season."""
    return _with_season(bowling_matches(deliveries), matches)


def best_figures(deliveries: DataFrame, matches: DataFrame) -> DataFrame:
    """Best match figures ``wickets/runs`` per bowler and season."""
    return best_pair(
        bowling_per_match(deliveries, matches),
        ["bowler", "season"],
        "best_bowling_figures",
        desc="wickets",
        asc="runs",
    )


def bowling_stats(deliveries: DataFrame, matches: DataFrame) -> DataFrame:
    """Bowler by season. Economy divides by the overs after their rounding to one decimal."""
    return bowling_of(bowling_matches(deliveries), matches)


def bowling_of(per_match: DataFrame, matches: DataFrame) -> DataFrame:
    """``bowling_stats`` from the rows of ``bowling_matches``."""
    overs = rounded(F.col("balls_bowled").cast("double") / F.lit(6.0), 1)
    return (
        _with_season(per_match, matches)
        .where(F.col("bowler").isNotNull() & F.col("season").isNotNull())
        .groupBy("bowler", "season")
        .agg(
            F.sum("balls").alias("balls_bowled"),
            F.sum("runs").alias("runs_conceded"),
            F.sum("wickets").alias("total_wickets"),
            best_value(F.col("wickets"), F.col("runs")).alias("best"),
        )
        .withColumn("overs_bowled", overs)
        .select(
            F.col("bowler").alias("player_name"),
            "season",
            "balls_bowled",
            "overs_bowled",
            "runs_conceded",
            "total_wickets",
            ratio(F.col("runs_conceded"), F.col("overs_bowled"), 2).alias("economy_rate"),
            ratio(F.col("runs_conceded"), F.col("total_wickets"), 2).alias("bowling_average"),
            ratio(F.col("balls_bowled"), F.col("total_wickets"), 2).alias("bowling_strike_rate"),
            F.concat(
                F.col("best.most").cast("string"), F.lit("/"), F.col("best.least").cast("string")
            ).alias("best_bowling_figures"),
        )
    )


def team_matches(matches: DataFrame) -> DataFrame:
    """One row per team and match it took part in."""
    keep = ["season", "match_id", "match_winner", "toss_winner"]
    return unpivot_roles(matches, ["team1", "team2"], "team_name", keep).select(
        "season", "team_name", "match_id", "match_winner", "toss_winner"
    )


def team_performance(deliveries: DataFrame, matches: DataFrame) -> DataFrame:
    """Team by season: wins, tosses and the average of all its runs in a match."""
    return team_performance_of(team_runs(deliveries), matches)


def team_performance_of(runs: DataFrame, matches: DataFrame) -> DataFrame:
    """``team_performance`` from the rows of ``team_runs``."""
    # A match meets the list of its teams' sums, so both sides move by match alone, if they move at all.
    sums = runs.where(F.col("match_id").isNotNull() & F.col("batting_team").isNotNull())
    sums = sums.groupBy("match_id").agg(
        F.collect_list(F.struct("batting_team", "match_runs")).alias("_sums")
    )
    keep = ["season", "match_winner", "toss_winner", "_sums"]
    played = unpivot_roles(matches.join(sums, "match_id", "left"), ["team1", "team2"], "team_name", keep)
    own = F.filter("_sums", lambda x: x["batting_team"] == F.col("team_name"))
    # Both sides take the season from the same match row; only a missing season never matches.
    own = F.when(F.col("season").isNotNull(), own)
    played = played.select("*", F.explode_outer(own["match_runs"]).alias("match_runs"))
    won = F.col("match_winner") == F.col("team_name")
    toss = F.col("toss_winner") == F.col("team_name")
    return (
        played.groupBy("team_name", "season")
        .agg(
            F.count(F.lit(1)).alias("matches_played"),
            count_when(won).alias("matches_won"),
            count_when(toss).alias("toss_wins"),
            count_when(toss & won).alias("_toss_and_match"),
            rounded(F.avg("match_runs"), 2).alias("avg_runs_per_match"),
        )
        .select(
            "team_name",
            "season",
            "matches_played",
            "matches_won",
            ratio(F.col("matches_won"), F.col("matches_played"), 2, 100).alias("win_rate"),
            "toss_wins",
            ratio(F.col("_toss_and_match"), F.col("toss_wins"), 2, 100).alias(
                "toss_win_to_match_win_rate"
            ),
            "avg_runs_per_match",
        )
    )


def titles_won(matches: DataFrame) -> DataFrame:
    """Won finals per team, with the list of their seasons."""
    finals = matches.where(
        (F.col("event_stage") == "Final") & F.col("match_winner").isNotNull()
    )
    per_season = finals.groupBy("match_winner", "season").agg(F.count(F.lit(1)).alias("titles"))
    return per_season.groupBy(F.col("match_winner").alias("team_name")).agg(
        F.sum("titles").alias("titles_won"),
        F.min("season").alias("first_title_season"),
        F.max("season").alias("last_title_season"),
        ordered_listagg("season", "titles").alias("title_seasons"),
    )


def player_career(
    batting: DataFrame, bowling: DataFrame, approximate: bool = False
) -> DataFrame:
    """Career totals from the two season marts, one row per player who batted.

    Seasons are counted as distinct values, whatever the grain of the rows; ``approximate`` counts them
    by sketches.
    """
    bat = (
        batting.groupBy("player_name")
        .agg(
            distinct_of("season", approximate).alias("seasons_played"),
            F.sum("innings_played").alias("total_innings"),
            F.sum("total_runs").alias("career_runs"),
            F.sum("balls_faced").alias("career_balls_faced"),
            F.sum("fours").alias("career_fours"),
            F.sum("sixes").alias("career_sixes"),
            F.max("highest_score").alias("highest_score"),
        )
    )
    bowl = (
        bowling.groupBy("player_name")
        .agg(
            F.sum("total_wickets").alias("_wickets"),
            F.sum("runs_conceded").alias("_conceded"),
            # One-decimal numbers: the rounding takes out the noise of adding them in any order.
            rounded(F.sum("overs_bowled"), 1).alias("_overs"),
        )
    )
    return bat.join(bowl, "player_name", "left").select(
        "player_name",
        "seasons_played",
        "total_innings",
        "career_runs",
        "career_balls_faced",
        ratio(F.col("career_runs") * F.lit(100.0), F.col("career_balls_faced"), 2).alias(
            "career_strike_rate"
        ),
        ratio(F.col("career_runs"), F.col("total_innings"), 2).alias("career_average"),
        "career_fours",
        "career_sixes",
        "highest_score",
        F.coalesce(F.col("_wickets"), F.lit(0)).cast("long").alias("career_wickets"),
        ratio(F.col("_conceded"), F.col("_overs"), 2).alias("career_economy"),
        ratio(F.col("_conceded"), F.col("_wickets"), 2).alias("career_bowling_average"),
    )


def _daily_columns(sums: DataFrame) -> DataFrame:
    return sums.select(
        "post_date",
        "total_posts",
        "avg_sentiment_score",
        "positive_posts",
        "negative_posts",
        "neutral_posts",
        ratio(F.col("positive_posts"), F.col("total_posts"), 2, 100).alias("positive_pct"),
        ratio(F.col("negative_posts"), F.col("total_posts"), 2, 100).alias("negative_pct"),
        "max_sentiment_score",
        "min_sentiment_score",
    )


def daily_sentiment(latest_post: DataFrame) -> DataFrame:
    """Posts and sentiment per calendar day of the post."""
    label, score = F.col("sentiment_label"), F.col("sentiment_score")
    return _daily_columns(
        latest_post.groupBy("post_date").agg(
            F.count(F.lit(1)).alias("total_posts"),
            rounded(F.avg(score), 4).alias("avg_sentiment_score"),
            count_when(label == "POSITIVE").alias("positive_posts"),
            count_when(label == "NEGATIVE").alias("negative_posts"),
            count_when(label == "NEUTRAL").alias("neutral_posts"),
            F.max(score).alias("max_sentiment_score"),
            F.min(score).alias("min_sentiment_score"),
        )
    )


def value_counts(posts: DataFrame, weight: Column | None = None) -> DataFrame:
    """Posts of each day by label and score. Counts of parts add up, and may be taken off again."""
    total = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return posts.groupBy("post_date", "sentiment_label", "sentiment_score").agg(
        total.cast("long").alias("posts")
    )


def daily_from_counts(counts: DataFrame) -> DataFrame:
    """``daily_sentiment`` from value counts; days without a post are left out."""
    label, score, posts = F.col("sentiment_label"), F.col("sentiment_score"), F.col("posts")

    def posts_of(name: str) -> Column:
        return F.sum(F.when(label == name, posts).otherwise(0)).alias(f"{name.lower()}_posts")

    scored = F.sum(F.when(score.isNotNull(), posts))
    return _daily_columns(
        counts.where("posts <> 0").groupBy("post_date").agg(
            F.sum(posts).alias("total_posts"),
            rounded(F.sum(score * posts) / scored, 4).alias("avg_sentiment_score"),
            posts_of("POSITIVE"), posts_of("NEGATIVE"), posts_of("NEUTRAL"),
            F.max(score).alias("max_sentiment_score"),
            F.min(score).alias("min_sentiment_score"),
        )
    )
