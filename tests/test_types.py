"""Types of the models, which the comparison with the twins sees as text."""

from __future__ import annotations

from pitchside import testviews as views
from pitchside.plans import dimensions, facts, marts, staging

SF = "/root/testdata/sf0.001"
LONGS = {"team_id", "venue_id", "player_id", "total_posts"}
DATES = {"match_date", "post_date"}


def test_types_of_the_models(spark):
    matches = staging.stg_matches(views.raw_matches(spark, SF))
    balls = staging.stg_deliveries(views.raw_deliveries(spark, SF))
    posts = staging.latest_post(views.raw_posts(spark, SF))
    teams, venues = dimensions.dim_teams(matches), dimensions.dim_venues(matches)
    players = dimensions.dim_players(balls)
    batting, bowling = marts.batting_stats(balls, matches), marts.bowling_stats(balls, matches)
    models = [
        matches, balls, posts, teams, venues, players,
        facts.fct_match_results(matches, teams, venues),
        facts.fct_deliveries(balls, players, matches),
        batting, bowling, marts.team_performance(balls, matches), marts.titles_won(matches),
        marts.player_career(batting, bowling), marts.daily_sentiment(posts),
    ]
    assert len(models) == 14
    for model in models:
        types = dict(model.dtypes)
        assert "void" not in types.values()
        for name, kind in types.items():
            if name in LONGS:
                assert kind == "bigint", name
            elif name in DATES:
                assert kind == "date", name
            elif name in ("created_utc", "fetched_at", "loaded_at"):
                assert kind.startswith("timestamp"), name
            elif name.startswith("is_"):
                assert kind in ("boolean", "int"), name
            elif name.endswith(("_rate", "_average", "_percentage", "_pct")):
                assert kind == "double", name
