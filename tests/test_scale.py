"""Shuffles that the large queries can do without, and what their results must keep."""

from __future__ import annotations

import pytest

from pitchside import testviews as views
from pitchside.functions.sentiment import Rules, score_text
from pitchside.plans import marts
from pitchside.session import stored_by
from pitchside.sinks import tables as sink

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def moves(df) -> int:
    """Exchanges of the plan, but for those that broadcast a table."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


def test_sums_by_match_follow_the_big_join_without_a_shuffle(spark, no_broadcast):
    balls = views.raw_deliveries(spark, SF_DIR)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10k")  # the names of teams are broadcast
    joined = balls.select("match_id", "batter", "runs_total")
    assert moves(joined.groupBy("match_id", "batter").count()) == moves(joined)


def test_tables_stored_by_match_are_joined_and_summed_without_a_shuffle(spark, no_broadcast):
    rows = [(str(i % 7) if i % 5 else None, i) for i in range(50)]
    balls = stored_by(spark.createDataFrame(rows, "match_id string, n int"), "balls", "match_id")
    seasons = [(str(i), "s") for i in range(7)] + [("3", "t"), (None, "u")]
    matches = stored_by(spark.createDataFrame(seasons, "match_id string, season string"), "m", "match_id")
    assert sorted(map(str, balls.collect())) == sorted(f"Row(match_id={k!r}, n={n})" for k, n in rows)
    joined = balls.groupBy("match_id", "n").count().join(matches, "match_id")
    assert moves(joined) == 0
    wanted = sum(k == key for k, _ in rows if k for key, _ in seasons)
    assert joined.count() == wanted


def test_team_runs_join_by_match(spark, no_broadcast):
    matches = spark.createDataFrame(
        [("1", "2020", "A", "B", "A", "A"), ("2", "2020", "A", "C", None, "C"),
         ("3", None, "A", "B", "B", "B"), ("4", "2020", "A", None, "A", "A"),
         (None, "2020", "A", "B", "B", "A")],
        "match_id string, season string, team1 string, team2 string, match_winner string,"
        " toss_winner string",
    )
    runs = spark.createDataFrame(
        [("1", "A", 10), ("1", "B", 20), ("2", "A", 40), ("3", "A", 50), ("4", None, 60), (None, "A", 70),
         ("2", "A", 5)],
        "match_id string, batting_team string, match_runs long",
    )
    found = {
        (r.team_name, r.season): (r.matches_played, r.avg_runs_per_match)
        for r in marts.team_performance_of(runs, matches).collect()
    }
    # A match with two sums of a team counts twice, as a join has it.
    assert found == {
        ("A", "2020"): (5, 18.33), ("B", "2020"): (2, 20.0), ("C", "2020"): (1, None),
        (None, "2020"): (1, None), ("A", None): (1, None), ("B", None): (1, None),
    }


@pytest.mark.parametrize("come", [["a", "b", "c"], ["a", "x"], ["x", "y"], ["a", None]])
def test_replaced_rows_by_what_is_held(spark, come):
    schema = "k string, n int"
    name = "scaled_" + "_".join(map(str, come)).lower()
    before = [(k, i) for i, k in enumerate(["a", "a", "b", "c", "d", None])]
    after = [(k, 100 + i) for i, k in enumerate(come + come)]
    sink.create_if_absent(spark, "raw", name, spark.createDataFrame([], schema).schema, bucketed=True)
    for rows in (before, after):
        sink.load_replacing(spark.createDataFrame(rows, schema), "raw", name, ["k"], 3)
    gone = {k for k in come if k}
    wanted = [r for r in before if r[0] not in gone] + after
    found = [(r.k, r.n) for r in spark.table(f"raw.{name}").collect()]
    assert sorted(found, key=str) == sorted(wanted, key=str)


def test_only_lexicon_words_meet_the_rules(spark):
    lexicon = spark.createDataFrame([("good", 2.0)], "token string, valence double")
    texts = spark.createDataFrame(
        [(1, "plain words alone"), (2, "a good day"), (3, ""), (2, "not good")], "id int, text string"
    )
    scored = score_text(texts, "id", "text", lexicon, rules=Rules())
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert "(isnotnull(valence" in plan or "Filter (isnotnull" in plan
    rows = {r.id: r for r in scored.collect()}
    assert rows[1].sentiment_neutral == 1.0 and rows[3].sentiment_neutral is None
    # Texts that share an id are one text of five words, of which two have a valence.
    assert rows[2].sentiment_positive == round(3 / (3 + 2.48 + 3), 3)
