from __future__ import annotations

import datetime as dt

import pytest

from pitchside.plans import marts, staging
from pitchside.sources import documents
from pitchside.sources.tables import list_files, unseen_files
from tests.documents import write_folder


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return write_folder(tmp_path_factory.mktemp("docs"))


@pytest.fixture(scope="module")
def parsed(spark, folder):
    docs, rejects = documents.read_match_docs(spark, folder)
    headers = {r.match_id: r for r in documents.match_headers(docs).collect()}
    balls = documents.deliveries(docs).collect()
    return headers, balls, {r.match_id for r in rejects.collect()}


def test_bad_files_are_rejected_and_the_others_read(parsed):
    headers, _, rejects = parsed
    assert rejects == {"1003", "1004"}
    assert set(headers) == {"1001", "1002", "1005", "1006", "1007"}


def test_header_fields(parsed):
    row = parsed[0]["1001"]
    assert row.match_date == dt.date(2008, 4, 18)
    assert (row.team1, row.team2, row.venue, row.city) == ("Reds", "Blues", "Main Ground", "Town")
    assert (row.toss_winner, row.toss_decision) == ("Reds", "field")
    assert (row.match_winner, row.win_by_runs, row.win_by_wickets) == ("Blues", 140, None)
    assert (row.player_of_match, row.event_name) == ("A Bat", "League")
    assert (row.event_stage, row.event_match_number) == (None, 1)


def test_missing_header_fields(parsed):
    headers = parsed[0]
    assert headers["1002"].season == "2026" and headers["1002"].team2 is None
    assert headers["1006"].season == "" and headers["1006"].match_date is None
    assert headers["1006"].city is None


def _of(balls, match_id):
    return [b for b in balls if b.match_id == match_id]


def test_balls_of_an_over(parsed):
    four, extra, out = sorted(_of(parsed[1], "1001"), key=lambda b: b.ball_number)
    assert [b.ball_number for b in (four, extra, out)] == [0, 1, 2]
    assert (four.runs_batter, four.extras_type, four.is_wicket) == (4, None, False)
    assert (extra.extras_type, extra.runs_extras, extra.runs_total) == ("noballs", 3, 3)
    assert (out.is_wicket, out.wicket_kind, out.player_out) == (True, "caught", "A Bat")
    assert out.fielder == "D Catch"


def test_missing_runs_extras_and_wickets(parsed):
    (ball,) = _of(parsed[1], "1002")
    assert (ball.runs_batter, ball.runs_extras, ball.runs_total) == (0, 0, 0)
    assert (ball.extras_type, ball.is_wicket, ball.wicket_kind) == (None, False, None)


def test_innings_beyond_two_and_first_wicket_only(parsed):
    balls = sorted(_of(parsed[1], "1005"), key=lambda b: b.inning_number)
    assert [b.inning_number for b in balls] == [1, 2, 3]
    assert balls[2].over_number == 7
    assert (balls[2].wicket_kind, balls[2].player_out, balls[2].fielder) == (
        "run out", "C Non", None,
    )
    assert not _of(parsed[1], "1006") and not _of(parsed[1], "1007")


def test_staging_and_marts_on_documents(spark, folder):
    docs, _ = documents.read_match_docs(spark, folder)
    from pyspark.sql import functions as F

    now = F.current_timestamp().alias("loaded_at")
    matches = staging.stg_matches(documents.match_headers(docs).select("*", now))
    balls = staging.stg_deliveries(documents.deliveries(docs).select("*", now))
    by_id = {r.match_id: r for r in matches.collect()}
    assert by_id["1001"].season == "2008"
    assert by_id["1007"].season == "2020/21"
    assert by_id["1005"].result_type == "tie/no result"
    assert by_id["1007"].result_type == "wickets"
    flags = {(b.match_id, b.runs_batter): b for b in balls.collect()}
    assert flags["1005", 5].is_boundary and not flags["1005", 5].is_four
    assert flags["1005", 6].is_six and flags["1001", 4].is_four
    (title,) = marts.titles_won(matches).collect()
    assert tuple(title) == ("Reds", 1, "2020/21", "2020/21", "2020/21")


def test_unseen_files(spark, folder):
    listing = list_files(spark, folder)
    seen = spark.createDataFrame([("1001.json",), ("1001.json",), ("gone.json",)], ["file_name"])
    names = {r.file_name for r in unseen_files(listing, seen).collect()}
    assert names == {f"{n}.json" for n in (1002, 1003, 1004, 1005, 1006, 1007)}


def test_wrong_types_spoil_one_value_only(spark):
    texts = [
        ('1', '{"info": {"venue": "V", "event": {"match_number": "12"}, "toss": "x",'
              ' "outcome": {"by": {"runs": "many"}}}, "innings": [{"team": "T", "overs":'
              ' [{"over": 1.5, "deliveries": [{"batter": 7, "runs": {"batter": "4"},'
              ' "extras": {"wides": 1.5}}]}]}]}'),
        ('2', '{"info": {"venue": '),
    ]
    df = spark.createDataFrame(texts, "id STRING, doc STRING")
    docs, rejects = documents.parse_match_docs(df, "id", "doc")
    header = documents.match_headers(docs).first()
    assert (header.match_id, header.venue, header.event_match_number) == ("1", "V", 12)
    assert (header.win_by_runs, header.toss_winner) == (None, None)
    ball = documents.deliveries(docs).first()
    assert (ball.batter, ball.runs_batter, ball.extras_type) == ("7", 4, "wides")
    assert ball.over_number is None
    assert [r.match_id for r in rejects.collect()] == ["2"]
