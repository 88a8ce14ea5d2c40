from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from pitchside.functions.columns import joined_text, utc_from_epoch, utc_from_iso
from pitchside.sinks.landing import batch_file, land_batch, with_audit
from pitchside.schemas import RAW_POSTS
from pitchside.sources.posts import post_records, read_posts, read_responses, rejected_posts


@pytest.fixture(scope="module")
def responses(tmp_path_factory):
    folder = tmp_path_factory.mktemp("responses")
    full = {
        "id": "a", "title": "T", "author": "u", "subreddit": "s", "url": "x", "selftext": "B",
        "score": 3, "upvote_ratio": 0.5, "num_comments": 2, "created_utc": 1717689600,
    }
    bare = {"id": "b", "title": None}
    files = {
        "1": {"data": [full, bare], "fetched_at": "2024-06-06T18:00:00+00:00"},
        "2": {"data": [], "fetched_at": "2024-06-06T18:15:00Z"},
        "3": {"fetched_at": "2024-06-06T18:30:00Z"},
        "4": {"data": [full], "fetched_at": "2024-06-06T20:45:00+02:00"},
    }
    for name, body in files.items():
        (folder / f"{name}.json").write_text(json.dumps(body, indent=1))
    return str(folder)


def test_read_posts(spark, responses):
    rows = sorted(read_posts(spark, responses).collect(), key=lambda r: (r.post_id, r.fetched_at))
    assert [r.post_id for r in rows] == ["a", "a", "b"]
    first, second, bare = rows
    assert first.created_utc == dt.datetime(2024, 6, 6, 16, 0)
    assert first.fetched_at == dt.datetime(2024, 6, 6, 18, 0)
    assert second.fetched_at == dt.datetime(2024, 6, 6, 18, 45)
    assert (bare.post_title, bare.post_body, bare.score) == (None, "", None)
    assert bare.created_utc == dt.datetime(1970, 1, 1)
    assert len(first) == 11


def test_odd_responses_lose_nothing(spark, tmp_path):
    posts = [
        {"id": "a", "score": "7", "num_comments": "x", "created_utc": "1717689600"},
        {"id": "b", "created_utc": "yesterday"},
        {"id": "c", "created_utc": None, "title": 5},
    ]
    body = json.dumps({"data": posts, "fetched_at": "2024-06-06T18:00:00Z"})
    (tmp_path / "1.json").write_text(body)
    (tmp_path / "2.json").write_text(body[:40])
    responses = read_responses(spark, str(tmp_path)).cache()
    rows = {r.post_id: r for r in post_records(responses).collect()}
    assert set(rows) == {"a", "c"}
    assert (rows["a"].score, rows["a"].num_comments) == (7, None)
    assert rows["a"].created_utc == dt.datetime(2024, 6, 6, 16, 0)
    assert (rows["c"].created_utc, rows["c"].post_title) == (dt.datetime(1970, 1, 1), "5")
    rejects = {r.reason: r.text for r in rejected_posts(responses).collect()}
    assert rejects["malformed response"] == body[:40]
    assert json.loads(rejects["unreadable date"])["id"] == "b"


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = spark.range(1).select(
            utc_from_epoch(F.lit(1717689600)).alias("epoch"),
            utc_from_iso(F.lit("2024-06-06T18:00:00.250000+02:00")).alias("iso"),
            utc_from_iso(F.lit("2024-06-06 18:00:00")).alias("bare"),
            utc_from_iso(F.lit("never")).alias("bad"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row.epoch == dt.datetime(2024, 6, 6, 16, 0)
    assert row.iso == dt.datetime(2024, 6, 6, 16, 0, 0, 250000)
    assert row.bare == dt.datetime(2024, 6, 6, 18, 0)
    assert row.bad is None


def test_text_assembly(spark):
    rows = spark.createDataFrame(
        [(" \tT\n", " B "), (None, "B"), ("T", None), (None, None), ("\n", " ")], "t STRING, b STRING"
    )
    assert [r[0] for r in rows.select(joined_text("t", "b")).collect()] == ["T B", "B", "T", "", ""]


def _posts(spark):
    fields = [f for f in RAW_POSTS.fields if not f.name.startswith("pipeline") and f.name != "raw_json"]
    base = {f.name: None for f in fields}
    rows = [
        tuple({**base, "post_id": "a", "fetched_at": dt.datetime(2026, 6, 6, 14, 30), "score": 1}.values()),
        tuple({**base, "post_id": "b", "fetched_at": dt.datetime(2026, 6, 6, 15, 0), "score": 2}.values()),
    ]
    return spark.createDataFrame(
        rows, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    )


def test_landing_is_by_hour_and_overwrites_on_retry(spark, tmp_path):
    posts = _posts(spark)
    for _ in range(2):
        path = land_batch(posts, "fetched_at", str(tmp_path / "raw"), 7)
    hours = sorted(p.relative_to(path).as_posix() for p in __import__("pathlib").Path(path).glob("*/*/*/*"))
    assert hours == ["year=2026/month=06/day=06/hour=14", "year=2026/month=06/day=06/hour=15"]
    assert spark.read.json(path).count() == 2


def test_landing_hours_do_not_depend_on_the_session_zone(spark):
    # 02:30 does not exist in this zone on that day.
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        time = F.lit("2024-03-10 02:30:00").cast("timestamp_ntz")
        path = spark.range(1).select(batch_file("p", "posts", time)).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert path == "p/2024/03/10/02/posts_20240310_023000.json"


def test_audit_columns(spark):
    file = batch_file("p/raw", "posts", F.col("fetched_at"))
    rows = {r.post_id: r for r in with_audit(_posts(spark), "load-1", file).collect()}
    assert rows["a"].pipeline_load_id == "load-1"
    assert rows["a"].pipeline_batch_file == "p/raw/2026/06/06/14/posts_20260606_143000.json"
    assert json.loads(rows["b"].raw_json)["score"] == 2
    assert "post_title" in json.loads(rows["b"].raw_json)
    assert [f.name for f in RAW_POSTS.fields] == list(rows["a"].asDict())
