from __future__ import annotations

import datetime as dt
import json
import random
import shutil

import pytest

from pitchside.plans import batch, marts, staging
from pitchside.schemas import RAW_POSTS
from pitchside.sources.posts import read_posts
from pitchside.streaming import posts as stream

AUDIT = ("pipeline_load_id", "pipeline_loaded_at", "pipeline_batch_file", "raw_json")
FIELDS = [f for f in RAW_POSTS.fields if f.name not in AUDIT]
SCHEMA = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in FIELDS)


def _post(post_id, fetched, created, score):
    row = {f.name: None for f in FIELDS}
    label = "POSITIVE" if score > 0.05 else "NEGATIVE" if score < -0.05 else "NEUTRAL"
    row.update(
        post_id=post_id,
        fetched_at=dt.datetime(2024, 1, 1) + dt.timedelta(minutes=fetched),
        created_utc=dt.datetime(2024, 1, 1) + dt.timedelta(days=created),
        sentiment_compound=score,
        sentiment_label=label,
    )
    return tuple(row.values())


def _run(spark, root, batches):
    """Each list of posts becomes one file and so one micro-batch."""
    source = f"{root}/source"
    for posts in batches:
        spark.createDataFrame(posts, SCHEMA).coalesce(1).write.mode("append").parquet(source)
    paths = stream.PostPaths(f"{root}/out")
    posts = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    query = stream.run_sentiment_stream(posts, paths, trigger={"availableNow": True})
    assert query.awaitTermination(300)
    return paths


def _daily(spark, paths):
    rows = stream.read_daily(spark, paths).collect()
    return {r.post_date: (r.total_posts, r.positive_posts, r.negative_posts) for r in rows}


def _batch_answer(spark, paths):
    raw = stream.read_raw_posts(spark, paths)
    latest = staging.latest_post(raw)
    return latest, marts.daily_sentiment(latest)


def _same(a, b):
    columns = sorted(b.columns)
    rows = [sorted(map(str, df.select(*columns).collect())) for df in (a, b)]
    assert rows[0] == rows[1]


def test_newer_version_changes_counts_and_days(spark, tmp_path):
    day = [dt.date(2024, 1, 1 + i) for i in range(4)]
    paths = _run(
        spark,
        str(tmp_path),
        [
            [_post("a", 0, 0, 0.5), _post("b", 0, 0, 0.5), _post("c", 0, 3, -0.5)],
            # a turns negative, b moves to another day, c leaves its day without posts
            [_post("a", 15, 0, -0.5), _post("b", 15, 1, 0.5), _post("c", 15, 1, -0.5)],
            # an older version that comes late changes nothing
            [_post("a", 5, 2, 0.9)],
        ],
    )
    assert _daily(spark, paths) == {day[0]: (1, 0, 1), day[1]: (2, 1, 1)}
    assert stream.read_latest(spark, paths).count() == 3
    latest, daily = _batch_answer(spark, paths)
    _same(stream.read_daily(spark, paths), daily)
    _same(stream.read_latest(spark, paths).drop("version_tie"), latest)


def test_stream_equals_batch_on_random_posts(spark, tmp_path):
    rng = random.Random(11)
    versions = [
        _post(
            # one post holds a third of the versions
            "p0" if i % 3 == 0 else f"p{rng.randrange(30)}",
            i,
            rng.randrange(5),
            rng.choice([-0.5, 0.0, 0.25, 0.75]),
        )
        for i in range(120)
    ]
    rng.shuffle(versions)
    batches = [versions[i : i + 40] for i in range(0, 120, 40)]
    paths = _run(spark, str(tmp_path), batches)
    latest, daily = _batch_answer(spark, paths)
    _same(stream.read_daily(spark, paths), daily)
    _same(stream.read_latest(spark, paths).drop("version_tie"), latest)


def test_refresh_twice_is_the_same_as_once(spark, tmp_path):
    paths = _run(spark, str(tmp_path), [[_post("a", 0, 0, 0.5)], [_post("a", 1, 1, 0.5)]])
    before = _daily(spark, paths)
    versions = staging.post_versions(stream.read_raw_posts(spark, paths).where("batch_id = 1"))
    stream.refresh_posts(spark, paths, versions)
    assert _daily(spark, paths) == before == {dt.date(2024, 1, 2): (1, 1, 0)}


@pytest.mark.parametrize("crash_in", ["latest_post", "daily_sentiment"])
def test_crash_while_partitions_are_swapped(spark, tmp_path, monkeypatch, crash_in):
    first = [_post("a", 0, 0, 0.5), _post("b", 0, 0, -0.5), _post("c", 0, 2, 0.5)]
    paths = _run(spark, str(tmp_path), [first])
    overwrite = stream._overwrite_partitions

    def dies(df, path, column):
        if path.endswith(crash_in):
            # An old partition is gone and the new one is not there yet.
            at = df.where("post_id = 'a'" if column == "bucket" else "posts > 0").first()[column]
            shutil.rmtree(f"{path}/{column}={at if column == 'bucket' else '2024-01-01'}")
            raise RuntimeError("driver lost")
        overwrite(df, path, column)

    monkeypatch.setattr(stream, "_overwrite_partitions", dies)
    with pytest.raises(Exception, match="driver lost"):
        _run(spark, str(tmp_path), [[_post("a", 15, 1, 0.5)]])
    monkeypatch.setattr(stream, "_overwrite_partitions", overwrite)
    paths = _run(spark, str(tmp_path), [])
    latest, daily = _batch_answer(spark, paths)
    _same(stream.read_latest(spark, paths).drop("version_tie"), latest)
    _same(stream.read_daily(spark, paths), daily)
    assert _daily(spark, paths)[dt.date(2024, 1, 1)] == (1, 0, 1)


def test_restart_continues_after_the_last_batch(spark, tmp_path):
    _run(spark, str(tmp_path), [[_post("a", 0, 0, 0.5)]])
    paths = _run(spark, str(tmp_path), [[_post("b", 1, 0, 0.5)]])
    assert _daily(spark, paths) == {dt.date(2024, 1, 1): (2, 2, 0)}
    assert stream.read_raw_posts(spark, paths).count() == 2


def test_responses_are_scored_and_an_empty_batch_is_skipped(spark, tmp_path):
    responses = tmp_path / "responses"
    responses.mkdir()
    post = {"id": "a", "title": "good", "selftext": "", "created_utc": 1704067200}
    bodies = [
        {"data": [], "fetched_at": "2024-01-01T00:00:00Z"},
        {"data": [post], "fetched_at": "2024-01-01T00:15:00Z"},
        {"data": [{**post, "title": "bad"}], "fetched_at": "2024-01-01T00:30:00Z"},
    ]
    for i, body in enumerate(bodies):
        (responses / f"{i}.json").write_text(json.dumps(body))
    lexicon = spark.createDataFrame([("good", 2.0), ("bad", -2.0)], ["token", "valence"])
    paths = stream.PostPaths(str(tmp_path / "out"))
    posts = read_posts(spark, str(responses), streaming=True, files_per_batch=1)
    query = stream.run_sentiment_stream(
        posts,
        paths,
        lexicon,
        trigger={"availableNow": True},
        after_batch=lambda s: batch.log_run(s, "post_pipeline", "Micro Batch"),
    )
    assert query.awaitTermination(300)
    (latest,) = stream.read_latest(spark, paths).collect()
    assert (latest.post_id, latest.title, latest.sentiment_label) == ("a", "bad", "NEGATIVE")
    assert stream.read_raw_posts(spark, paths).count() == 2
    landed = spark.read.json(paths.landing)
    assert landed.count() == 2 and "sentiment_label" in landed.columns
    assert _daily(spark, paths) == {dt.date(2024, 1, 1): (1, 0, 1)}
    (run,) = spark.table("marts.pipeline_run_log").where("pipeline_name = 'post_pipeline'").collect()
    assert (run.run_type, run.status) == ("Micro Batch", "SUCCESS")
    checks = batch.check_models(stream.post_models(spark, paths)).collect()
    assert len(checks) == 7 and all(c.passed for c in checks)


def test_a_batch_reads_its_own_buckets(spark, tmp_path):
    """The held rows of other buckets are neither read nor rewritten."""
    first = [_post(f"p{i}", 0, i % 3, 0.5) for i in range(60)]
    paths = _run(spark, str(tmp_path), [first])
    held = stream.read_held(spark, paths)
    assert held.select("bucket").distinct().count() > 20
    files = {f for f in held.inputFiles() if "bucket=" in f}
    bucket = held.where("post_id = 'p7'").first().bucket
    (scan,) = [
        line for line in held.where(f"bucket in ({bucket})")._jdf.queryExecution().executedPlan()
        .toString().splitlines() if "FileScan" in line
    ]
    assert "PartitionFilters: [isnotnull(bucket" in scan or "PartitionFilters: [(bucket" in scan
    assert "body" not in scan and "title" not in scan
    paths = _run(spark, str(tmp_path), [[_post("p7", 15, 1, -0.5)]])
    after = {f for f in stream.read_held(spark, paths).inputFiles() if "bucket=" in f}
    assert {f for f in files - after} == {f for f in files if f"bucket={bucket}/" in f}
    latest, daily = _batch_answer(spark, paths)
    _same(stream.read_daily(spark, paths), daily)


def test_signed_counts_of_every_kind_of_move(spark):
    fresh = [("new", 1, 0.5, 2), ("newer", 2, 0.5, 2), ("older", 0, 0.1, 2), ("same", 1, 0.5, 1)]
    held = [("newer", 1, -0.5, 1), ("older", 1, 0.5, 1), ("same", 1, 0.5, 1), ("other", 5, 0.9, 1)]

    def frame(rows):
        posts = [_post(key, fetched, day, score) for key, fetched, score, day in rows]
        raw = spark.createDataFrame(posts, SCHEMA)
        raw = raw.selectExpr("*", "'l' AS pipeline_load_id", "fetched_at AS pipeline_loaded_at")
        return stream.narrow_versions(staging.post_versions(raw), 4)

    moved = stream.replaced_versions(frame(fresh), frame(held))
    assert {r.post_id for r in moved.collect()} == {"new", "newer"}
    got = {(r.post_date.day, r.sentiment_score): r.posts for r in stream.signed_counts(moved).collect()}
    assert got == {(3, 0.5): 2, (2, -0.5): -1}
