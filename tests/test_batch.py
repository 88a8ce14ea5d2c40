from __future__ import annotations

import copy
import os

import pytest
from pyspark.sql import functions as F

from pitchside.plans import batch
from pitchside.sinks.tables import rebuild_table
from pitchside.sources.tables import read_table
from tests.documents import DOCUMENTS, write_folder


def _ids(df, column="match_id"):
    return sorted(r[0] for r in df.select(column).collect())


def test_batch_runs_and_replays(spark, tmp_path):
    folder = write_folder(tmp_path / "docs")
    report = batch.run_batch(spark, folder, buckets=8)
    checks = {(r.model, r.column_name, r.check_name): r.failures for r in report.collect()}
    assert checks["stg_matches", "team2", "not_null"] == 1  # a document with one team
    assert checks["stg_matches", "match_date", "not_null"] == 1
    assert checks["stg_matches", "match_id", "unique"] == 0
    assert len(checks) == 86 - 7  # the post models have their own pipeline
    raw = read_table(spark, "raw", "raw_deliveries")
    first = sorted(map(tuple, raw.drop("loaded_at").collect()))
    facts_first = sorted(map(tuple, read_table(spark, "facts", "fct_deliveries").collect()), key=str)

    # The same folder again: nothing changes.
    batch.run_batch(spark, folder, buckets=8)
    raw = spark.table("raw.raw_deliveries")
    assert sorted(map(tuple, raw.drop("loaded_at").collect())) == first
    again = sorted(map(tuple, spark.table("marts.fct_deliveries").collect()), key=str)
    assert again == facts_first
    log = spark.table("marts.pipeline_run_log").where("run_type = 'Batch'").collect()
    assert [(r.pipeline_name, r.run_type, r.status) for r in log] == [
        ("match_pipeline", "Batch", "SUCCESS")
    ]

    # A corrected header is skipped, corrected balls replace the old ones in the raw table only,
    # and a new match is appended to the fact.
    changed = copy.deepcopy(DOCUMENTS)
    changed["1001"]["info"]["city"] = "Elsewhere"
    changed["1001"]["innings"][0]["overs"][0]["deliveries"] = changed["1001"]["innings"][0]["overs"][
        0
    ]["deliveries"][:1]
    changed["1008"] = copy.deepcopy(DOCUMENTS["1002"])
    folder = write_folder(tmp_path / "changed", changed)
    batch.run_batch(spark, folder, buckets=8)
    matches = spark.table("raw.raw_matches")
    assert _ids(matches) == ["1001", "1002", "1005", "1006", "1007", "1008"]
    assert matches.where("match_id = '1001'").first().city == "Town"
    assert spark.table("raw.raw_deliveries").where("match_id = '1001'").count() == 1
    fact = spark.table("marts.fct_deliveries")
    assert fact.where("match_id = '1001'").count() == 3
    assert fact.where("match_id = '1008'").count() == 1
    # A folder with one match leaves the balls of all others alone.
    alone = write_folder(tmp_path / "alone", {"1005": DOCUMENTS["1005"]}, {})
    before = spark.table("raw.raw_deliveries").count()
    batch.load_documents(spark, alone, buckets=8)
    assert spark.table("raw.raw_deliveries").count() == before
    assert spark.table("marts.batting_stats").count() > 0
    assert spark.table("marts.player_career").count() > 0


def test_new_files_are_loaded_once(spark, tmp_path):
    def load(documents, malformed):
        folder = write_folder(tmp_path / "docs", documents, malformed)
        batch.load_new_documents(
            spark, folder, str(tmp_path / "checkpoint"), buckets=8, files_per_batch=2
        )

    spark.sql("DROP TABLE IF EXISTS raw.raw_matches")
    spark.sql("DROP TABLE IF EXISTS raw.raw_deliveries")
    load({k: DOCUMENTS[k] for k in ("1001", "1005")}, {"1003": "{"})
    assert _ids(spark.table("raw.raw_matches")) == ["1001", "1005"]
    first = spark.table("raw.raw_deliveries").where("match_id = '1001'").first().loaded_at
    load({"1007": DOCUMENTS["1007"], "1002": DOCUMENTS["1002"]}, {})
    assert _ids(spark.table("raw.raw_matches")) == ["1001", "1002", "1005", "1007"]
    balls = spark.table("raw.raw_deliveries")
    assert _ids(balls) == ["1001"] * 3 + ["1002"] + ["1005"] * 3
    assert balls.where("match_id = '1001'").first().loaded_at == first


def test_crash_while_buckets_are_swapped(spark, monkeypatch):
    from contextlib import contextmanager

    from pyspark.sql import types as T

    from pitchside.sinks import tables

    schema = T.StructType().add("k", T.StringType()).add("v", T.IntegerType())
    tables.create_if_absent(spark, "raw", "swapped", schema, bucketed=True)

    def load(*rows):
        df = spark.createDataFrame(rows, schema)
        tables.load_replacing(df, "raw", "swapped", ["k"], 1)

    def content():
        return sorted((r.k, r.v) for r in spark.table("raw.swapped").collect())

    load(("a", 1), ("b", 2))
    load()
    load(("b", 4), ("c", 5), ("c", 6))
    assert content() == [("a", 1), ("b", 4), ("c", 5), ("c", 6)]
    load(("b", 2))
    whole = tables._dynamic_overwrite

    @contextmanager
    def dies(session):
        session.sql("TRUNCATE TABLE raw.swapped")
        raise RuntimeError("driver lost")
        yield

    monkeypatch.setattr(tables, "_dynamic_overwrite", dies)
    with pytest.raises(RuntimeError):
        load(("a", 3))
    assert content() == []
    monkeypatch.setattr(tables, "_dynamic_overwrite", whole)
    load(("a", 3))
    assert content() == [("a", 3), ("b", 2), ("c", 5), ("c", 6)]


def test_only_buckets_of_held_keys_are_rewritten(spark):
    from pyspark.sql import types as T

    from pitchside.sinks import tables

    schema = T.StructType().add("k", T.StringType()).add("v", T.IntegerType())
    tables.create_if_absent(spark, "raw", "partly", schema, bucketed=True)

    def load(rows):
        tables.load_replacing(spark.createDataFrame(rows, schema), "raw", "partly", ["k"], 4)

    def files():
        return set(spark.table("raw.partly").inputFiles())

    load([(f"k{i}", i) for i in range(40)])
    first = files()
    load([(f"n{i}", i) for i in range(40)])
    assert first < files()  # new keys: every old file is still there
    second = files()
    load([("k7", 70), ("k7", 71)])
    assert len({f.split("key_bucket=")[1][0] for f in second - files()}) == 1
    rows = {}
    for r in spark.table("raw.partly").collect():
        rows.setdefault(r.k, []).append(r.v)
    assert sorted(rows.pop("k7")) == [70, 71]
    want = {f"{p}{i}": [i] for p in "kn" for i in range(40)}
    want.pop("k7")
    assert rows == want


def test_new_keys_are_counted(spark):
    from pitchside.schemas import RUN_LOG
    from pitchside.sinks.tables import create_if_absent, load_new_keys

    create_if_absent(spark, "raw", "counted", RUN_LOG)
    rows = spark.createDataFrame([("a", "x", None, "OK"), ("b", "x", None, "OK")], RUN_LOG)
    first = load_new_keys(rows.limit(1), "raw", "counted", ["pipeline_name"])
    assert first == {"inserted": 1, "skipped": 0}
    second = load_new_keys(rows, "raw", "counted", ["pipeline_name"])
    assert second == {"inserted": 1, "skipped": 1}
    assert spark.table("raw.counted").count() == 2


def test_empty_replacement_changes_nothing(spark):
    from pitchside.sinks.tables import create_if_absent, load_replacing
    from pitchside.schemas import RAW_DELIVERIES

    create_if_absent(spark, "raw", "other_deliveries", RAW_DELIVERIES, bucketed=True)
    nothing = spark.createDataFrame([], RAW_DELIVERIES)
    load_replacing(nothing, "raw", "other_deliveries", ["match_id"], 4)
    assert spark.table("raw.other_deliveries").count() == 0


def test_a_rebuild_that_fails_leaves_the_table(spark):
    rows = spark.range(3).withColumn("v", F.lit("old"))
    assert rebuild_table(rows, "marts", "versioned").count() == 3
    broken = spark.range(5).withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        rebuild_table(broken, "marts", "versioned")
    assert spark.table("marts.versioned").select("v").distinct().collect()[0].v == "old"
    for n in (4, 5):
        assert rebuild_table(spark.range(n).withColumn("v", F.lit("new")), "marts", "versioned").count() == n
    assert spark.table("marts.versioned").count() == 5
    wider = spark.range(2).withColumns({"v": F.lit("new"), "w": F.lit(1)})
    assert rebuild_table(wider, "marts", "versioned").columns == ["id", "v", "w"]
    folder = spark.catalog.getDatabase("marts").locationUri + "/versioned_versions"
    assert len(os.listdir(folder.removeprefix("file:"))) <= 2


def _tables(spark):
    names = ["batting_stats", "bowling_stats", "team_performance"]
    return {n: sorted(map(tuple, spark.table(f"marts.{n}").collect()), key=str) for n in names}


def test_marts_are_merged_from_stored_sums(spark, tmp_path):
    """A later run sums the balls of its new matches alone, and the marts are as from all balls."""
    from pitchside.plans import marts

    for table in ("raw_matches", "raw_deliveries"):
        spark.sql(f"DROP TABLE IF EXISTS raw.{table}")
    for table in ("fct_deliveries", *marts.PARTS):
        spark.sql(f"DROP TABLE IF EXISTS marts.{table}")
    first = {k: DOCUMENTS[k] for k in ("1001", "1005")}
    batch.run_batch(spark, write_folder(tmp_path / "one", first, {}), buckets=8)
    batch.load_documents(spark, write_folder(tmp_path / "two", DOCUMENTS, {}), buckets=8)
    loaded = spark.createDataFrame([("1002",), ("1007",), ("1006",)], "match_id STRING")
    built = batch.build_models(spark, loaded, buckets=8, load_id="second")
    assert len(batch._loads(spark, "facts", "fct_deliveries")) == 2
    fact = spark.table("marts.fct_deliveries")
    second = {r.match_id for r in fact.where("load_id = 'second'").collect()}
    assert "1002" in second and not second & {"1001", "1005"}
    for name, part in marts.PARTS.items():
        stored = spark.table(f"marts.{name}")
        assert {r.match_id for r in stored.where("load_id = 'second'").collect()} == second
        whole = sorted(map(tuple, part(fact).collect()), key=str)
        assert sorted(map(tuple, stored.drop("load_id").collect()), key=str) == whole
    results = built["fct_match_results"]
    assert _tables(spark) == {
        "batting_stats": sorted(map(tuple, marts.batting_stats(fact, results).collect()), key=str),
        "bowling_stats": sorted(map(tuple, marts.bowling_stats(fact, results).collect()), key=str),
        "team_performance": sorted(
            map(tuple, marts.team_performance(fact, results).collect()), key=str
        ),
    }
    # A run that ended before its sums were stored leaves them to the next one, which reads that load.
    spark.sql("ALTER TABLE marts.team_runs DROP PARTITION (load_id = 'second')")
    lacking = fact.where(F.col("load_id").isin(["second"]))
    plan = marts.team_runs(lacking)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_id" in plan and "(load_id" in plan
    batch.add_sums(spark, "team_runs")
    assert spark.table("marts.team_runs").where("load_id = 'second'").count() > 0


def test_checks_counted_while_writing(spark):
    """Counts of a write, and the checks of a scan, are the same."""
    from pitchside.operators import quality

    rules = {
        "a": quality.Rules(not_null=["k", "v"], unique=["k", "v"],
                           accepted=[quality.Accepted("v", ["x", "y"])]),
        "b": quality.Rules(not_null=["n"], unique=["n"]),
        "c": quality.Rules(unique=["n"]),
    }
    tables = {
        "a": spark.createDataFrame([(1, "x"), (1, "y"), (2, None), (None, "z"), (3, "z")], "k INT, v STRING"),
        "b": spark.range(10).withColumnRenamed("id", "n"),
        "c": spark.createDataFrame([], "n DOUBLE"),
    }
    measured = quality.Measured(rules)
    for name in ("a", "c"):
        measured.watch(tables[name], name).write.format("noop").mode("overwrite").save()
    got = sorted(map(tuple, measured.report(spark, tables).collect()))
    assert got == sorted(map(tuple, quality.run_checks(tables, rules).collect()))
    failures = {r[:3]: r[3] for r in got}
    assert failures["a", "k", "unique"] == 1 and failures["a", "v", "unique"] == 1
    assert failures["a", "v", "accepted_values"] == 2 and failures["a", "k", "not_null"] == 1
    assert failures["c", "n", "unique"] == 0 and len(got) == 8


def test_unique_checks_share_one_shuffle_of_values(spark):
    from pitchside.operators import quality

    tables = {m: spark.range(50).selectExpr("id AS x", "id % 7 AS y", "id AS z") for m in "abc"}
    df = quality.check_all_unique(tables, {m: ["x", "y", "z"] for m in tables})
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(model") == 2  # the values, then one row per check and task
    assert {(r.column_name, r.failures) for r in df.collect()} == {("x", 0), ("y", 7), ("z", 0)}


def test_distinct_counts_and_sketches(spark):
    from pitchside.operators import distinct

    # One key holds a third of the rows; most values come again.
    rows = spark.range(60_000).selectExpr(
        "IF(id % 3 = 0, 'hot', concat('k', id % 5)) AS k", "id % 7000 AS v", "id % 4 AS part"
    )
    exact = {r.k: r.n for r in distinct.distinct_counts(rows, ["k"], "v", "n").collect()}
    wanted = {r.k: len(set(r.vs)) for r in rows.groupBy("k").agg(F.collect_list("v").alias("vs")).collect()}
    assert exact == wanted
    sketches = distinct.distinct_sketches(rows, ["k", "part"], "v", "sketch")
    merged = distinct.merged_counts(sketches, ["k"], "sketch", "n").collect()
    near = distinct.distinct_counts(rows, ["k"], "v", "n", approximate=True).collect()
    for r in [*merged, *near]:
        assert abs(r.n / exact[r.k] - 1) < 0.06
