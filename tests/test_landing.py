"""Files at their recorded paths, and role joins with hot and missing keys."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from pitchside.operators import entities
from pitchside.sinks.landing import UNNAMED, land_files, read_landed


def _files(root):
    return sorted(
        os.path.relpath(os.path.join(at, name), root) for at, _, names in os.walk(root) for name in names
    )


def test_one_file_at_each_recorded_path(spark, tmp_path):
    root = str(tmp_path / "landing")
    # One file holds a third of the rows; some rows name none.
    rows = spark.range(900).selectExpr(
        "id",
        "CASE WHEN id % 3 = 0 THEN 'raw/hot.json' WHEN id % 50 = 1 THEN NULL"
        " ELSE concat('raw/', id % 4, '/', id % 7, '.json') END AS file",
        "IF(id % 5 = 0, NULL, 'text \\n \"ß\"') AS body",
    ).repartition(6)
    wanted = {r.file or UNNAMED: r["count"] for r in rows.groupBy("file").count().collect()}
    for _ in range(2):  # a batch that runs again replaces its files
        told = land_files(rows, root, "file", ["id", "body"])
        assert {r.file: r.rows for r in told.collect()} == wanted
        assert _files(root) == sorted(wanted)
    for name in wanted:
        with open(f"{root}/{name}") as file:
            held = json.load(file)
        assert len(held) == wanted[name] and set(held[0]) == {"id", "body"}
    landed = read_landed(spark, root, "id LONG, body STRING", "file")
    again = landed.join(rows.select("id", F.coalesce("file", F.lit(UNNAMED)).alias("file"), "body"),
                        ["id", "file"]).where(landed.body.eqNullSafe(rows.body))
    assert landed.count() == again.count() == 900


def test_a_lost_attempt_leaves_no_landed_file(spark, tmp_path):
    root = str(tmp_path / "landing")
    bad = spark.range(40).selectExpr(
        "id", "'a.json' AS file", "IF(id = 7, raise_error('lost'), 'x') AS body"
    )
    with pytest.raises(Exception, match="lost"):
        land_files(bad, root, "file", ["id", "body"])
    assert [x for x in _files(root) if not os.path.basename(x).startswith("_")] == []
    assert land_files(spark.range(0).selectExpr("id", "'a' AS file"), root, "file", ["id"]).count() == 0


def test_hot_and_missing_keys_are_dealt_over_partitions(spark):
    """Half of the rows have no winner and a third have the same one: no partition holds most of them."""
    fact = spark.range(6_000).selectExpr(
        "id", "CASE WHEN id % 2 = 0 THEN NULL WHEN id % 3 > 0 THEN 'hot' ELSE concat('t', id % 40) END AS w"
    )
    dim = spark.createDataFrame([("hot", 1), *[(f"t{i}", i + 2) for i in range(40)]], "name STRING, id_ INT")
    dim = dim.unionByName(spark.createDataFrame([(None, 99)], dim.schema))
    hot = entities.hot_keys(fact, ["w"], 0.1)
    assert hot == {"w": ["hot"]}
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)

        def largest(**how):
            joined = entities.role_join(fact, dim, "name", "id_", {"w": "w_id"}, **how)
            rows = {(r.id, r.w, r.w_id) for r in joined.collect()}
            sizes = joined.groupBy(F.spark_partition_id()).count().collect()
            return rows, max(r["count"] for r in sizes)

        plain, most = largest()
        dealt, less = largest(hot=hot)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert plain == dealt and len(plain) == 6_000
    assert most >= 3_000 and less < 1_000
