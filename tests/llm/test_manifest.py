"""The Merkle manifest against a plain tree, with trees of all shapes."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pitchside.llm import manifest
from pitchside.llm.common import Scratch
from tests.llm import brute

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def told(df) -> list[tuple]:
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("sizes", [[0], [1], [8], [9, 1], [65, 64, 7], [2, 600, 1]])
def test_trees(spark, sizes):
    rows = [
        (100 * i + nth, f"s{i % 3}", name, i, f"Text {i} ÄB" if i % 5 else None)
        for nth, n in enumerate(sizes)
        for name in [None if nth == 1 else "xyz"[nth]]
        for i in range(n)
    ]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert told(manifest.manifest_report(df)) == sorted(brute.manifest(rows), key=str)


def test_many_groups_repeats_and_nulls(spark):
    rows = [(i, None, f"g{i % 70}", None, "A") for i in range(200)]
    rows += [(7, "a", "g1", 1, "Twice"), (7, "a", "g1", 1, "Twice"), (7, "b", "g1", 1, "Other")]
    rows += [(None, None, None, None, None), (None, "x", "", 3, ""), (5, "x", "é", 3, "")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("digest", F.lit("clashes"))
    found = told(manifest.manifest_report(df))
    assert found == sorted(brute.manifest(rows), key=str)
    assert len({r[3] for r in found}) == 1


def test_any_change_is_seen(spark):
    rows = [(i, "s", "en", 3, "lower case only") for i in range(30)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert all(r["verified"] for r in manifest.manifest_report(df).collect())
    upper = spark.createDataFrame([(*r[:4], "Upper") for r in rows], SCHEMA)
    verdicts = {r["doc_id"]: r["verified"] for r in manifest.manifest_report(upper).collect()}
    assert verdicts == {r[0]: r[6] for r in brute.manifest([(*r[:4], "Upper") for r in rows])}
    assert set(verdicts.values()) == {True, False}


def test_nodes_cover_their_intervals(spark):
    scratch = Scratch(spark)
    rows = spark.range(100).selectExpr("id as lo", "'t' as tree", "100L as n", "cast(id as string) as digest")
    built = manifest.forest(scratch.store(rows, "leaves"), "tree", scratch)
    assert [x.count() for x in built.levels] == [100, 13, 2, 1]
    (last,) = built.levels[1].where("lo = 96").collect()
    assert (last["hi"], len(last["children"])) == (100, 4)
    scratch.clear()
