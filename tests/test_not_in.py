"""NOT IN with NULLs on either side, against SQL itself."""

from __future__ import annotations

import pytest

from pitchside.operators import keyed

VALUES = [1, 2, 2, 3, None, None]
LISTS = [[], [2], [2, None], [None], [7, 7], [1, 2, 3]]


def _frame(spark, values, name):
    return spark.createDataFrame([(x, i) for i, x in enumerate(values)], f"{name} INT, place INT")


def _wanted(values, listed):
    """The places of the rows that SQL's NOT IN keeps."""
    if not listed:
        return list(range(len(values)))
    if None in listed:
        return []
    return [i for i, x in enumerate(values) if x is not None and x not in listed]


@pytest.mark.parametrize("listed", LISTS)
def test_not_in(spark, listed):
    df, held = _frame(spark, VALUES, "k"), _frame(spark, listed, "held").select("held")
    df.createOrReplaceTempView("rows_of_values")
    held.createOrReplaceTempView("held_values")
    sql = spark.sql("SELECT * FROM rows_of_values WHERE k NOT IN (SELECT held FROM held_values)")
    got = sorted(r.place for r in keyed.not_in(df, "k", held).collect())
    assert got == sorted(r.place for r in sql.collect()) == _wanted(VALUES, listed)


@pytest.mark.parametrize("listed", LISTS)
@pytest.mark.parametrize("loaded", [None, [1, 2], [3, None], []])
def test_incremental_append(spark, listed, loaded):
    source, target = _frame(spark, VALUES, "k"), _frame(spark, listed, "k")
    among = None if loaded is None else _frame(spark, loaded, "k")
    got = keyed.incremental_append(target, source, "k", among)
    wanted = [i for i in _wanted(VALUES, listed) if loaded is None or VALUES[i] in loaded]
    assert got.columns == ["k", "place"]
    assert sorted(r.place for r in got.collect()) == wanted
    assert keyed.incremental_append(None, source, "k").count() == len(VALUES)


def test_plan_has_no_nested_loop(spark):
    """Both sides are shuffled by the key, and the list's NULLs are looked for once."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(1_000).selectExpr("id AS k")
        got = keyed.not_in(left, "k", spark.range(500).selectExpr("IF(id = 7, NULL, id) AS k"))
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        assert "BroadcastExchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got.count() == 0
