from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from pitchside.functions.columns import (
    count_when, first_key, map_values, not_empty, ordered_listagg, ratio,
)
from pitchside.operators import entities, keyed, picks, quality


def _set(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("ranges", ["1", "7", "100"])
def test_surrogate_key_is_dense_in_any_number_of_ranges(spark, ranges):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    names = [f"n{i * 7919 % 997}" for i in range(300)]
    df = spark.createDataFrame([(n,) for n in names], ["name"]).repartition(5)
    try:
        got = entities.surrogate_key(df, "name", "id").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {r.name: r.id for r in got} == {n: i + 1 for i, n in enumerate(sorted(names))}
    assert len(got) == len(names)


def test_entity_union_drops_null_and_duplicates(spark):
    df = spark.createDataFrame([("a", "b"), ("b", None), ("a", "c")], ["x", "y"])
    assert _set(entities.entity_union(df, ["x", "y"], "n")) == [("a",), ("b",), ("c",)]


def test_role_join_keeps_rows_without_partner(spark):
    fact = spark.createDataFrame([(1, "a", "b"), (2, None, "z")], "id INT, p STRING, q STRING")
    dim = spark.createDataFrame([("a", 10), ("b", 20)], ["name", "key"])
    got = entities.role_join(fact, dim, "name", "key", {"p": "p_id", "q": "q_id"})
    assert _set(got.select("id", "p_id", "q_id")) == [(1, 10, 20), (2, None, None)]


def test_unpivot_roles_keeps_duplicates(spark):
    df = spark.createDataFrame([(1, "a", "a")], ["m", "x", "y"])
    assert _set(entities.unpivot_roles(df, ["x", "y"], "t", ["m"])) == [("a", 1), ("a", 1)]


def test_latest_and_best_against_brute_force(spark):
    rng = random.Random(5)
    # One key holds a third of the rows.
    rows = [
        (0 if i % 3 == 0 else rng.randrange(20), rng.randrange(9), rng.randrange(30), i)
        for i in range(900)
    ]
    df = spark.createDataFrame(rows, ["k", "w", "r", "i"]).repartition(6)
    latest, best = {}, {}
    for k, w, r, i in rows:
        latest[k] = max(latest.get(k, (-1, -1)), (w, i))
        best[k] = max(best.get(k, (-1, -99)), (w, -r))
    got = picks.latest_per_key(df, ["k"], ["w", "i"])
    assert {r.k: (r.w, r.i) for r in got.collect()} == latest
    got = picks.best_pair(df, ["k"], "best", "w", "r")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert {r.k: r.best for r in got.collect()} == {k: f"{w}/{-r}" for k, (w, r) in best.items()}
    got = df.groupBy("k").agg(picks.best_value(F.col("w"), F.col("r")).alias("b"))
    assert {r.k: (r.b.most, -r.b.least) for r in got.collect()} == best


def test_latest_per_key_reduces_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 3).alias("k"), "id")
    plan = picks.latest_per_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_insert_new_keys_is_idempotent(spark):
    table = spark.createDataFrame([(1, "old"), (2, "old")], ["k", "v"])
    incoming = spark.createDataFrame([(2, "new"), (3, "new")], ["k", "v"])
    once = table.unionByName(keyed.insert_new_keys(table, incoming, ["k"]))
    assert _set(once) == [(1, "old"), (2, "old"), (3, "new")]
    assert keyed.insert_new_keys(once, incoming, ["k"]).count() == 0


def test_replace_by_key_is_idempotent(spark):
    table = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], ["k", "v"])
    incoming = spark.createDataFrame([(1, "x"), (3, "y")], ["k", "v"])
    once = keyed.replace_by_key(table, incoming, ["k"])
    assert _set(once) == [(1, "x"), (2, "c"), (3, "y")]
    assert _set(keyed.replace_by_key(once, incoming, ["k"])) == _set(once)
    assert _set(keyed.replace_by_key(table, incoming.limit(0), ["k"])) == _set(table)


def test_incremental_append(spark):
    source = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "k INT, v STRING")
    assert keyed.incremental_append(None, source, "k").count() == 4
    target = source.where("k = 1")
    new = keyed.incremental_append(target, source, "k")
    assert _set(new) == [(2, "b"), (2, "c")]
    assert keyed.incremental_append(target.unionByName(new), source, "k").count() == 0


def test_upsert_updates_also_to_null_and_keeps_other_columns(spark):
    schema = "a INT, b STRING, at INT, status STRING, note STRING"
    target = spark.createDataFrame([(1, "x", 5, "OK", "n"), (2, "x", 6, "OK", "m")], schema)
    source = spark.createDataFrame(
        [(1, "x", 9, None), (3, "y", 7, "OK")], "a INT, b STRING, at INT, status STRING"
    )
    once = keyed.upsert_by_key(target, source, ["a", "b"])
    want = [(1, "x", 9, None, "n"), (2, "x", 6, "OK", "m"), (3, "y", 7, "OK", None)]
    assert _set(once) == want
    assert _set(keyed.upsert_by_key(once, source, ["a", "b"])) == want


def test_upsert_raises_on_a_repeated_source_key(spark):
    target = spark.createDataFrame([(1, "x")], "a INT, b STRING")
    source = spark.createDataFrame([(1, "y"), (1, "z")], "a INT, b STRING")
    with pytest.raises(Exception, match="repeated key: 1"):
        keyed.upsert_by_key(target, source, ["a"]).collect()


def test_best_value_with_numbers_below_zero(spark):
    df = spark.createDataFrame([(-1, 5), (-1, -7), (-3, 0), (None, 1)], "w INT, r INT")
    best = df.agg(picks.best_value(F.col("w"), F.col("r")).alias("b")).first().b
    assert (best.most, best.least) == (-1, -7)


def test_column_helpers(spark):
    df = spark.createDataFrame(
        [("2007/08", 1, 0, '{"b": 1, "a": 2}', [1]), ("2011", 2, 3, "{}", []),
         (None, 5, 2, None, None)],
        "s STRING, n INT, d INT, m STRING, l ARRAY<INT>",
    ).withColumn("m", F.from_json("m", "map<string,int>"))
    rows = df.select(
        map_values("s", {"2007/08": "2008"}),
        ratio(F.col("n"), F.col("d"), 2, 100),
        first_key("m"),
        not_empty("l"),
    ).collect()
    assert [tuple(r) for r in rows] == [
        ("2008", None, "b", True), ("2011", 66.67, None, False), (None, 250.0, None, False),
    ]
    assert df.agg(count_when(F.col("s") == "2011")).first()[0] == 1


def test_ordered_listagg_keeps_duplicates(spark):
    df = spark.createDataFrame([("t", "b", 2), ("t", "a", 1), ("t", "c", 3)], ["k", "v", "n"])
    got = df.groupBy("k").agg(ordered_listagg("v", "n").alias("l")).first().l
    assert got == "a, b, b, c, c, c"


def test_checks_count_failures(spark):
    df = spark.createDataFrame(
        [("a", "x"), ("a", None), ("b", "y"), (None, "x"), (None, "z")], ["k", "v"]
    )
    rules = {
        "m": quality.Rules(
            not_null=["k", "v"],
            unique=["k"],
            accepted=[quality.Accepted("v", ["x"], "k is not null")],
        )
    }
    got = {(r.column_name, r.check_name): (r.failures, r.passed)
           for r in quality.run_checks({"m": df}, rules).collect()}
    assert got == {
        ("k", "not_null"): (2, False),
        ("v", "not_null"): (1, False),
        ("v", "accepted_values"): (1, False),
        ("k", "unique"): (1, False),
    }
    assert quality.check_not_null(df.where("k is not null"), ["k"]).first().passed
    assert quality.check_accepted(df, "v", ["x", "y", "z"]).first().passed
    assert quality.check_unique(df.limit(0), "k").first().passed


def test_declared_checks_are_complete():
    from pitchside.plans.contracts import RULES

    assert sum(len(r.not_null) for r in RULES.values()) == 69
    assert sum(len(r.unique) for r in RULES.values()) == 12
    assert sum(len(r.accepted) for r in RULES.values()) == 5


def test_ratio_rounds_like_exact_arithmetic(spark):
    from decimal import ROUND_HALF_UP, Decimal, localcontext

    pairs = [(a, b) for a in range(1, 260) for b in range(1, 260)]
    df = spark.createDataFrame(pairs, "a INT, b INT").select(
        "a",
        "b",
        ratio(F.col("a"), F.col("b"), 2).alias("plain"),
        ratio(F.col("a"), F.col("b"), 2, 100).alias("percent"),
    )
    cent = Decimal("0.01")
    with localcontext() as context:
        context.prec = 60
        for a, b, plain, percent in df.collect():
            exact = Decimal(a) / b
            assert plain == float(exact.quantize(cent, ROUND_HALF_UP)), (a, b)
            assert percent == float((exact * 100).quantize(cent, ROUND_HALF_UP)), (a, b)
