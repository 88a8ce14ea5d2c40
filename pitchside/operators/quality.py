"""Declarative checks. Each gives rows (model, column_name, check_name, failures, passed)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F


@dataclass(frozen=True)
class Accepted:
    """Allowed values of a column, on the rows that satisfy ``where``."""

    column: str
    values: Sequence[str]
    where: str | None = None


@dataclass(frozen=True)
class Rules:
    """The checks declared for one model."""

    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    accepted: Sequence[Accepted] = field(default_factory=tuple)


def _null_failures(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def _accepted_failures(rule: Accepted) -> Column:
    bad = F.col(rule.column).isNotNull() & ~F.col(rule.column).isin(list(rule.values))
    return F.count_if(bad & F.expr(rule.where) if rule.where else bad)


def _report(df: DataFrame, model: str, failures: Mapping[tuple[str, str], Column]) -> DataFrame:
    """One aggregation over ``df`` for all checks, turned into one row per check."""
    checks = [
        F.struct(
            F.lit(model).alias("model"),
            F.lit(column).alias("column_name"),
            F.lit(check).alias("check_name"),
            F.coalesce(F.col(f"c{i}"), F.lit(0)).cast("long").alias("failures"),
        )
        for i, (column, check) in enumerate(failures)
    ]
    totals = df.agg(*[value.alias(f"c{i}") for i, value in enumerate(failures.values())])
    rows = totals.select(F.explode(F.array(*checks)).alias("r")).select("r.*")
    return rows.withColumn("passed", F.col("failures") == 0)


def check_not_null(df: DataFrame, cols: Sequence[str], model: str = "") -> DataFrame:
    """Rows with a NULL, for all columns in one pass."""
    return _report(df, model, {(c, "not_null"): _null_failures(c) for c in cols})


def check_accepted(
    df: DataFrame, column: str, values: Sequence[str], where: str | None = None, model: str = ""
) -> DataFrame:
    """Rows in scope whose value is not allowed; NULL is no value and does not fail."""
    rule = Accepted(column, values, where)
    return _report(df, model, {(column, "accepted_values"): _accepted_failures(rule)})


def check_unique(df: DataFrame, column: str, model: str = "") -> DataFrame:
    """Values that occur more than once; NULLs are left out."""
    return check_all_unique({model: df}, {model: [column]})


def _keyed(df: DataFrame, model: str, columns: Sequence[str]) -> DataFrame:
    """Each non-null value of the columns as a row (model, column_name, value), in one scan."""
    entries = [
        F.struct(F.lit(column).alias("column_name"), F.col(column).cast("string").alias("value"))
        for column in columns
    ]
    rows = df.select(F.explode(F.array(*entries)).alias("r")).where("r.value is not null")
    return rows.select(F.lit(model).alias("model"), "r.*")


def check_all_unique(
    tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]]
) -> DataFrame:
    """All unique checks by one grouping of (check, value) rows, whatever tables they come from.

    Rows of one value are counted where they are read, so a value that holds a third of a table is a few
    rows in the shuffle. A value is compared by its text. A check without any row still reports.
    """
    rows = reduce(DataFrame.unionByName, [_keyed(tables[m], m, cols) for m, cols in columns.items()])
    times = rows.groupBy("model", "column_name", "value").agg(F.count(F.lit(1)).alias("times"))
    # The second grouping has one row per check and task.
    failures = times.groupBy("model", "column_name").agg(F.count_if(F.col("times") > 1).alias("failures"))
    spark = rows.sparkSession
    declared = [(model, column) for model, some in columns.items() for column in some]
    wanted = spark.createDataFrame(declared, "model STRING, column_name STRING")
    # As many rows as there are checks.
    found = wanted.join(F.broadcast(failures), ["model", "column_name"], "left")
    return found.select(
        "model", "column_name", F.lit("unique").alias("check_name"),
        F.coalesce("failures", F.lit(0)).cast("long").alias("failures"),
    ).withColumn("passed", F.col("failures") == 0)


def _row_failures(rule: Rules) -> dict[tuple[str, str], Column]:
    """The checks that one pass over a table's rows decides."""
    found = {(column, "not_null"): _null_failures(column) for column in rule.not_null}
    return found | {(a.column, "accepted_values"): _accepted_failures(a) for a in rule.accepted}


def _unique_columns(rules: Mapping[str, Rules]) -> dict[str, Sequence[str]]:
    return {model: rule.unique for model, rule in rules.items() if rule.unique}


def run_checks(tables: Mapping[str, DataFrame], rules: Mapping[str, Rules]) -> DataFrame:
    """All declared checks: one scan per model, and one grouping for all unique columns."""
    reports = [
        _report(tables[model], model, _row_failures(rule))
        for model, rule in rules.items() if _row_failures(rule)
    ]
    unique = _unique_columns(rules)
    if unique:
        reports.append(check_all_unique({model: tables[model] for model in unique}, unique))
    return reduce(DataFrame.unionByName, reports)


class Measured:
    """Checks that are counted while tables are written.

    ``watch`` adds the counts of a model's row checks to a frame that is about to be written; ``report``
    reads them once all is written, so only the unique checks scan the tables again, together.
    """

    def __init__(self, rules: Mapping[str, Rules]):
        self.rules = rules
        self.seen: dict[str, tuple[Observation, list[tuple[str, str]]]] = {}

    def watch(self, df: DataFrame, model: str) -> DataFrame:
        failures = _row_failures(self.rules[model]) if model in self.rules else {}
        if not failures:
            return df
        self.seen[model] = (observed := Observation(), list(failures))
        return df.observe(
            observed, *[value.alias(f"c{i}") for i, value in enumerate(failures.values())]
        )

    def report(self, spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
        """Rows as ``run_checks`` gives them for ``tables``; models not watched are scanned."""
        rows = []
        for model, (observed, checks) in self.seen.items():
            counts = observed.get
            rows += [
                (model, column, check, int(counts.get(f"c{i}") or 0))
                for i, (column, check) in enumerate(checks)
            ]
        schema = "model STRING, column_name STRING, check_name STRING, failures LONG"
        measured = spark.createDataFrame(rows, schema).withColumn("passed", F.col("failures") == 0)
        here = {model: rule for model, rule in self.rules.items() if model in tables}
        rest = {
            model: replace(rule, not_null=(), accepted=()) if model in self.seen else rule
            for model, rule in here.items()
        }
        rest = {model: rule for model, rule in rest.items() if rule != Rules()}
        return measured.unionByName(run_checks(tables, rest)) if rest else measured
