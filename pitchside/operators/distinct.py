"""Distinct counts: exact ones, and sketches that can be stored and merged."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Logarithm of the sketch's buckets: 4,096 of them, a standard error of about 1.6 percent.
PRECISION = 12


def distinct_counts(
    df: DataFrame, keys: Sequence[str], column: str, out: str, approximate: bool = False
) -> DataFrame:
    """Distinct non-null values of ``column`` per key, however often rows repeat them.

    The exact count shuffles one row per key and value, so a hot key is spread over its values. An
    approximate one shuffles one sketch per key and task.
    """
    return df.groupBy(*keys).agg(distinct_of(column, approximate).alias(out))


def distinct_of(column: str, approximate: bool = False) -> Column:
    """Aggregate: distinct non-null values, exact unless asked otherwise."""
    if approximate:
        return F.hll_sketch_estimate(_sketch(F.col(column)))
    return F.count_distinct(column)


def _sketch(column: Column) -> Column:
    return F.hll_sketch_agg(column.cast("string"), F.lit(PRECISION))


def distinct_sketches(df: DataFrame, keys: Sequence[str], column: str, out: str) -> DataFrame:
    """A sketch of the values of ``column`` per key, to be stored beside other partial sums."""
    return df.groupBy(*keys).agg(_sketch(F.col(column)).alias(out))


def merged_counts(sketches: DataFrame, keys: Sequence[str], sketch: str, out: str) -> DataFrame:
    """Estimates per key from the sketches of its parts, whose values may overlap."""
    return sketches.groupBy(*keys).agg(
        F.hll_sketch_estimate(F.hll_union_agg(sketch)).alias(out)
    )
