"""One row per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order_cols`` per key.

    The filter on the row number lets Spark keep one row per key in each task before the shuffle,
    so a hot key is reduced where it is read.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order_cols])
    return df.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1").drop("_rn")


#: Above this, and below zero less this, the second number of ``best_value`` can't be.
HALF = 1 << 31


def best_value(desc: Column, asc: Column) -> Column:
    """Aggregate: the pair with the greatest ``desc`` and, among those, the least ``asc``.

    Both are whole numbers of 32 bits. Together they make one long, so that the maximum is a hash
    aggregate without a sort. The result has the fields ``most`` and ``least``; a pair with a NULL
    does not count.
    """
    best = F.max(desc.cast("long") * F.lit(2 * HALF) + (F.lit(HALF) - asc.cast("long")))
    most = F.shiftright(best, 32)
    return F.struct(
        most.alias("most"), (F.lit(HALF) - (best - most * F.lit(2 * HALF))).alias("least")
    )


def best_pair(
    df: DataFrame, keys: Sequence[str], out: str, desc: str, asc: str, between: str = "/"
) -> DataFrame:
    """The best pair per key as text: greatest ``desc``, then least ``asc``."""
    best = df.groupBy(*keys).agg(best_value(F.col(desc), F.col(asc)).alias("_best"))
    pair = F.concat_ws(
        between, F.col("_best.most").cast("string"), F.col("_best.least").cast("string")
    )
    return best.select(*keys, F.when(F.col("_best.most").isNotNull(), pair).alias(out))
