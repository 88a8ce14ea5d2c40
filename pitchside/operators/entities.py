"""Entity lists, surrogate keys and role joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from pitchside.session import stored


def entity_union(df: DataFrame, cols: Sequence[str], name: str) -> DataFrame:
    """Distinct non-null values found in any of ``cols``, read in a single scan."""
    return (
        df.select(F.explode(F.array(*cols)).alias(name))
        .where(F.col(name).isNotNull())
        .distinct()
    )


def surrogate_key(df: DataFrame, order_col: str, id_name: str) -> DataFrame:
    """Dense ids 1..n in the order of ``order_col``, whose values are unique.

    The rows are partitioned by ranges of the order and sorted; each task numbers its own range as it
    writes it to scratch, so a recomputed task cannot see another split. Then the row counts of the
    ranges before it are added to a row's number. The rows are shuffled once, and written once.
    """
    at, part = "_at", "_range"
    split = stored(
        df.repartitionByRange(order_col)
        .sortWithinPartitions(order_col)
        .withColumn(at, F.monotonically_increasing_id()),
        "ranges",
    )
    # The number holds the partition above its low 33 bits and the place in it below.
    split = split.withColumn(part, F.shiftright(at, 33))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    # One row per range, so both this window and the broadcast hold at most as many rows.
    offsets = (
        split.groupBy(part)
        .count()
        .select(part, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    )
    place = F.col(at).bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return split.join(F.broadcast(offsets), part).select(
        (place + F.col("_offset")).cast("long").alias(id_name), *df.columns
    )


def hot_keys(fact: DataFrame, roles: Sequence[str], share: float = 0.05) -> dict[str, list]:
    """Per role column, the values that hold at least ``share`` of the rows.

    One pass counts all roles, reduced where it reads; no more than ``1 / share`` values a role come
    back.
    """
    cells = [F.struct(F.lit(r).alias("role"), F.col(r).cast("string").alias("value")) for r in roles]
    counted = (
        fact.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
        .groupBy("role", "value").agg(F.count(F.lit(1)).alias("rows"))
    )
    # Each role has as many cells as there are rows.
    total = fact.count()
    found: dict[str, list] = {role: [] for role in roles}
    for row in counted.where(F.col("value").isNotNull() & (F.col("rows") >= share * total)).collect():
        found[row["role"]].append(row["value"])
    return found


def role_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    id_col: str,
    roles: Mapping[str, str],
    hot: Mapping[str, Sequence] | None = None,
    copies: int = 32,
) -> DataFrame:
    """Left join one dimension in several roles: ``{fact column: id alias}``.

    No broadcast hint: Spark broadcasts the dimension when its stored or measured size is below
    its threshold, and otherwise shuffles with the adaptive split of hot keys.

    ``hot`` (from ``hot_keys``) spreads the roles it names ahead of that: rows of a hot value are dealt
    over so many ``copies`` of its dimension row, and rows without a value, which find none, over as
    many partitions, instead of meeting in one. The deal is by a hash of the whole row, so a task that
    runs again deals alike.
    """
    for role, alias in roles.items():
        side = dim.select(F.col(key).alias(role), F.col(id_col).alias(alias))
        if hot is None or role not in hot:
            fact = fact.join(side, role, "left")
            continue

        def is_hot(value: Column) -> Column:
            return F.coalesce(value.cast("string").isin(list(hot[role])), F.lit(False))

        dealt = F.pmod(F.xxhash64(*fact.columns), F.lit(copies)).cast("int")
        spread = F.when(F.col(role).isNull() | is_hot(F.col(role)), dealt).otherwise(0)
        places = F.when(is_hot(F.col(role)), F.sequence(F.lit(0), F.lit(copies - 1))).otherwise(
            F.array(F.lit(0))
        )
        side = side.where(F.col(role).isNotNull()).withColumn("_copy", F.explode(places))
        fact = fact.withColumn("_copy", spread).join(side, [role, "_copy"], "left").drop("_copy")
    return fact


def unpivot_roles(
    df: DataFrame, role_cols: Sequence[str], out: str, keep: Sequence[str]
) -> DataFrame:
    """One row per role column, duplicates kept, in a single scan."""
    return df.select(F.explode(F.array(*role_cols)).alias(out), *keep)
