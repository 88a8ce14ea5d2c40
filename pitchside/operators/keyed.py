"""Row sets of key-based loads.

Keys are non-null by contract (see plans.contracts), but for ``not_in`` and ``incremental_append``, which
follow SQL's three-valued logic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, functions as F


def _distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()


def insert_new_keys(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    counts: Observation | None = None,
) -> DataFrame:
    """Incoming rows whose key the table does not hold; append these.

    The table is first cut down to the keys that come in, so it is not shuffled when the incoming
    keys are few enough for Spark to broadcast them. ``counts`` receives the numbers ``incoming``
    and ``skipped`` when the rows are written.
    """
    held = existing.select(*keys).join(_distinct_keys(incoming, keys), list(keys), "left_semi")
    held = held.distinct()
    if counts is None:
        return incoming.join(held, list(keys), "left_anti").select(*incoming.columns)
    marked = incoming.join(held.withColumn("_held", F.lit(True)), list(keys), "left").observe(
        counts,
        F.count(F.lit(1)).alias("incoming"),
        F.count_if(F.col("_held").isNotNull()).alias("skipped"),
    )
    return marked.where(F.col("_held").isNull()).select(*incoming.columns)


def replace_by_key(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Table content after deleting all rows of the incoming keys and adding the incoming rows."""
    kept = existing.join(_distinct_keys(incoming, keys), list(keys), "left_anti")
    return kept.select(*existing.columns).unionByName(incoming.select(*existing.columns))


def _unlisted(values: DataFrame, listed: DataFrame) -> DataFrame:
    """Rows of the one-column ``values`` that are NOT IN the one column of ``listed``.

    SQL's rule: nothing is known to be missing from a list that holds a NULL, a NULL is missing from an
    empty list alone. Both are one fact about the whole list, so the rows meet only its other values, in
    an anti join that is broadcast or shuffled by size. ``NOT IN`` itself would be planned as a broadcast
    of the whole list, or as a nested loop.
    """
    (column,), (entry,) = values.columns, listed.columns
    entry_of = listed.select(F.col(entry).alias("_entry"))
    held = entry_of.where(F.col("_entry").isNotNull()).distinct()
    with_null = entry_of.where(F.col("_entry").isNull()).exists()
    some = entry_of.exists()
    unheld = values.join(held, F.col(column) == F.col("_entry"), "left_anti")
    return unheld.where(~with_null & (F.col(column).isNotNull() | ~some))


def not_in(df: DataFrame, column: str, listed: DataFrame) -> DataFrame:
    """Rows whose ``column`` is NOT IN the one column of ``listed``, NULLs as in SQL.

    The comparison runs on distinct values; whole rows meet only the list of missing ones.
    """
    values = df.select(F.col(column).alias("_missing")).distinct()
    missing = _unlisted(values, listed)
    return df.join(missing, F.col(column).eqNullSafe(F.col("_missing")), "left_semi")


def incremental_append(
    target: DataFrame | None, source: DataFrame, key: str, among: DataFrame | None = None
) -> DataFrame:
    """Source rows to append: all of them without a target, else those whose key it does not list.

    NULL keys follow ``NOT IN``: a NULL in the target lets nothing in, one in the source comes in only
    where the target is empty. ``among`` names the keys that a run has loaded, if the caller knows them:
    then only these are looked for, and neither side's keys are read as a whole where Spark can
    broadcast them.
    """
    if target is None:
        return source
    listed = target.select(key)
    if among is not None:
        loaded = among.select(F.col(key).alias("_loaded")).distinct()
        source = source.join(loaded, F.col(key).eqNullSafe(F.col("_loaded")), "left_semi")
        # NULLs decide for the whole list, so they stay in it.
        here = F.col(key).isNull() | F.col("_loaded").isNotNull()
        wanted = loaded.where(F.col("_loaded").isNotNull())
        listed = listed.join(wanted, F.col(key) == F.col("_loaded"), "left").where(here).select(key)
        if_empty = target.select(key).exists()
        # An empty list of the loaded keys is not yet an empty target.
        source = source.where(F.col(key).isNotNull() | ~if_empty)
    return not_in(source, key, listed).select(*source.columns)


def upsert_by_key(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Table content after updating the matched rows and inserting the others.

    ``source`` holds one row per key; a repeated key raises an error when the rows are read. Columns
    it lacks keep their value in updated rows and are NULL in inserted rows.
    """
    changed = [c for c in source.columns if c not in keys]
    repeated = F.raise_error(
        F.concat_ws(" ", F.lit("repeated key:"), *[F.col(k).cast("string") for k in keys])
    )
    update = (
        source.groupBy(*keys)
        .agg(F.count("*").alias("_times"), *[F.first(c).alias(f"_new_{c}") for c in changed])
        .withColumn("_hit", F.when(F.col("_times") > 1, repeated.cast("boolean")).otherwise(True))
    )
    new = {c: F.col(f"_new_{c}") for c in changed}
    return target.join(update, list(keys), "full").select(
        *[
            F.when(F.col("_hit"), new[c]).otherwise(F.col(c)).alias(c) if c in changed else F.col(c)
            for c in target.columns
        ]
    )
