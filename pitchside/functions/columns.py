"""Column helpers shared by the models."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def map_values(column: Column | str, mapping: Mapping[str, str]) -> Column:
    """Replace the listed values, pass every other value through."""
    column = _col(column)
    result = column
    for old, new in mapping.items():
        result = F.when(column == old, F.lit(new)).otherwise(result)
    return result


def count_when(predicate: Column) -> Column:
    """How many rows satisfy the predicate; a NULL predicate does not count."""
    return F.sum(F.when(predicate, 1).otherwise(0)).cast("long")


def rounded(value: Column, scale: int) -> Column:
    """Round a double half away from zero, as the decimal number that it stands for.

    The first rounding takes out what binary arithmetic adds behind the tenth place, so that an
    exact half is seen as one.
    """
    return F.round(F.round(value, 10), scale)


def ratio(num: Column, den: Column, scale: int = 2, factor: float = 1.0) -> Column:
    """``num / den * factor`` rounded to ``scale`` places; NULL when ``den`` is zero."""
    quotient = num.cast("double") / F.nullif(den, F.lit(0)).cast("double")
    return rounded(quotient * F.lit(float(factor)) if factor != 1.0 else quotient, scale)


def first_of(array: Column | str) -> Column:
    """First element, NULL for an empty or missing array."""
    return F.get(_col(array), F.lit(0))


def first_key(mapping: Column | str) -> Column:
    """First key in document order, NULL for an empty or missing map."""
    return first_of(F.map_keys(_col(mapping)))


def not_empty(array: Column | str) -> Column:
    """True when the array has an element, False when it is empty or missing."""
    return F.coalesce(F.size(_col(array)) > 0, F.lit(False))


def stripped(text: Column | str) -> Column:
    """Text without white space of any kind at either end; NULL becomes the empty text."""
    return F.regexp_replace(F.coalesce(_col(text), F.lit("")), r"(?U)^\s+|\s+$", "")


def joined_text(*parts: Column | str) -> Column:
    """The stripped parts with a blank between them, stripped again."""
    return stripped(F.concat_ws(" ", *[stripped(p) for p in parts]))


def utc_from_epoch(seconds: Column | str) -> Column:
    """Seconds since 1970 as a UTC timestamp without zone, whatever the session zone; NULL is 0."""
    elapsed = F.make_dt_interval(
        secs=F.coalesce(_col(seconds), F.lit(0)).cast("decimal(18,6)")
    )
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + elapsed


def utc_from_iso(text: Column | str) -> Column:
    """ISO-8601 text as a UTC timestamp without zone; text without an offset is taken as UTC."""
    text = _col(text)
    micros = F.unix_micros(text.try_cast("timestamp")).cast("decimal(24,6)") / F.lit(1_000_000)
    with_offset = F.when(micros.isNotNull(), utc_from_epoch(micros))
    return F.when(text.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), with_offset).otherwise(
        text.try_cast("timestamp_ntz")
    )


def utc_now() -> Column:
    """Current UTC time as a timestamp without zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.localtimestamp())


def row_as_json(*columns: str) -> Column:
    """The given columns as one JSON object, with NULL fields kept."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def ordered_listagg(value: Column | str, repeats: Column | str, sep: str = ", ") -> Column:
    """Sorted, separated list of values where each distinct value comes with its row count.

    The input is already grouped by value, so one entry per distinct value is collected, however
    many rows it stands for.
    """
    entries = F.sort_array(F.collect_list(F.struct(_col(value).alias("v"), _col(repeats).alias("n"))))
    spread = F.flatten(F.transform(entries, lambda e: F.array_repeat(e["v"], e["n"].cast("int"))))
    return F.array_join(spread, sep)
