"""Value coercion, lookups, outlier flags and message severity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hearthlake.schemas import ROOM_NAMES, SENSOR_BOUNDS, SEVERITY_PATTERNS


def number_sql(raw: str) -> str:
    """SQL for the double of a value given as text: JSON booleans count as 1 and 0, unreadable text gives null.

    A trailing Java float suffix (``12d``) is no number in a payload, although a plain cast takes it for one.
    """
    return (
        f"CASE {raw} WHEN 'true' THEN 1D WHEN 'false' THEN 0D "
        f"ELSE CASE WHEN NOT rlike({raw}, '[0-9.][dDfF] *$') THEN try_cast({raw} AS DOUBLE) END END"
    )


def to_number(raw: Column) -> Column:
    """Double of a text cell by the plain rules, without booleans; unreadable text gives null."""
    return F.when(~raw.rlike(r"[0-9.][dDfF]\s*$"), raw.try_cast("double"))


def normalise(value: Column, mapping: dict[str, str]) -> Column:
    """``mapping[value]``, or ``value`` itself where the mapping has no entry."""
    changed = {raw: name for raw, name in mapping.items() if raw != name}
    if not changed:
        return value
    result = F
    for raw, name in changed.items():
        result = result.when(value == raw, F.lit(name))
    return result.otherwise(value)


def room_name(raw: Column) -> Column:
    return normalise(raw, ROOM_NAMES)


def outside(value: Column, low: float, high: float) -> Column:
    """True outside the inclusive range; NaN is outside, null is not."""
    return F.coalesce(~value.between(low, high), F.lit(False))


def is_outlier(key: Column, value: Column, bounds: dict[str, tuple[float, float]] = SENSOR_BOUNDS) -> Column:
    """Flag ``value`` by the range listed for ``key``; keys without a range are never outliers."""
    result = F
    for name, (low, high) in bounds.items():
        result = result.when(key == name, outside(value, low, high))
    return result.otherwise(F.lit(False))


def severity(message: Column) -> Column:
    """high / medium / low by the first pattern found anywhere in the message."""
    text = F.lower(message)
    result = F
    for level, pattern in SEVERITY_PATTERNS:
        result = result.when(text.rlike(pattern), F.lit(level))
    return result.otherwise(F.lit("low"))


def blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def by_pattern(value: Column, patterns: dict[str, str]) -> Column:
    """Name of the first entry whose lower-case pattern occurs in ``value``, ignoring case; else null."""
    if not patterns:
        return F.lit(None).cast("string")
    text = F.lower(F.coalesce(value, F.lit("")))
    result = F
    for pattern, name in patterns.items():
        result = result.when(text.contains(pattern.lower()), F.lit(name))
    return result


def wh_to_kwh(value: Column) -> Column:
    return value / 1000.0
