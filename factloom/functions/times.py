"""Time expressions over UTC timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_ms(ts: Column) -> Column:
    """YYYY-MM-DDTHH:mm:ss.SSSZ."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def from_any(value: Column, zone: str = "UTC") -> Column:
    """A timestamp from epoch seconds or a parseable string (its own offset first, else the zone), milliseconds kept; null if neither."""
    text = value.cast("string")
    number = text.try_cast("double")
    parsed = F.coalesce(F.try_to_timestamp(text), F.try_to_timestamp(F.concat(text, F.lit(" UTC"))))
    zoned = F.when(text.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), parsed).otherwise(F.to_utc_timestamp(parsed, zone))
    return F.date_trunc("millisecond", F.coalesce(F.timestamp_micros((number * 1_000_000).cast("long")), zoned))


def window_start(unit: str, ts: Column) -> Column:
    """Start of the month, quarter or year."""
    return F.date_trunc(unit, ts)


def window_end(unit: str, start: Column) -> Column:
    """Exclusive end of the window that starts there."""
    months = {"month": 1, "quarter": 3, "year": 12}[unit]
    return start + F.make_interval(months=F.lit(months))


def window_label(unit: str, start: Column) -> Column:
    """March 2024, Q1 2024 or 2024."""
    if unit == "month":
        return F.date_format(start, "MMMM yyyy")
    if unit == "quarter":
        return F.concat(F.lit("Q"), F.quarter(start).cast("string"), F.lit(" "), F.year(start).cast("string"))
    return F.year(start).cast("string")


def last_ms(unit: str, ts: Column) -> Column:
    """Last millisecond of the unit that holds ts."""
    start = F.date_trunc(unit, ts)
    step = {"day": F.make_interval(days=F.lit(1)), "week": F.make_interval(weeks=F.lit(1)), "month": F.make_interval(months=F.lit(1)), "year": F.make_interval(years=F.lit(1))}[unit]
    return start + step - F.expr("interval 1 millisecond")


def earlier(a: Column, b: Column) -> Column:
    """The earlier of two moments; an unknown one gives way."""
    return F.least(a, b)


def compared(a: Column, b: Column) -> Column:
    """-1, 0 or 1 as a is before, at or after b; unknown moments come last and equal one another."""
    return F.when(a.eqNullSafe(b), 0).when(a.isNull(), 1).when(b.isNull() | (a < b), -1).otherwise(1)


def localised(ts: Column, zone: str = "Europe/Berlin") -> Column:
    """A UTC moment on the clocks of a zone."""
    return F.from_utc_timestamp(ts, zone)
