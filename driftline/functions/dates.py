"""Dates, months and numeric coercion as Column expressions.

Timestamps are wall-clock UTC (``timestamp_ntz``), so results do not depend on
the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_utc(text: Column) -> Column:
    """ISO-8601 text (with or without a trailing Z) to a timestamp, bad -> null."""
    return text.try_cast("timestamp_ntz")


def month_start(ts: Column) -> Column:
    return F.trunc(F.to_date(ts), "month")


def from_parts(year: Column, month: Column) -> Column:
    return F.make_date(year.cast("int"), month.cast("int"), F.lit(1))


def stamp_to_date(stamp: Column) -> Column:
    """``YYYYMMDD..`` text to a date, bad -> null."""
    return F.try_to_date(F.substring(stamp, 1, 8), "yyyyMMdd")


def numeric(text: Column, kind: str = "double") -> Column:
    return text.try_cast(kind)


def first_sunday(day: Column) -> Column:
    """The Sunday on or after ``day``."""
    return F.date_add(day, F.pmod(F.lit(1) - F.dayofweek(day), F.lit(7)))


def week_label(day: Column, anchor: Column, weeks: int) -> Column:
    """Right-closed, right-labelled bin of ``weeks`` weeks; ``anchor`` is a Sunday."""
    span = 7 * weeks
    steps = F.ceil(F.datediff(day, anchor) / F.lit(span)).cast("int")
    return F.date_add(anchor, steps * F.lit(span))
