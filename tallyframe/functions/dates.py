"""Dates: lenient and strict parsing, periods, calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Short period codes and the unit they truncate to.
PERIODS = {"D": "day", "W": "week", "M": "month", "Q": "quarter", "Y": "year"}


def parse_date(c: Column, strict: bool = False, fmt: str | None = None) -> Column:
    """Text (or date/timestamp) as timestamp. Lenient: bad text is NULL. Strict: bad text raises."""
    if strict:
        return F.to_timestamp(c, fmt) if fmt else F.to_timestamp(c)
    return F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)


def period_start(c: Column, freq: str = "M") -> Column:
    """First day of the period that holds ``c``; ``freq`` is a short code or a unit name."""
    return F.to_date(F.date_trunc(PERIODS.get(freq, freq), c))


def month_of(c: Column) -> Column:
    return F.month(c)


def weekday_of(c: Column) -> Column:
    """Day of the week with Monday = 0."""
    return F.weekday(c)
