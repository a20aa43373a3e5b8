"""Calendar parts, all as plain column arithmetic inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_id(moment: Column) -> Column:
    """Date as the integer yyyymmdd."""
    return F.year(moment) * 10000 + F.month(moment) * 100 + F.dayofmonth(moment)


def iso_weekday(moment: Column) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return F.weekday(moment) + 1


def iso_week(moment: Column) -> Column:
    return F.weekofyear(moment)


def iso_year(moment: Column) -> Column:
    """Year the ISO week belongs to; 1 January may carry the year before."""
    return F.extract(F.lit("YEAROFWEEK"), moment)


def month_bounds(as_of: Column, months_back: int) -> tuple[Column, Column]:
    """First day of the month ``months_back`` before ``as_of``, and of the month after it."""
    first = F.trunc(F.add_months(as_of, -months_back), "MM")
    return first, F.add_months(first, 1)


def whole_days(start: Column, end: Column) -> Column:
    """Full 24-hour days from start to end; negative spans truncate towards zero."""
    return F.extract(F.lit("DAY"), end - start)
