"""Statistics over the hourly array of one weather day, with higher-order functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martlake.functions.numbers import strict_double


def hourly_numbers(hourly: Column, field: str) -> Column:
    """Usable numbers of one field: missing and empty text skipped, NaN skipped, bad text raises."""
    filled = F.filter(hourly, lambda hour: F.coalesce(hour[field] != "", F.lit(False)))
    numbers = F.transform(filled, lambda hour: strict_double(hour[field]))
    return F.filter(numbers, lambda number: ~F.isnan(number))


def _or_nan(numbers: Column, value: Column) -> Column:
    """NULL array gives NULL, an array without a number gives NaN; 32-bit result."""
    return F.when(F.size(numbers) > 0, value).when(F.size(numbers) == 0, F.lit(float("nan"))).cast("float")


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0.0), lambda total, number: total + number)


def mean_of(numbers: Column) -> Column:
    return _or_nan(numbers, _total(numbers) / F.size(numbers))


def min_of(numbers: Column) -> Column:
    return _or_nan(numbers, F.array_min(numbers))


def max_of(numbers: Column) -> Column:
    return _or_nan(numbers, F.array_max(numbers))


def sum_of(numbers: Column) -> Column:
    return _or_nan(numbers, _total(numbers))
