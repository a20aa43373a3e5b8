"""Text to number: lenient where bad text becomes NULL, strict where it must stop the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lenient_float(text: Column) -> Column:
    return text.try_cast("float")


def lenient_int(text: Column) -> Column:
    """Integer part of a plain decimal number, so '2.0' gives 2; anything else gives NULL."""
    return F.regexp_extract(text, r"^\s*([+-]?\d+)(\.\d*)?\s*$", 1).try_cast("int")


def lenient_date(text: Column) -> Column:
    return text.try_cast("date")


def strict_double(text: Column) -> Column:
    """Double from text; raises on text that is not a number, in ANSI mode or not.

    Type suffixes such as '1.5d' are numbers to the JVM only, so they count as bad text.
    """
    number = F.when(~text.rlike(r"[0-9.][dDfF]\s*$"), text.try_cast("double"))
    return F.coalesce(
        number, F.raise_error(F.concat(F.lit("error converting to float: "), text)).cast("double")
    )
