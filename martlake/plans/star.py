"""The star schema: dimension extracts, the date dimension, the sales facts."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake import schemas
from martlake.functions.calendar import date_id, iso_week, iso_weekday, iso_year
from martlake.operators.quality import check_unique
from martlake.operators.upsert import require_keys
from martlake.session import scratch_path, stored
from martlake.sources.files import delete


def date_series(spark: SparkSession, start: str, days: int) -> DataFrame:
    """``days`` + 1 consecutive dates, both ends included."""
    first = F.lit(datetime.date.fromisoformat(start))
    return spark.range(0, days + 1).select(F.date_add(first, F.col("id").cast("int")).alias("date"))


def build_date_dim(spark: SparkSession, start: str = "2010-01-01", days: int = 5000) -> DataFrame:
    day = F.col("date")
    return date_series(spark, start, days).select(
        date_id(day).alias("date_id"),
        day,
        iso_year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day_of_month"),
        iso_week(day).alias("week_of_year"),
        iso_weekday(day).alias("day_of_week"),
    )


def build_customer_dim(customer: DataFrame) -> DataFrame:
    return customer.select(*schemas.STAR["customer_dim"].fieldNames())


def build_staff_dim(staff: DataFrame) -> DataFrame:
    return staff.select(*schemas.STAR["staff_dim"].fieldNames())


def build_film_dim(film: DataFrame) -> DataFrame:
    return film.select(*schemas.STAR["film_dim"].fieldNames())


def build_sales_facts(
    payment: DataFrame, rental: DataFrame, inventory: DataFrame, strict: bool = False
) -> DataFrame:
    """Distinct payments by film, customer, staff and day.

    Equal payments on one key collapse. Different amounts on one key stay as several rows;
    ``strict`` raises on them instead, whichever columns are read later.
    """
    lines = (
        _payment_days(payment)
        .join(rental.select("rental_id", "inventory_id"), "rental_id")
        .join(inventory.select("inventory_id", "film_id"), "inventory_id")
    )
    return distinct_facts(lines, strict)


def stored_sales_lines(payment: DataFrame, rental: DataFrame, inventory: DataFrame, *more: str) -> DataFrame:
    """The columns of the facts for every payment, equal ones as often as they come, with ``more`` columns of the inventory.

    For facts that are read more than once. Payments look up their rental, and rentals, which are narrower, their item before.
    Each step is stored, so that the disk holds the shuffles of one, and of the copies only the last stays.
    """
    spark = payment.sparkSession
    film_path, day_path, line_path = (scratch_path(spark, name) for name in ("films", "payment-days", "sales-lines"))
    items = rental.select("rental_id", "inventory_id").join(inventory.select("inventory_id", "film_id", *more), "inventory_id")
    films = stored(items.select("rental_id", "film_id", *more), film_path)
    lines = stored(_payment_days(payment), day_path).join(films, "rental_id")
    lines = stored(lines.select(*schemas.STAR["sales_facts"].fieldNames(), *more), line_path)
    for path in (film_path, day_path):
        delete(spark, path)
    return lines


def distinct_facts(lines: DataFrame, strict: bool = False) -> DataFrame:
    """The facts of sales lines; ``strict`` as in ``build_sales_facts``."""
    facts = lines.select(*schemas.STAR["sales_facts"].fieldNames()).distinct()
    if strict:
        require_keys(facts, schemas.STAR_KEYS["sales_facts"], "sales_facts")
    return facts


def _payment_days(payment: DataFrame) -> DataFrame:
    return payment.select("rental_id", "customer_id", "staff_id", date_id(F.col("payment_date")).alias("date_id"), "amount")


def fact_key_conflicts(facts: DataFrame) -> DataFrame:
    """Fact keys with more than one amount."""
    return check_unique(facts, schemas.STAR_KEYS["sales_facts"])
