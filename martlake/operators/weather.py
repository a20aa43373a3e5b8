"""Nested hourly weather days: one shape out of three, clean columns, gaps in the calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlake import schemas
from martlake.functions.hourly import hourly_numbers, max_of, mean_of, min_of, sum_of
from martlake.functions.numbers import lenient_date, lenient_float, lenient_int

DAY_FIELDS = schemas.RAW_DAY.fieldNames()
PREVIEW = ["date", "mintempF", "avgtempF", "maxtempF", "avgHumidity", "avgPressure", "totalPrecipMM"]


def normalise_days(raw: DataFrame) -> DataFrame:
    """Bare day rows from whole replies, replies without their envelope, and bare days.

    A reply with no day gives no row; ``landing.rejected`` lists those.
    """
    bare = F.array(F.struct(*DAY_FIELDS))
    listed = F.coalesce(F.col("data.weather"), F.col("weather"), bare)
    days = F.explode(F.filter(listed, lambda day: day.isNotNull()))
    rest = [c for c in raw.columns if c not in ("data", "weather", *DAY_FIELDS)]
    return raw.select(days.alias("_day"), *rest).select("_day.*", *rest)


def clean_days(days: DataFrame) -> DataFrame:
    """Typed columns and the hourly statistics; other columns, such as the partition, pass through."""
    rest = [c for c in days.columns if c not in DAY_FIELDS]
    numbers = days.withColumns(
        {f"_{name}": hourly_numbers(F.col("hourly"), name) for name in ("humidity", "pressure", "precipMM")}
    )
    humidity, pressure, rain = F.col("_humidity"), F.col("_pressure"), F.col("_precipMM")
    return numbers.select(
        lenient_date(F.col("date")).alias("date"),
        *[
            lenient_float(F.col(name)).alias(name)
            for name in ("maxtempF", "mintempF", "avgtempF", "totalSnow_cm", "sunHour")
        ],
        lenient_int(F.col("uvIndex")).alias("uvIndex"),
        mean_of(humidity).alias("avgHumidity"),
        mean_of(pressure).alias("avgPressure"),
        min_of(humidity).alias("minHumidity"),
        min_of(pressure).alias("minPressure"),
        max_of(humidity).alias("maxHumidity"),
        max_of(pressure).alias("maxPressure"),
        sum_of(rain).alias("totalPrecipMM"),
        *rest,
    )


def preview_days(clean: DataFrame, rows: int = 5) -> DataFrame:
    """First rows of the chosen columns, by date."""
    return clean.orderBy("date", "location").select(*PREVIEW).limit(rows)


def latest_per_day(days: DataFrame, keys: list[str], newest_first: list) -> DataFrame:
    """One row per day: the newest delivery.

    Spark ranks inside each task before the shuffle, so a day delivered over and over arrives
    as one row per task.
    """
    order = Window.partitionBy(*keys).orderBy(*newest_first)
    return days.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")


def missing_days(days: DataFrame, until) -> DataFrame:
    """Days before ``until`` that a location lacks, from its first day on."""
    have = days.select("location", F.col("date").cast("date").alias("date")).distinct()
    last = F.date_sub(F.lit(until).cast("date"), 1)
    spans = have.groupBy("location").agg(F.min("date").alias("_first")).filter(F.col("_first") <= last)
    wanted = spans.select("location", F.explode(F.sequence("_first", last)).alias("date"))
    return wanted.join(have, ["location", "date"], "left_anti")


def next_day(days: DataFrame, today=None) -> DataFrame:
    """The day to fetch next per location: the one after its last, if that is before today."""
    today = F.current_date() if today is None else F.lit(today).cast("date")
    last = days.groupBy("location").agg(F.max(F.col("date").cast("date")).alias("_last"))
    return last.select("location", F.date_add("_last", 1).alias("date")).filter(F.col("date") < today)
