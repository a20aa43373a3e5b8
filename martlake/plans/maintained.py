"""Stored reports kept up to date by month: sums and counts per month, of which a load renews only those it touches.

The facts lie in month folders. Each report has a table of partial sums in month folders as well, small beside the facts, and
is finished from these when it is read. A change of facts goes month by month: the touched folders are read, rows of the
stage's keys go out, the stage comes in, and the same months of the partial sums are made again. So what was taken away counts
no longer, and other months are not read. A change of a dimension renews all months.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlake import schemas
from martlake.operators.sales import grouping_sets
from martlake.operators.upsert import delete_insert
from martlake.session import scratch_path
from martlake.sources.tables import MONTH, fact_month, typed, write_fact_months

Tables = dict[str, DataFrame]


@dataclass
class Report:
    """Keys of the partial sums from facts and dimensions, and how the report comes from the sums."""

    keys: list[str]
    joined: Callable[[DataFrame, Tables], DataFrame]
    finished: Callable[[DataFrame], DataFrame]


def _with_dates(facts: DataFrame, star: Tables, column: str) -> DataFrame:
    return facts.join(star["date_dim"].select("date_id", column), "date_id")


def _average(sums: DataFrame) -> DataFrame:
    total = F.sum("total").cast("double") / F.nullif(F.sum("filled"), F.lit(0)).cast("double")
    return sums.cube("day_of_week").agg(total.alias("sales"))


REPORTS = {
    "daily_average_sales": Report(["day_of_week"], lambda facts, star: _with_dates(facts, star, "day_of_week"), _average),
    "weekly_rating_sales": Report(
        ["week_of_year", "rating"],
        lambda facts, star: _with_dates(facts, star, "week_of_year").join(star["film_dim"].select("film_id", "rating"), "film_id"),
        lambda sums: grouping_sets(sums.withColumnRenamed("total", "sales"), ["week_of_year", "rating"], "cube"),
    ),
}


def read_facts(spark: SparkSession, path: str, schema: T.StructType, months: list[str] | None = None) -> DataFrame:
    """Facts with their month; with ``months`` only these folders are read."""
    facts = spark.read.schema(T.StructType([*schema.fields, T.StructField(MONTH, T.StringType())])).parquet(path)
    return facts if months is None else facts.filter(F.col(MONTH).isin(months))


def replace_facts(spark: SparkSession, path: str, stage: DataFrame, keys: list[str] | None = None) -> list[str]:
    """Delete-then-insert into month folders of facts; returns the months that were written, one short text each.

    Keys hold the day, so rows that a stage row replaces lie in its month. The new folders take the old ones' place when all
    are written. The stage is cast to the columns of the facts; what does not fit stops the call.
    """
    held, schema = scratch_path(spark, "stage"), spark.read.parquet(path).drop(MONTH).schema
    typed(stage, schema).withColumn(MONTH, fact_month()).write.parquet(held)
    stage = spark.read.parquet(held)
    months = sorted(r[0] for r in stage.select(MONTH).distinct().collect())
    old = read_facts(spark, path, schema, months)
    merged = scratch_path(spark, "months")
    delete_insert(old, stage, keys or schemas.STAR_KEYS["sales_facts"]).write.parquet(merged)
    write_fact_months(spark.read.parquet(merged).drop(MONTH), path, mode="months")
    return months


def refresh(spark: SparkSession, name: str, facts: str, star: Tables, base: str, months: list[str] | None = None) -> None:
    """Make the partial sums of some months, or of all, again. ``facts`` is their folder; months are their numbers (yyyymm)."""
    report = REPORTS[name]
    rows = read_facts(spark, facts, star["sales_facts"].schema, months)
    sums = report.joined(rows, star).groupBy(MONTH, *report.keys).agg(
        F.sum("amount").alias("total"), F.count("amount").alias("filled"), F.count(F.lit(1)).alias("n")
    )
    if months:
        # A month without a row left still replaces its old sums.
        blank = spark.createDataFrame([(m, 0) for m in months], f"{MONTH} string, n long")
        sums = sums.unionByName(blank, allowMissingColumns=True)
    writer = sums.repartition(MONTH).write.mode("overwrite").partitionBy(MONTH)
    writer.option("partitionOverwriteMode", "static" if months is None else "dynamic").parquet(f"{base}/{name}")


def read_report(spark: SparkSession, name: str, base: str) -> DataFrame:
    """The report as of the last refresh, from the sums of all months."""
    return REPORTS[name].finished(spark.read.parquet(f"{base}/{name}").filter("n > 0"))
