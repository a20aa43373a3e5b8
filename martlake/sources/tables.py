"""Catalog tables, database tables, and Parquet layouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlake.operators.quality import check_bounds
from martlake.schemas import PAYMENT_RANGE

ROWS_PER_FILE = 20_000_000
MONTH = "fact_month"


def read_table(
    spark: SparkSession, url: str, table: str, column: str, lower, upper, partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Database table read in parallel ranges of ``column``."""
    return spark.read.jdbc(
        url, table, column=column, lowerBound=lower, upperBound=upper, numPartitions=partitions,
        properties=properties or {},
    )


def create_table(spark: SparkSession, name: str, schema: T.StructType, path: str, replace: bool = False) -> None:
    """Declare a Parquet table over a folder, with its database if there is none yet."""
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=path, source="parquet", schema=schema)


def register(
    spark: SparkSession, name: str, path: str, partitions: list[str] | None = None,
    source: str = "parquet", schema: T.StructType | None = None,
) -> DataFrame:
    """Record a folder as a catalog table with its partitions; the schema is discovered if not given.

    Partition values are declared as text, so that zero-padded months and days stay as they are. A table
    of that name over the same folder is declared anew; one over another folder is left alone and stops the call.
    """
    partitions = partitions or []
    found = schema or spark.read.format(source).load(path).schema
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in found.fields if f.name not in partitions]
    columns += [f"`{p}` STRING" for p in partitions]
    split = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in partitions)})" if partitions else ""
    if spark.catalog.tableExists(name):
        if table_folder(spark, name).rstrip("/") != _qualified(spark, path).rstrip("/"):
            raise ValueError(f"{name} is a table over another folder")
        spark.sql(f"DROP TABLE {name}")
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({', '.join(columns)}) USING {source}{split} LOCATION '{place}'")
    if partitions:
        spark.catalog.recoverPartitions(name)
    return spark.table(name)


def table_folder(spark: SparkSession, name: str) -> str:
    """The folder a catalog table lies in."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first()
    if described is None:
        raise LookupError(f"{name} has no folder")
    return described["data_type"]


def _qualified(spark: SparkSession, path: str) -> str:
    """The path as the catalog writes it, with its file system."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(folder).toString()


def write_partitioned(
    df: DataFrame, path: str, moment: str = "payment_date",
    bounds: tuple[str, str] | None = PAYMENT_RANGE, mode: str = "overwrite",
) -> str:
    """Month folders, from a half-open span of months; a row outside the span stops the job.

    Rebalancing fills each month's files evenly and splits a hot month over several tasks.
    """
    month = F.date_format(moment, "yyyy-MM")
    if bounds:
        low, high = (F.lit(b).cast("timestamp_ntz") for b in bounds)
        inside = F.coalesce((F.col(moment) >= low) & (F.col(moment) < high), F.lit(False))
        month = F.when(inside, month).otherwise(
            F.raise_error(F.concat(F.lit("no partition for "), F.coalesce(F.col(moment).cast("string"), F.lit("NULL"))))
        )
    split = df.withColumn("pay_month", month.cast("string"))
    (
        split.hint("rebalance", "pay_month").write.mode(mode)
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .partitionBy("pay_month").parquet(path)
    )
    return path


def read_months(spark: SparkSession, path: str, schema: T.StructType, low: str, high: str) -> DataFrame:
    """Rows of the months from ``low`` to ``high`` (yyyy-MM, both included); other folders are skipped."""
    full = T.StructType([*schema.fields, T.StructField("pay_month", T.StringType())])
    return spark.read.schema(full).parquet(path).filter(F.col("pay_month").between(low, high))


def read_between(spark: SparkSession, path: str, schema: T.StructType, low, high, moment: str = "payment_date") -> DataFrame:
    """Rows from ``low`` to before ``high``, moments as text or dates; the months to read follow from them, as does the row filter."""
    low, high = (F.lit(x).cast(schema[moment].dataType) for x in (low, high))
    full = T.StructType([*schema.fields, T.StructField("pay_month", T.StringType())])
    months = F.col("pay_month").between(F.date_format(low, "yyyy-MM"), F.date_format(high, "yyyy-MM"))
    rows = spark.read.schema(full).parquet(path)
    return rows.filter(months & (F.col(moment) >= low) & (F.col(moment) < high)).drop("pay_month")


def fact_month() -> Column:
    """The month of a fact or a date, yyyymm."""
    return F.expr("date_id div 100").cast("string")


def join_dates(facts: DataFrame, dates: DataFrame) -> DataFrame:
    """Facts in month folders with their dates. Dates that are filtered pick the folders while the query runs."""
    return facts.join(dates.withColumn(MONTH, fact_month()), [MONTH, "date_id"])


def outside_months(df: DataFrame, moment: str = "payment_date", bounds=PAYMENT_RANGE) -> DataFrame:
    """The rows ``write_partitioned`` would refuse."""
    return check_bounds(df, moment, *[F.lit(b).cast("timestamp_ntz") for b in bounds])


def write_fact(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Facts in ranges of date and film, sorted within files so that readers skip by min and max.

    The range cut also looks at customer and staff, so a hot day, or a hot film on one day,
    is cut into several ranges.
    """
    (
        df.repartitionByRange("date_id", "film_id", "customer_id", "staff_id")
        .sortWithinPartitions("date_id", "film_id")
        .write.mode(mode).option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path)
    )
    return path


def write_fact_months(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Facts as ``write_fact`` lays them out, in a folder per month, so that a load can replace the months it touches.

    ``overwrite`` replaces the table, ``months`` the months that occur in the data.
    """
    (
        df.withColumn(MONTH, fact_month())
        .repartitionByRange("date_id", "film_id", "customer_id", "staff_id")
        .sortWithinPartitions("date_id", "film_id")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if mode == "months" else "static")
        .option("maxRecordsPerFile", ROWS_PER_FILE).partitionBy(MONTH).parquet(path)
    )
    return path


def write_dealt(df: DataFrame, name: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """A catalog table dealt to buckets by all its keys and sorted by them, one file a bucket.

    Tables dealt alike are joined and merged on these keys where they lie. The keys of a fact as a whole spread evenly, which
    one of them, such as a hot day, would not.
    """
    (
        df.repartition(buckets, *keys).write.mode("overwrite").option("path", path).format("parquet")
        .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    )
    return df.sparkSession.table(name)


def merge_dealt(target: DataFrame, stage: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """Delete-then-insert into a table dealt by ``keys``: only the stage is shuffled, to the target's buckets.

    A NULL key matches nothing.
    """
    dealt = stage.select(*target.columns).repartition(buckets, *keys)
    kept = target.join(dealt.select(*keys), keys, "left_anti").select(*target.columns)
    return kept.unionByName(dealt)


def write_bucketed_fact(df: DataFrame, name: str, path: str, buckets: int) -> None:
    """Facts bucketed by day for joins on the day without a shuffle; for data without a hot day."""
    (
        df.write.mode("overwrite").option("path", path).format("parquet")
        .bucketBy(buckets, "date_id").sortBy("date_id", "film_id").saveAsTable(name)
    )


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of a declared table, cast to its types; text that does not fit raises."""
    picked: list[Column] = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    return df.select(*picked)
