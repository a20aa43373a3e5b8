"""Dense surrogate keys without a global sort or a one-task numbering."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlake.session import scratch_path


def assign_keys(df: DataFrame, key: str, start: int = 1) -> DataFrame:
    """Add ``key`` = start, start + 1, ... in no particular order.

    The rows are written to the shared folder first. A row's number is its place in its file after all rows of
    the files before it, so any task that is run again numbers its rows alike; files are counted without reading a
    column. ``session.drop_scratch`` removes the copy once the keyed rows are stored.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "keys")
    df.write.parquet(path)
    rows = spark.read.schema(df.schema).parquet(path)
    place = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    # one row per file
    counts = rows.groupBy(F.col("_metadata.file_path").alias("_file")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_file", (F.coalesce(F.sum("_n").over(before), F.lit(0)) + start).alias("_offset"))
    return place.join(offsets, "_file").withColumn(key, F.col("_offset") + F.col("_row")).select(key, *df.columns)


def next_key(target: DataFrame, key: str) -> int:
    """The key after the highest one in use; 1 for an empty table."""
    highest = target.agg(F.max(key)).first()[0]
    return 1 if highest is None else highest + 1
