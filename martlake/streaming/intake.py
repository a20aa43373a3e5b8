"""Incremental weather intake: a stream of landing files feeds an append-only log of cleaned days.

Structured Streaming's file source finds new files and keeps its place in ``checkpoint``. Each of its batches writes three
folders of the log under the batch's number: ``days`` holds the cleaned days, ``rejected`` the documents that hold none, ``files``
the path, time and size of the files taken in. ``files`` is written last and says that a batch counts; a batch that failed is
repeated by the stream with the same files and number and writes the same folders again. The source knows files by their names,
of any age. Files that were delivered again under their names are found by their time and size, after the stream has caught up,
and taken in as batches between two of the stream.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlake import schemas
from martlake.operators.weather import clean_days, latest_per_day, normalise_days
from martlake.sources.landing import (
    CLEAN_PARTITIONS,
    SOURCE,
    accepted,
    list_files,
    named_files as _named,
    read_landing,
    rejected,
    write_clean,
)
from martlake.sources.publish import publish, published_folders, published_run, read_folders, read_published

TABLE = "cleanweather"
#: Batches of the stream are this far apart, so that files delivered again go between two of them.
STEP = 1_000_000
ANY_AGE = "365000d"

# A day is known by its landing folder and its date; a date that does not parse is NULL and
# still tells the day from those of other folders.
DAY_KEYS = [*schemas.LANDING_KEYS, "date"]

TAKEN = T.StructType(
    [
        T.StructField("source_file", T.StringType()),
        T.StructField("source_time", T.TimestampType()),
        T.StructField("source_size", T.LongType()),
        T.StructField("batch", T.LongType()),
    ]
)
LOG = T.StructType([*schemas.CLEAN_DAY.fields, *TAKEN.fields])
REJECTED = T.StructType(
    [
        *[T.StructField(k, T.StringType()) for k in schemas.LANDING_KEYS],
        *TAKEN.fields[:-1],
        T.StructField("reason", T.StringType()),
        T.StructField("text", T.StringType()),
        TAKEN["batch"],
    ]
)


def _log_part(spark: SparkSession, log: str, part: str, schema: T.StructType) -> DataFrame:
    """One part of the log; empty before the first batch."""
    try:
        return spark.read.schema(schema).parquet(f"{log}/{part}")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def taken_files(spark: SparkSession, log: str) -> DataFrame:
    return _log_part(spark, log, "files", TAKEN)


def last_batch(spark: SparkSession, log: str) -> int:
    """The newest batch that counts, or -1. Batch numbers come from the folders' names."""
    newest = taken_files(spark, log).agg(F.max("batch")).first()[0]
    return -1 if newest is None else newest


def changed_files(spark: SparkSession, root: str, log: str) -> DataFrame:
    """Files that the log does not hold as they are now; their contents are not read."""
    return list_files(spark, root).join(taken_files(spark, log).select(*SOURCE), SOURCE, "left_anti")


def _write_batch(files: DataFrame, root: str, log: str, batch: int) -> bool:
    """Clean the documents of these files into the log; the driver holds the paths of one batch. False if there are none."""
    spark = files.sparkSession
    listed = files.select(*SOURCE).collect()
    if not listed:
        return False
    documents = read_landing(spark, root, [r["source_file"] for r in listed])
    days = clean_days(normalise_days(accepted(documents)))
    wanted = [f.name for f in LOG.fields if f.name != "batch"]
    days.select(*wanted).write.mode("overwrite").parquet(f"{log}/days/batch={batch}")
    rejected(documents).write.mode("overwrite").parquet(f"{log}/rejected/batch={batch}")
    # As listed before the reading: a file that changed meanwhile is found again.
    noted = spark.createDataFrame(listed, T.StructType(TAKEN.fields[:-1]))
    noted.write.mode("overwrite").parquet(f"{log}/files/batch={batch}")
    return True


def take_in(spark: SparkSession, root: str, log: str, files_per_batch: int = 100_000) -> int:
    """Clean all files that are new or changed, in batches of at most so many; returns the last batch's number."""
    found = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", ANY_AGE)
        .load(root)
    )
    query = (
        _named(found)
        .writeStream.foreachBatch(lambda files, number: _write_batch(files, root, log, number * STEP))
        .option("checkpointLocation", f"{log}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    while True:
        again = changed_files(spark, root, log).orderBy("source_time", "source_file").limit(files_per_batch)
        if not _write_batch(again, root, log, max(last_batch(spark, log), 0) + 1):
            return last_batch(spark, log)


def _counted(spark: SparkSession, log: str, part: str, schema: T.StructType) -> DataFrame:
    """A part of the log, of the batches that count."""
    return _log_part(spark, log, part, schema).join(taken_files(spark, log).select("batch").distinct(), "batch", "left_semi")


def read_log(spark: SparkSession, log: str) -> DataFrame:
    """Every delivery of every day."""
    return _counted(spark, log, "days", LOG)


def rejected_documents(spark: SparkSession, log: str) -> DataFrame:
    """Documents without a day, with the reason."""
    return _counted(spark, log, "rejected", REJECTED)


def newest_of(deliveries: DataFrame) -> DataFrame:
    """The newest delivery of each day."""
    tie = F.xxhash64(*[F.col(c) for c in schemas.CLEAN_DAY.fieldNames()])
    newest = [F.col(c).desc_nulls_last() for c in ("batch", "source_time", "source_file")] + [tie]
    return latest_per_day(deliveries, DAY_KEYS, newest).select(*schemas.CLEAN_DAY.fieldNames())


def compacted_batch(spark: SparkSession, base: str) -> int:
    """The last batch in the published days, or -1; a version is named after it."""
    run = published_run(spark, base, TABLE)
    return -1 if run is None else int(run.rsplit("-", 1)[1])


def read_compacted(spark: SparkSession, base: str) -> DataFrame:
    return read_published(spark, base, TABLE, schemas.CLEAN_DAY)


def _merged(done: DataFrame, fresh: DataFrame) -> DataFrame:
    """Fresh days, and those of before that did not come again."""
    same = reduce(lambda a, b: a & b, [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in DAY_KEYS])
    return done.alias("old").join(fresh.select(*DAY_KEYS).alias("new"), same, "left_anti").unionByName(fresh)


def current_days(spark: SparkSession, log: str, base: str | None = None) -> DataFrame:
    """One row per day: its newest delivery.

    With ``base`` only the batches after the last compaction are read from the log.
    """
    last = compacted_batch(spark, base) if base else -1
    fresh = newest_of(read_log(spark, log).filter(F.col("batch") > last))
    return fresh if last < 0 else _merged(read_compacted(spark, base), fresh)


def compact_days(spark: SparkSession, log: str, base: str) -> DataFrame | None:
    """Publish the current days as a new version of the clean table, in month folders.

    Only the folders that the batches since the last compaction touch are written again; the others stay by
    reference. The version is named after the last batch it holds. Returns the days, or None before the first.
    """
    last, newest = compacted_batch(spark, base), last_batch(spark, log)
    if newest > last:
        days, kept = newest_of(read_log(spark, log).filter(F.col("batch") > last)), []
        if last >= 0:
            # one row per folder
            rows = days.select(*CLEAN_PARTITIONS).distinct().collect()
            touched = {"/".join(f"{k}={r[k]}" for k in CLEAN_PARTITIONS) for r in rows}
            folders = published_folders(spark, base)[TABLE][1]
            again = [f for f in folders if "/".join(f.split("/")[-len(CLEAN_PARTITIONS):]) in touched]
            kept = [f for f in folders if f not in again]
            if again:
                days = _merged(read_folders(spark, base, TABLE, again, schemas.CLEAN_DAY), days)
        publish(spark, {TABLE: days}, base, f"batch-{newest:018d}", writers={TABLE: write_clean}, kept={TABLE: kept})
    return read_compacted(spark, base) if newest >= 0 else None
