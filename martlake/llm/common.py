"""What the operators share: reading tables, written intermediate tables, size-checked broadcasts."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.session import configure, scratch_path

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: A side of a join may be broadcast up to this many rows; callers pass rows of a few numbers or short strings.
BROADCAST_ROWS = 200_000

#: Rows and bytes that go to a Python worker at once; a longer text goes alone.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8388608",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings, and the way for Python workers to import this package from where the driver has it."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    for key, value in BATCHES.items():
        spark.conf.set(key, value)
    return configure(spark)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write below the shared folder and read again: later steps start from files that outlive an executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marked for a broadcast if it is counted to be within the bound, otherwise left to a shuffle join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function for mapInArrow or mapInPandas that leaves its worker, which Spark keeps for later tasks, small."""

    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
            if trim:
                trim(0)

    return wrapped


def unused(df: DataFrame, mark: str = "_") -> str:
    """A prefix that no column of the table begins with."""
    while any(c.lower().startswith(mark) for c in df.columns):
        mark += "_"
    return mark
