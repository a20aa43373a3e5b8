"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from martlake.sources.files import delete, size

# Runtime settings the pipelines count on. Calendar parts follow the session zone, so it is
# pinned; AQE splits hot join keys even where that costs one more exchange.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


# Settings of the table queries. Parquet holds narrow rows in a fraction of the bytes they take in a join, so sizes taken from
# files are raised before they decide on a broadcast. For the same reason tasks get less of a file or a shuffle than usual: what
# one holds in memory then stays the same however large the tables are.
TABLES = {
    "spark.sql.sources.fileCompressionFactor": "16",
    "spark.sql.files.maxPartitionBytes": "16MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
}
# A shuffle gets a partition for each so many bytes of files; AQE puts together those that stay small.
FILE_BYTES = 4 * 1024 * 1024
# Whether a job's shuffle files go when it has ended, and not only when the driver has collected its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession, settings: dict[str, str] = RUNTIME) -> SparkSession:
    """Apply settings to a session somebody else built."""
    for key, value in settings.items():
        spark.conf.set(key, value)
    return spark


def size_shuffles(spark: SparkSession, folder: str) -> SparkSession:
    """Let shuffles start with a number of partitions that grows with the files below a folder."""
    wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size(spark, folder) // FILE_BYTES)
    return configure(spark, {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(wanted)})


def build_session(app: str = "martlake", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or where that is unset a folder of the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def scratch_dir(spark: SparkSession) -> str:
    """The part of the shared folder that belongs to this application."""
    return f"{shared_dir(spark)}/scratch-{spark.sparkContext.applicationId}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """The same rows, written to a fresh path and read again.

    The shuffle files of the job are removed as soon as it has ended, so a query in several such steps takes the disk of
    its largest one, and of the copies it reads.
    """
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, None)
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        conf.unset(SHUFFLE_CLEANUP) if before is None else conf.set(SHUFFLE_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    """Remove what this application has put below ``scratch_path``.

    To be called when no DataFrame that reads from it is used any more: after results are stored or
    collected, or at the end of the application.
    """
    delete(spark, scratch_dir(spark))
