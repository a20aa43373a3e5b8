"""The weather landing zone and the clean Parquet folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlake import schemas

CLEAN_PARTITIONS = ["location", "year", "month"]


# What a landing file is read as: its whole text, and the folders it lies in.
FILES = T.StructType([T.StructField("value", T.StringType()), *[T.StructField(k, T.StringType()) for k in schemas.LANDING_KEYS]])
CORRUPT = "_corrupt"
DOCUMENT = T.StructType([*[f for f in schemas.LANDING.fields if f.name not in schemas.LANDING_KEYS], T.StructField(CORRUPT, T.StringType())])
SOURCE = ["source_file", "source_time", "source_size"]
#: Files of more bytes are read by lines, in many tasks, and their documents put together again; the rows are the same.
WHOLE = 64 << 20
#: Between two documents, and nowhere inside one: a line that closes an object, then one that opens one.
BORDER = r"(?<=\})\s*\n\s*(?=\{)"
JSON = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
END = "end of the text"


def _one_document(text: Column) -> Column:
    """Whether the whole text is one JSON object; ``from_json`` alone ignores what follows the first."""
    parts = F.from_json(F.concat(F.lit("["), text, F.lit(f',"{END}"]')), "array<string>")
    whole = (F.size(parts) == 2) & (F.get(parts, F.lit(1)) == END) & F.trim(text).startswith("{")
    return F.coalesce(whole, F.lit(False))


def _starts_document(line: Column) -> Column:
    """Whether a line begins with an object that is complete and readable."""
    found = F.from_json(line, DOCUMENT, JSON)
    readable = found.isNotNull() & found[CORRUPT].isNull() & F.trim(line).startswith("{")
    return F.coalesce(readable, F.lit(False))


def _read_texts(spark: SparkSession, root: str, paths: list[str] | None, whole: bool) -> DataFrame:
    """Texts of files up to ``WHOLE`` bytes, or the lines of larger ones with the block of the file they are in."""
    options = {"wholetext": True} if whole else {"lineSep": "\n"}
    files = spark.read.schema(FILES).option("basePath", root).text(paths or root, **options)
    size = F.col("_metadata.file_size")
    return files.filter(size <= WHOLE if whole else size > WHOLE).select(
        "*",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_modification_time").alias("source_time"),
        size.alias("source_size"),
        *([] if whole else [F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at")]),
    )


def _between_borders(lines: DataFrame) -> DataFrame:
    """The stretches between borders, from lines of files that several tasks read.

    Borders are counted within each block of a file and summed over the blocks before it, one row per block; only the lines
    of one stretch have to meet.
    """
    block = ["source_file", "_block"]
    order = Window.partitionBy(*block).orderBy("_at")
    seen = lines.filter(F.col("value").rlike(r"\S")).select(
        "*",
        F.col("value").rlike(r"^\s*\{").alias("_opens"),
        F.col("value").rlike(r"\}\s*$").alias("_closes"),
    )
    # NULL for the first line of a block: the one before it is in another.
    seen = seen.withColumn("_border", F.col("_opens") & F.lag("_closes").over(order))
    count = F.sum(F.coalesce(F.col("_border"), F.lit(False)).cast("long"))
    blocks = seen.groupBy(*block).agg(
        F.min_by("_opens", "_at").alias("_first_opens"), F.max_by("_closes", "_at").alias("_last_closes"), count.alias("_inner")
    )
    files = Window.partitionBy("source_file").orderBy("_block")
    joint = F.coalesce(F.col("_first_opens") & F.lag("_last_closes").over(files), F.lit(False)).cast("long")
    blocks = blocks.withColumn("_joint", joint).select(
        *block, (F.sum(F.col("_inner") + F.col("_joint")).over(files) - F.col("_inner")).alias("_before")
    )
    within = count.over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    numbered = seen.withColumn("_within", within).join(blocks, block).withColumn("_stretch", F.col("_before") + F.col("_within"))
    parts = F.sort_array(F.collect_list(F.struct("_block", "_at", "value")))
    stretches = numbered.groupBy(*schemas.LANDING_KEYS, *SOURCE, "_stretch").agg(parts.alias("_parts"))
    return stretches.withColumn("value", F.array_join(F.col("_parts.value"), "\n")).drop("_stretch", "_parts")


def read_landing(spark: SparkSession, root: str, paths: list[str] | None = None) -> DataFrame:
    """Every JSON document below ``location=/year=/month=/day=`` folders, in any of the three shapes.

    A document may stand on one line or on several. Between a line that closes an object and one that opens one a document
    ends; what stands between two such places is one document if the whole of it parses. Otherwise, if any of its lines
    begins with a complete object, each of them is judged by itself; else it is one broken document, such as a reply that is cut.
    Lines without a sign are passed over. Files of more than ``WHOLE`` bytes are split over tasks, with the same rows.
    Only the needed fields are parsed. ``reason`` says why a document holds no day (``text`` then holds it), and is NULL for
    all others; source columns name the file it came from. ``paths`` picks files below the folder.
    """
    whole = _read_texts(spark, root, paths, whole=True)
    whole = whole.withColumn("value", F.explode(F.split("value", BORDER)))
    stretches = whole.unionByName(_between_borders(_read_texts(spark, root, paths, whole=False)))
    lines = F.filter(F.split("value", "\r?\n"), lambda line: line.rlike(r"\S"))
    stretches = stretches.withColumn("_lines", lines).filter(F.size("_lines") > 0)
    text = F.array_join(F.col("_lines"), "\n")
    alone = F.array(text)
    found = F.when(_one_document(text), alone).when(F.exists("_lines", _starts_document), F.col("_lines")).otherwise(alone)
    texts = stretches.withColumn("text", F.explode(found)).drop("value", "_lines")
    parsed = texts.withColumn("_doc", F.from_json("text", DOCUMENT, JSON))
    fields = [f.name for f in DOCUMENT.fields if f.name != CORRUPT]
    broken = F.col("_doc").isNull() | F.col(f"_doc.{CORRUPT}").isNotNull()
    listed = F.coalesce("_doc.data.weather", "_doc.weather")
    nothing = F.lit(True)
    for name in schemas.RAW_DAY.fieldNames():
        nothing = nothing & F.col(f"_doc.{name}").isNull()
    no_day = F.when(listed.isNotNull(), ~F.exists(listed, lambda day: day.isNotNull())).otherwise(nothing)
    reason = F.when(broken, "not a JSON document").when(no_day, "no day in it")
    return parsed.withColumn("reason", reason).select(
        *[F.col(f"_doc.{name}").alias(name) for name in fields],
        *schemas.LANDING_KEYS,
        *SOURCE,
        "reason",
        F.when(reason.isNotNull(), F.col("text")).alias("text"),
    )


def accepted(documents: DataFrame) -> DataFrame:
    """Documents with a day in them, with the columns of the landing zone and the file they came from."""
    return documents.filter(F.col("reason").isNull()).drop("reason", "text")


def rejected(documents: DataFrame) -> DataFrame:
    """Documents without a day: where they lie, why, and what they say."""
    return documents.filter(F.col("reason").isNotNull()).select(*schemas.LANDING_KEYS, *SOURCE, "reason", "text")


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Path, time and size of every landing file; contents are not read.

    A file without a byte is not listed by Spark; it counts as not yet delivered until it holds something.
    """
    return named_files(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root))


def named_files(found: DataFrame) -> DataFrame:
    return found.select(
        F.col("path").alias("source_file"), F.col("modificationTime").alias("source_time"), F.col("length").alias("source_size")
    )


def write_landing(days: DataFrame, root: str, mode: str = "append") -> str:
    """Raw days as JSON in day folders; month and day values are zero-padded text."""
    keys = schemas.LANDING_KEYS
    days.hint("rebalance", *keys).write.mode(mode).partitionBy(*keys).json(root)
    return root


def write_clean(clean: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Clean days as Parquet below ``location=/year=/month=``.

    ``overwrite`` replaces the folder, ``append`` adds to it, ``partitions`` replaces only the
    partitions that occur in the data. Rebalancing gives each partition few files and splits
    a location that holds much of the data.
    """
    writer = clean.hint("rebalance", *CLEAN_PARTITIONS).write.partitionBy(*CLEAN_PARTITIONS)
    if mode == "partitions":
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        writer.mode(mode).option("partitionOverwriteMode", "static").parquet(path)
    return path


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CLEAN_DAY).parquet(path)
