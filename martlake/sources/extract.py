"""Headerless CSV extracts, written and read with the same quoting rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# NULL is an empty field, empty text is "", a quote inside text is doubled, blanks are kept
CSV = {
    "header": "false",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
ROWS_PER_FILE = 5_000_000

# what the parser puts for an empty field before Spark turns it into NULL; no text can hold it
NO_VALUE = "\u0000"


def export_extract(df: DataFrame, path: str, order: list[str] | None = None) -> str:
    """Replace the extract at ``path``; with ``order``, files hold consecutive ranges of the sort.

    Ties are broken by the other columns, so that one hot key still spreads over several files.
    """
    if order:
        df = df.orderBy(*order, *[c for c in df.columns if c not in order])
    (
        df.write.mode("overwrite")
        .options(**CSV, nullValue="", emptyValue='""', maxRecordsPerFile=str(ROWS_PER_FILE))
        .csv(path)
    )
    return path


def read_extract(spark: SparkSession, path: str, schema: T.StructType, multiline: bool | None = None) -> DataFrame:
    """Rows of an extract; a malformed row stops the job.

    Text may hold line breaks, so files with text columns are read one file per task; their size is bounded when
    they are written here. Extracts made elsewhere, known to hold no line break within a field, are read with
    ``multiline=False``: then large files are split over tasks.
    """
    has_text = any(isinstance(f.dataType, T.StringType) for f in schema.fields) if multiline is None else multiline
    return (
        spark.read.schema(schema)
        .options(**CSV, nullValue=NO_VALUE, emptyValue="", mode="FAILFAST", multiLine=str(has_text).lower())
        .csv(path)
    )
