"""Contiguous shards of near equal bytes, from a global prefix sum of sizes.

Rows are ordered by (id, checksum, size), nulls first, and put into ranges of that order. Each range sums its own
bytes and rows; running sums of these few totals give every range its first byte and row, and a running sum
within the range gives them to every row. A row belongs to the shard that holds its middle byte when all bytes
are cut at equal targets, so a shard misses its target by at most one row's size.

Defined cases: a null text counts as empty (size 1, checksum 0); a null id sorts first; rows that agree in id,
checksum and size are counted before the ranges are made and expanded afterwards, so a row repeated any number
of times neither sits in one task nor in one shard; an empty table gives no rows; only the id and the text are
read, so other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlake.llm.common import stored

#: Repeated rows are expanded in two steps, so that no array is longer than this.
EXPAND = 65_536


def text_size(text: Column) -> Column:
    return (F.octet_length(F.coalesce(text, F.lit(""))) + 1).cast("long")


def text_checksum(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def ranged_totals(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct rows with `copies`, the range they are in, and the first byte and row of each in the whole order."""
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    order = [F.col(k).asc_nulls_first() for k in keys]
    ranged = stored(counted.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "shard-ranges")
    before = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    weight = F.col("size") * F.col("copies")
    within = ranged.withColumns(
        {
            "byte": F.coalesce(F.sum(weight).over(before), F.lit(0).cast("long")),
            "row": F.coalesce(F.sum("copies").over(before), F.lit(0).cast("long")),
        }
    )
    # One row per range, whatever the number of documents.
    parts = ranged.groupBy("part").agg(F.sum(weight).alias("part_bytes"), F.sum("copies").alias("part_rows"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    offsets = parts.select(
        "part",
        F.coalesce(F.sum("part_bytes").over(earlier), F.lit(0).cast("long")).alias("first_byte"),
        F.coalesce(F.sum("part_rows").over(earlier), F.lit(0).cast("long")).alias("first_row"),
        F.sum("part_bytes").over(everything).alias("total_bytes"),
    )
    return within.join(F.broadcast(offsets), "part").select(
        *keys,
        "copies",
        (F.col("byte") + F.col("first_byte")).alias("byte"),
        (F.col("row") + F.col("first_row")).alias("row"),
        "total_bytes",
    )


def byte_shards(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, size, text_crc32, shard, slot within the shard, and first byte in the whole order."""
    rows = docs.select(
        F.col(id_col).alias(id_col),
        text_checksum(F.col(text_col)).alias("text_crc32"),
        text_size(F.col(text_col)).alias("size"),
    )
    keys = [id_col, "text_crc32", "size"]
    groups = ranged_totals(rows, keys)
    blocks = groups.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {EXPAND}"))))
    copy = F.explode(
        F.sequence(F.col("block") * EXPAND, F.least(F.col("copies"), (F.col("block") + 1) * EXPAND) - 1)
    )
    placed = blocks.withColumn("copy", copy).select(
        *keys,
        (F.col("byte") + F.col("copy") * F.col("size")).alias("byte"),
        (F.col("row") + F.col("copy")).alias("row"),
        "total_bytes",
    )
    middle = (2 * F.col("byte") + F.col("size")).cast("decimal(38,0)") * shards
    shard = F.floor(middle / (2 * F.col("total_bytes")).cast("decimal(20,0)")).cast("int")
    placed = placed.withColumn("shard", shard)
    first = placed.groupBy("shard").agg(F.min("row").alias("shard_row"))  # one row per shard
    return placed.join(F.broadcast(first), "shard").select(
        id_col, "size", "text_crc32", "shard", (F.col("row") - F.col("shard_row")).alias("slot"), "byte"
    )


def with_shards(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with the shard of each, to be written by shard; equal rows cut apart go to their first shard."""
    places = byte_shards(docs, shards, id_col, text_col)
    places = places.groupBy(id_col, "size", "text_crc32").agg(F.min("shard").alias("shard"))
    p, d = places.alias("p"), docs.alias("d")
    same = (
        F.col(f"d.{id_col}").eqNullSafe(F.col(f"p.{id_col}"))
        & (text_size(F.col(f"d.{text_col}")) == F.col("p.size"))
        & (text_checksum(F.col(f"d.{text_col}")) == F.col("p.text_crc32"))
    )
    return d.join(p, same).select("d.*", "p.shard")
