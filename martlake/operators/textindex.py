"""Word index over title and description, stored by word, search for words and phrases in it, and its upkeep.

An index that is kept up to date is stored in slices, ranges of `SLICE` keys in a folder each and sorted by word within. A change
of rows writes the slices of their keys again and leaves all others as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.functions.text import STOP_WORDS, words
from martlake.session import scratch_path

#: Keys of one slice of a kept index.
SLICE = 100_000


def token_index(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(token, key, positions): where each word stands, counting from 1, stop words left out.

    The columns are read as one text in the order given; a missing one counts as empty. A group
    is one word of one row, so no list grows with the table. Most groups hold one or two places,
    so words are shuffled as they are; merging them before would sort much and save little.
    """
    text = F.concat_ws(" ", *columns)
    placed = df.select(key, F.posexplode(words(text)).alias("_at", "token"))
    return (
        placed.filter(~F.col("token").isin(STOP_WORDS))
        .repartition("token", key)
        .groupBy("token", key)
        .agg(F.sort_array(F.collect_list(F.col("_at") + 1)).alias("positions"))
    )


def write_index(index: DataFrame, key: str, path: str) -> str:
    """Store an index sorted by word, so that a search skips files and row groups of other words.

    The range cut also looks at the key, so a hot word is cut into several ranges.
    """
    index.repartitionByRange("token", key).sortWithinPartitions("token", key).write.mode("overwrite").parquet(path)
    return path


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def search(index: DataFrame, key: str, terms: list[str], need_all: bool = True) -> DataFrame:
    """Keys holding all (or any) of the words, with the number of hits."""
    wanted = sorted({t.lower() for t in terms} - set(STOP_WORDS))
    hits = (
        index.filter(F.col("token").isin(wanted))
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("_found"), F.sum(F.size("positions")).alias("hits"))
    )
    if need_all:
        hits = hits.filter(F.col("_found") == len(wanted))
    return hits.drop("_found")


def phrase_search(index: DataFrame, key: str, phrase: str) -> DataFrame:
    """Keys whose text holds the words of a phrase one after another, with the number of places.

    Stop words are not in the index but have a position, so any one of them fits where the phrase has one. Each
    posting votes for the place where the phrase would begin; a place with a vote of every word is one of the phrase.
    """
    spark = index.sparkSession
    text = spark.range(1).select(F.posexplode(words(F.lit(phrase))).alias("at", "token"))
    # One row per word of the phrase.
    wanted = text.filter(~F.col("token").isin(STOP_WORDS)).groupBy("token").agg(F.collect_list("at").alias("shifts"))
    terms = {r["token"]: r["shifts"] for r in wanted.collect()}
    if not terms:
        return index.select(key, F.lit(0).cast("long").alias("places")).limit(0)
    shifts = F.create_map(*[x for t, at in terms.items() for x in (F.lit(t), F.array(*map(F.lit, at)))])
    postings = index.filter(F.col("token").isin(list(terms)))
    starts = F.flatten(F.transform("positions", lambda at: F.transform(shifts[F.col("token")], lambda shift: at - shift)))
    votes = postings.select(key, F.explode(starts).alias("_start")).groupBy(key, "_start").agg(F.count(F.lit(1)).alias("_votes"))
    whole = votes.filter((F.col("_votes") == sum(map(len, terms.values()))) & (F.col("_start") > 0))
    return whole.groupBy(key).agg(F.count(F.lit(1)).alias("places"))


def _slice(key: str) -> Column:
    return F.floor(F.col(key) / SLICE).cast("long").alias("slice")


def write_kept_index(index: DataFrame, key: str, path: str) -> str:
    """Store an index in slices of whole-number keys; rebalancing splits a slice with many words over files."""
    _write_slices(index.select("*", _slice(key)), key, path)
    return path


def _write_slices(postings: DataFrame, key: str, path: str) -> None:
    (
        postings.hint("rebalance", "slice").sortWithinPartitions("slice", "token", key)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("slice").parquet(path)
    )


def update_index(spark: SparkSession, path: str, key: str, changed: DataFrame, columns: list[str], gone: DataFrame | None = None) -> None:
    """Put the postings of changed or new rows, and of no longer existing ones, right in a kept index.

    Only slices with such a key are read and written again; they are replaced when all of them are written. A row whose
    words have all gone leaves no posting. An update that failed is run again with the same rows.
    """
    keys = changed.select(key)
    if gone is not None:
        keys = keys.unionByName(gone.select(key))
    slices = keys.select(_slice(key)).distinct()
    old = spark.read.parquet(path).join(slices, "slice", "left_semi").join(keys, key, "left_anti")
    new = token_index(changed, key, columns).select("*", _slice(key))
    kept = scratch_path(spark, "index-slices")
    merged = old.select(*new.columns).unionByName(new)
    # A touched slice with no posting left is written with a row that stands for nothing, so that its old files go.
    empty = slices.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in new.schema if f.name != "slice"], "slice")
    merged.unionByName(empty.select(*new.columns)).write.parquet(kept)
    _write_slices(spark.read.parquet(kept), key, path)


def read_kept_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).filter(F.col("token").isNotNull()).drop("slice")
