"""From raw documents to training tokens: toxicity, quality rules, near duplicates, mixing, byte-level BPE.

Each stage is one of the corpus operators, works on everything its predecessor kept, and returns the columns of the
documents; the last returns the tokens of each document of the mix. `run` writes every stage below the shared
folder and reads it back, so a lost executor costs no more than the stage it was busy with.

Defined cases, for every stage: a null or empty text passes the toxicity stage on its own score and falls to the base rules of the
quality stage; rows that repeat an id or have none are rows of their own, of near duplicates among them one stays; texts of any
length are read whole; without labels nothing is learnt and only base rules reject; an empty table gives no rows; other columns are
carried along up to the last stage, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.llm import mixing, neardup, quality, tokens, toxicity
from martlake.llm.common import prepare, stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression model does not predict to be toxic; the model learns from the stage's own input."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the cutoffs certified on the labelled rows among them."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80% of its five-word shingles."""
    prepare(spark)
    return neardup.keep_one(docs, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, repeated and thinned so that sources meet their target weights."""
    prepare(spark)
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every document of the mix, with a checksum of the ids and whether they decode to the text."""
    prepare(spark)
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    columns = ["doc_id", "text", "lang", "source"]
    plain = docs.select(*columns, F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
    coded = tokens.encoded(plain, path, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        "lang",
        "source",
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        (F.sha2("decoded", 256) == F.col("text_sha256")).alias("round_trip"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", apply_quality_rules),
    ("MinHash near-dedup", drop_near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode),
]

#: Compression, trained cutoffs and MinHash have no counterpart in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from the table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
