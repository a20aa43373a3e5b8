"""Mix sources to target weights by repeating and thinning documents.

Sources in code-point order, null last, take the weights in turn and share all words by weight; a target stops at
`cap` times the words of its source, and what is left over is shared again by weight. A source is thus repeated
target / words times: each of its documents is taken floor(rate) times, and once more if a number hashed from
a seed, the document's id, its text's checksum and its place among rows equal in both falls below the fraction. Per source, the first of `SEEDS` seeds that brings its
taken words nearest to the target is used, so reruns agree and small sources stay near their targets.

Defined cases: a null text has no words; a null source is a source of its own, last in order; rows that repeat an
id or have none draw each by itself, equal rows too; a source without words has target 0 and is left out of the mix; texts of any
length count whole; no rows give no rows; helper columns get a prefix that no column of the input begins with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlake.llm.common import small, stored, unused

WORD = r"[^\x20\x09-\x0D]+"
SEEDS = 16
UNIT = 4294967296  # 2**32


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draws(key: Column) -> Column:
    """SEEDS numbers from 0 to 2**32 - 1 for each key, four from each MD5."""
    digests = [F.md5(F.concat(F.lit(f"{k}:"), key)) for k in range(SEEDS // 4)]
    return F.array(*[F.conv(F.substring(d, 1 + 8 * i, 8), 16, 10).cast("long") for d in digests for i in range(4)])


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3) -> DataFrame:
    """One row per source of (source, size) rows: source_size, target, rate.

    A capped share is the fixed point of sharing the excess again: with sources ordered by cap over weight, those
    whose cap is below their share of what the earlier ones leave are capped. One row per source is sorted.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), place % len(weights) + 1)
    capped = sources.withColumns({"weight": weight, "most": F.col("source_size") * cap})
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    shared = capped.withColumns(
        {
            "left": F.sum("source_size").over(everything)
            - F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "weights": F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)),
            "place": F.row_number().over(order),
        }
    )
    full = F.col("most") * F.col("weights") <= F.col("weight") * F.col("left")
    shared = shared.withColumn("full", full)
    # The first source that is not full fixes the share of one unit of weight for all after it.
    rest = F.min(F.when(~F.col("full"), F.struct("place", "left", "weights"))).over(everything)
    target = F.when(
        rest.isNull() | (F.col("place") < rest["place"]), F.col("most").cast("double")
    ).otherwise((F.col("weight") * rest["left"]).cast("double") / rest["weights"].cast("double"))
    shared = shared.withColumn("target", target)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size").cast("double")).otherwise(F.lit(0.0))
    return shared.select("source", "source_size", "target", rate.alias("rate"))


def copies(rate: Column, draw: Column) -> Column:
    whole = F.floor(rate)
    extra = draw.cast("double") < (rate - whole.cast("double")) * F.lit(float(UNIT))
    return whole + extra.cast("long")


def mix_plan(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3) -> DataFrame:
    """One row per source of (key, source, size) rows: source_size, target, rate, and the seed to draw with."""
    targets = small(stored(source_targets(sizes, weights, cap), "mix-targets"))
    s, t = sizes.alias("s"), targets.alias("t")
    drawn = s.join(t, F.col("s.source").eqNullSafe(F.col("t.source"))).select(
        "s.size", "t.*", draws(F.col("s.key")).alias("draws")
    )
    taken = [
        F.sum(F.col("size") * copies(F.col("rate"), F.col("draws")[k])).cast("double").alias(f"taken{k}")
        for k in range(SEEDS)
    ]
    sums = drawn.groupBy("source", "source_size", "target", "rate").agg(*taken)
    misses = F.array(*[F.abs(F.col(f"taken{k}") - F.col("target")) for k in range(SEEDS)])
    seed = (F.array_position(misses, F.array_min(misses)) - 1).cast("int")
    return sums.select("source", "source_size", "target", "rate", seed.alias("seed"))


def keyed(docs: DataFrame, key: str, id_col: str, text_col: str) -> DataFrame:
    """The rows with a column `key` to draw by: id, checksum of the text, and the place among rows equal in both.

    Only rows that have an equal are written and numbered, by task and place in it, so a hot group is spread over tasks.
    """
    own = F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    rows = docs.withColumn(key, own)
    counts = rows.groupBy(key).count().filter("count > 1").select(F.col(key).alias(f"{key}_again"))
    again = small(stored(counts, "mix-again"))
    same = F.col(key) == F.col(f"{key}_again")
    alone = rows.join(again, same, "left_anti").withColumn(key, F.concat(key, F.lit(":0")))
    if not again.limit(1).count():
        return alone
    part, at, before = f"{key}_part", f"{key}_at", f"{key}_before"
    equal = stored(rows.join(again, same, "left_semi").withColumn(part, F.spark_partition_id()), "mix-equal")
    order = Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = equal.groupBy(key, part).agg(F.count("*").alias("n"))
    offsets = offsets.select(key, part, F.coalesce(F.sum("n").over(order), F.lit(0)).alias(before))
    within = Window.partitionBy(key, part).orderBy(F.xxhash64(F.to_json(F.struct(*docs.columns))))
    numbered = equal.withColumn(at, F.row_number().over(within) - 1).join(offsets, [key, part])
    place = (F.col(before) + F.col(at)).cast("string")
    return alone.unionByName(numbered.withColumn(key, F.concat_ws(":", key, place)).select(*docs.columns, key))


def sized(rows: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    return stored(
        rows.select(
            F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col(key).alias("key"),
            count_words(F.col(text_col)).alias("size"),
        ),
        "mix-sizes",
    )


def mixed(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    cap: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns they came with."""
    key = unused(docs) + "key"
    rows = keyed(docs, key, id_col, text_col)
    plan = small(stored(mix_plan(sized(rows, key, id_col, text_col, source_col), weights, cap), "mix-plan"))
    d, p = rows.alias("d"), plan.alias("p")
    n = copies(F.col("p.rate"), F.element_at(draws(F.col(f"d.{key}")), F.col("p.seed") + 1))
    joined = d.join(p, F.col(f"d.{source_col}").eqNullSafe(F.col("p.source")))
    # Lines up as many marks as copies (at most cap), and drops the marks again.
    repeated = joined.select(F.struct(*[F.col(f"d.`{c}`") for c in docs.columns]).alias("row"), F.explode(F.array_repeat(F.lit(1), n.cast("int"))))
    return repeated.select("row.*")
