"""Right sides for semi- and anti-joins that leave Spark free to split a hot key on the left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def task_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """The keys of a table, each at most once for each task that holds it.

    Keys that are distinct over the whole table come out of an aggregate that is already dealt by the key, and a
    join on it then has no shuffle of its own to split. These are combined by key and task, so little
    travels, and the join's shuffle stands directly under it. Repeats do not matter to semi- and anti-joins.
    """
    by_task = df.select(*keys).withColumn("_task", F.spark_partition_id())
    return by_task.distinct().select(*keys)


def semi_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(task_keys(right, keys), keys, "left_semi").select(*left.columns)


def anti_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(task_keys(right, keys), keys, "left_anti").select(*left.columns)
