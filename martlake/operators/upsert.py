"""Table merges as joins: update on conflict, insert if absent, delete then insert.

Each takes the whole target and a stage and returns the new target. All are anti-joins: a small
stage is broadcast by its size, a large one is shuffled. Spark can split a hot key on the left of such a join if
the join's shuffle stands directly under it, so keys of the right side are combined within tasks only
(`operators/lookup.py`). Keys that must be unique are counted by themselves before the merge.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlake.operators.lookup import anti_join


def _any_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def require_filled(df: DataFrame, keys: list[str], what: str = "stage") -> DataFrame:
    """The same rows; raises when the plan runs if a key column is NULL."""
    key, kind = keys[0], df.schema[keys[0]].dataType
    checked = F.when(_any_null(keys), F.raise_error(F.lit(f"{what}: NULL in key {keys}"))).otherwise(F.col(key))
    return df.withColumn(key, checked.cast(kind))


def require_keys(df: DataFrame, keys: list[str], what: str = "stage") -> None:
    """Raise if a key is NULL or occurs twice.

    A job of its own that reads the key columns only; a repeated key travels as one row per task.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    bad = counts.filter((F.col("_n") > 1) | _any_null(keys)).select(_any_null(keys).alias("empty")).first()
    if bad is not None:
        raise ValueError(f"{what}: NULL in key {keys}" if bad["empty"] else f"{what}: more than one row for a key of {keys}")


def upsert_update(target: DataFrame, stage: DataFrame, keys: list[str], stamp: str | None = None) -> DataFrame:
    """Stage rows replace target rows of the same key and add the rest.

    ``stamp`` names a column that updated rows get the time of the run in; inserted rows keep theirs.
    """
    stage = stage.select(*target.columns)
    require_keys(stage, keys)
    kept = anti_join(target, stage, keys)
    if stamp:
        known = target.select(*keys).withColumn("_known", F.lit(True))
        stamped = F.when(F.col("_known"), F.current_timestamp()).otherwise(F.col(stamp))
        stage = stage.join(known, keys, "left").withColumn(stamp, stamped.cast(target.schema[stamp].dataType))
    return kept.unionByName(stage.select(*target.columns))


def insert_absent(target: DataFrame, stage: DataFrame, keys: list[str]) -> DataFrame:
    """Stage rows whose key the target lacks are added; of several for one key, the least row.

    A NULL in a stage key stops the job, as it does in ``upsert_update``.
    """
    others = [c for c in target.columns if c not in keys]
    fresh = require_filled(stage.select(*target.columns), keys)
    if others:
        fresh = fresh.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_row")).select(*keys, "_row.*")
    else:
        fresh = fresh.distinct()
    return target.unionByName(anti_join(fresh, target, keys).select(*target.columns))


def delete_insert(target: DataFrame, stage: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows matched by the stage go, all stage rows come in. A NULL key matches nothing."""
    stage = stage.select(*target.columns)
    return anti_join(target, stage, keys).unionByName(stage)


def apply_defaults(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Fill the columns an insert leaves out; a NULL that is given stays NULL."""
    return df.withColumns({name: value for name, value in defaults.items() if name not in df.columns})
