"""Versioned outputs: write beside what is being read, check, then make visible in one step.

``base/<table>/<run>`` holds what a run wrote. ``base/_manifest/<run>.json`` names the folders that make up each of
the run's tables, which may be folders of earlier runs; it is created, never overwritten, once all tables are
written and checked, so two publishers of one run id cannot both succeed. Readers follow the entry with the highest
number for a table. A run that dies before that leaves the last one in force and can be tried again.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlake.sources.files import create_new, delete, leaf_folders

MANIFEST = "run_id STRING, name STRING, path STRING, number BIGINT"


class CheckFailed(RuntimeError):
    """A table broke one of its checks; nothing was published."""


def _manifest(spark: SparkSession, base: str) -> DataFrame | None:
    try:
        return spark.read.schema(MANIFEST).json(f"{base}/_manifest")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":  # no run published yet
            return None
        raise


def read_folders(spark: SparkSession, base: str, name: str, paths: list[str], schema: T.StructType | None = None) -> DataFrame:
    """The folders of one table, of one run or several, with the partition columns of their names."""
    by_run = defaultdict(list)
    for path in paths:
        by_run[path.removeprefix(f"{base}/{name}/").split("/")[0]].append(path)
    parts = []
    for run, folders in sorted(by_run.items()):
        reader = spark.read.schema(schema) if schema else spark.read
        parts.append(reader.option("basePath", f"{base}/{name}/{run}").parquet(*folders))
    return reduce(DataFrame.unionByName, parts)


def publish(
    spark: SparkSession, tables: dict[str, DataFrame], base: str, run_id: str,
    checks: dict[str, list[Callable[[DataFrame], DataFrame]]] | None = None,
    writers: dict[str, Callable[[DataFrame, str], object]] | None = None,
    kept: dict[str, list[str]] | None = None,
    derived: Callable[[dict[str, DataFrame]], dict[str, DataFrame]] | None = None,
) -> dict[str, list[str]]:
    """Write all tables under ``run_id``, run their checks on what was written, publish together.

    A check returns violating rows. ``kept`` names folders of earlier runs that stay part of a table. ``derived`` makes
    more tables from those just written, such as stored reports, which become visible with them. A run id can be
    tried again until it is published, not after. Returns the folders of each table.
    """
    known = _manifest(spark, base)
    if known is not None and not known.filter(F.col("run_id") == run_id).isEmpty():
        raise ValueError(f"run {run_id} is already published")
    folders: dict[str, list[str]] = {}

    def write_all(some: dict[str, DataFrame]) -> None:
        for name, df in some.items():
            path = f"{base}/{name}/{run_id}"
            (writers or {}).get(name, _write_parquet)(df, path)
            folders[name] = [*(kept or {}).get(name, []), *leaf_folders(spark, path)]

    write_all(tables)
    for name, rules in (checks or {}).items():
        written = spark.read.parquet(f"{base}/{name}/{run_id}")
        for rule in rules:
            if not rule(written).isEmpty():
                raise CheckFailed(f"{name} of run {run_id} broke a check")
    if derived:
        write_all(derived({name: read_folders(spark, base, name, folders[name]) for name in tables}))
    highest = known.agg(F.max("number")).first()[0] if known is not None else None
    rows = [
        {"run_id": run_id, "name": name, "path": path, "number": (highest or 0) + 1}
        for name, paths in folders.items()
        for path in paths
    ]
    if not create_new(spark, f"{base}/_manifest/{run_id}.json", "".join(json.dumps(r) + "\n" for r in rows)):
        raise ValueError(f"run {run_id} is already published")
    return folders


def _write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def published_folders(spark: SparkSession, base: str) -> dict[str, tuple[str, list[str]]]:
    """For every table the run that holds its newest version, and its folders; one row per folder."""
    known = _manifest(spark, base)
    if known is None:
        return {}
    newest = known.groupBy("name").agg(F.max(F.struct("number", "run_id")).alias("top"))
    rows = known.join(newest, "name").filter("run_id = top.run_id AND number = top.number").orderBy("name", "path")
    found: dict[str, tuple[str, list[str]]] = {}
    for row in rows.select("name", "run_id", "path").collect():
        found.setdefault(row["name"], (row["run_id"], []))[1].append(row["path"])
    return found


def published_run(spark: SparkSession, base: str, name: str) -> str | None:
    """The run that holds the newest version of one table."""
    found = published_folders(spark, base).get(name)
    return found[0] if found else None


def read_published(spark: SparkSession, base: str, name: str, schema: T.StructType | None = None) -> DataFrame:
    found = published_folders(spark, base).get(name)
    if found is None:
        raise LookupError(f"no published version of {name} below {base}")
    return read_folders(spark, base, name, found[1], schema)


def drop_old_versions(spark: SparkSession, base: str, keep: int = 1) -> list[str]:
    """Remove the folders that none of the newest ``keep`` versions of their table refers to, and the manifest
    entries of runs that are left with no table. Returns the folders.

    To be called when no reader of the older versions is left.
    """
    known = _manifest(spark, base)
    if known is None:
        return []
    rows = known.collect()  # one row per folder of a version
    numbers = defaultdict(set)
    for row in rows:
        numbers[row["name"]].add((row["number"], row["run_id"]))
    fresh = {name: set(sorted(versions)[-keep:]) for name, versions in numbers.items()}
    used = {r["path"] for r in rows if (r["number"], r["run_id"]) in fresh[r["name"]]}
    dropped = sorted({r["path"] for r in rows} - used)
    for path in dropped:
        delete(spark, path)
    live = {run for versions in fresh.values() for _, run in versions}
    for run in {r["run_id"] for r in rows} - live:
        delete(spark, f"{base}/_manifest/{run}.json")
    return dropped


def rebuild_swap(spark: SparkSession, name: str, df: DataFrame, base: str, run_id: str) -> DataFrame:
    """Build a table anew beside the old version, then point its name at the new one."""
    publish(spark, {name: df}, base, run_id)
    fresh = read_published(spark, base, name)
    fresh.createOrReplaceTempView(name)
    return fresh
