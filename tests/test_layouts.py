"""Layouts that joins use, months that are skipped, and reports kept up to date by month."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martlake import schemas
from martlake.plans import maintained, star
from martlake.plans.bridge import COPIES, Bridge
from martlake.session import FILE_BYTES, TABLES, configure, size_shuffles
from martlake.sources import tables

KEYS = schemas.STAR_KEYS["sales_facts"]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def facts(spark, n=600, month=1):
    return spark.range(n).selectExpr(
        "CAST(id % 50 AS INT) AS film_id", "CAST(id % 7 AS INT) AS customer_id", "CAST(id % 3 AS INT) AS staff_id",
        f"CAST(20200000 + 100 * ({month} + id % 3) + 1 + id % 28 AS INT) AS date_id", "CAST(id AS DECIMAL(8,2)) AS amount",
    )


@pytest.fixture(scope="module")
def dims(spark):
    films = [(k, "G" if k % 2 else None) for k in range(50)]
    return {
        "sales_facts": facts(spark),
        "date_dim": star.build_date_dim(spark, "2020-01-01", 400),
        "film_dim": spark.createDataFrame(films, "film_id int, rating string"),
    }


def test_merge_shuffles_the_stage_only(spark, tmp_path):
    target = tables.write_dealt(facts(spark), "dealt_facts", str(tmp_path / "facts"), KEYS, 4)
    assert len(list((tmp_path / "facts").glob("part-*"))) == 4
    stage = facts(spark, 40).unionByName(facts(spark, 1).withColumn("film_id", F.lit(None).cast("int")))
    stage = stage.withColumn("amount", F.lit("7.00").cast("decimal(8,2)"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = tables.merge_dealt(target, stage, KEYS, 4)
        text = plan(merged)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    below = text[text.index("LeftAnti") :]
    fact_side = below[: below.index("dealt_facts")]
    assert "Bucketed: true" in text and "Exchange" not in fact_side
    wanted = {tuple(r[k] for k in KEYS) for r in stage.collect()}
    kept = [tuple(r) for r in target.collect() if tuple(r[k] for k in KEYS) not in wanted]
    assert rows(merged) == sorted(kept + [tuple(r) for r in stage.collect()], key=str)
    # Two tables dealt alike meet without a shuffle.
    other = tables.write_dealt(merged, "dealt_again", str(tmp_path / "again"), KEYS, 4)
    both = plan(target.hint("merge").join(other, KEYS))
    assert "SortMergeJoin" in both and "Exchange" not in both
    for name in ("dealt_facts", "dealt_again"):
        spark.sql(f"DROP TABLE {name}")


def test_months_follow_from_moments(spark, tmp_path):
    moments = [(k, datetime.datetime(2020, 1, 1) + datetime.timedelta(days=k)) for k in range(180)]
    df = spark.createDataFrame(moments, "payment_id int, payment_date timestamp")
    path = tables.write_partitioned(df, str(tmp_path / "payment"))
    found = tables.read_between(spark, path, df.schema, "2020-02-10", "2020-04-01")
    assert found.count() == 51
    filters = plan(found).split("PartitionFilters: [")[1].split("]")[0]
    assert "2020-02" in filters and "2020-04" in filters


def test_dates_pick_months_while_the_query_runs(spark, tmp_path, dims):
    tables.write_fact_months(dims["sales_facts"], str(tmp_path / "facts"))
    dims["date_dim"].write.parquet(str(tmp_path / "dates"))
    dates = spark.read.parquet(str(tmp_path / "dates")).filter("month = 2")
    stored = maintained.read_facts(spark, str(tmp_path / "facts"), dims["sales_facts"].schema)
    joined = tables.join_dates(stored, dates)
    assert "dynamicpruning" in plan(joined).lower()
    assert joined.count() == dims["sales_facts"].filter("date_id div 100 = 202002").count()


@pytest.mark.parametrize("name", sorted(maintained.REPORTS))
def test_reports_are_kept_by_month(spark, tmp_path, dims, name):
    path, base = str(tmp_path / "facts"), str(tmp_path / "sums")
    tables.write_fact_months(dims["sales_facts"], path)
    maintained.refresh(spark, name, path, dims, base)
    files = {f for f in (tmp_path / "sums").rglob("*.parquet")}
    old = {f for f in (tmp_path / "facts").rglob("*.parquet")}
    stage = dims["sales_facts"].filter("date_id div 100 = 202002 AND film_id < 20").withColumn("amount", F.lit(Decimal("1.00")))
    months = maintained.replace_facts(spark, path, stage)
    assert months == ["202002"]
    maintained.refresh(spark, name, path, dims, base, months)
    for before, top in ((files, "sums"), (old, "facts")):
        now = {f for f in (tmp_path / top).rglob("*.parquet")}
        assert {f.parent.name for f in before - now} == {f"{tables.MONTH}=202002"}
    touched = maintained.read_facts(spark, path, dims["sales_facts"].schema, months)
    assert "PartitionFilters: [fact_month" in plan(touched).replace("isnotnull(fact_month#", "fact_month")
    kept = maintained.read_report(spark, name, base)
    maintained.refresh(spark, name, path, dims, str(tmp_path / "whole"))
    assert rows(kept) == rows(maintained.read_report(spark, name, str(tmp_path / "whole")))


def test_month_that_is_empty_counts_no_longer(spark, tmp_path, dims):
    path, base, name = str(tmp_path / "facts"), str(tmp_path / "sums"), "daily_average_sales"
    tables.write_fact_months(dims["sales_facts"], path)
    maintained.refresh(spark, name, path, dims, base)
    # The month's facts are taken away by hand.
    tables.write_fact_months(dims["sales_facts"].filter("date_id div 100 <> 202002"), str(tmp_path / "less"))
    maintained.refresh(spark, name, str(tmp_path / "less"), dims, base, ["202002"])
    maintained.refresh(spark, name, str(tmp_path / "less"), dims, str(tmp_path / "whole"))
    assert rows(maintained.read_report(spark, name, base)) == rows(maintained.read_report(spark, name, str(tmp_path / "whole")))


def test_items_are_not_counted_as_parts(spark, tmp_path):
    """The copies of many parts are too large for a broadcast, and the plan knows it."""
    n = 60_000
    part = spark.range(n).select(F.col("id").alias("p_partkey"), F.concat(F.lit("part "), "id").alias("p_name"))
    missing = [f for f in schemas.GIVEN["part"].fields if f.name not in part.columns]
    part.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}).write.parquet(f"{tmp_path}/part.parquet")
    items = Bridge(configure(spark, TABLES), str(tmp_path)).inventory()
    try:
        assert items.count() == n * COPIES
        assert items.agg(F.countDistinct("inventory_id")).first()[0] == n * COPIES
        known = int(str(items._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        assert known > 10 * 1024 * 1024
    finally:
        for key in TABLES:
            spark.conf.unset(key)


def test_items_of_one_file_are_dealt_to_many_tasks(spark, tmp_path):
    one = spark.range(50).coalesce(1).select(F.col("id").alias("p_partkey"))
    missing = [f for f in schemas.GIVEN["part"].fields if f.name != "p_partkey"]
    one.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}).write.parquet(f"{tmp_path}/part.parquet")
    items = Bridge(spark, str(tmp_path)).inventory()
    held = items.groupBy(F.spark_partition_id()).count().collect()
    assert len(held) == COPIES and all(r["count"] == 50 for r in held)


def test_shuffles_grow_with_the_files(spark, tmp_path):
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(name, None)
    with open(tmp_path / "big.bin", "wb") as out:
        out.truncate(100 * FILE_BYTES)
    try:
        size_shuffles(spark, str(tmp_path))
        assert int(spark.conf.get(name)) == 100
        assert spark.range(1000).groupBy(F.col("id") % 7).count().count() == 7
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
