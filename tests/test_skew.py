"""A third of all rows on one key: results stay whole, and the work is split or combined early.

Brute force on plain Python lists gives the expected numbers.
"""

import collections
import datetime

import pytest
from pyspark.sql import functions as F

from martlake.operators import quality, rentals, upsert, weather
from martlake.plans import reports, star
from martlake.sources import tables

N = 30_000


@pytest.fixture(scope="module")
def hot(spark):
    """Rental 0 holds a third of the payments, item 0 a third of the rentals, film 0 of the items."""
    payment = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 6000).cast("int").alias("rental_id"),
        F.lit(1).alias("customer_id"),
        F.lit(1).alias("staff_id"),
        (F.col("id") % 100 + 1).cast("decimal(5,2)").alias("amount"),
        F.expr("TIMESTAMP '2020-01-01' + make_dt_interval(CAST(id % 300 AS INT))").alias("payment_date"),
    )
    rental = spark.range(6000).selectExpr(
        "CAST(id AS INT) AS rental_id", "CAST(IF(id % 3 = 0, 0, id % 500) AS INT) AS inventory_id",
        "CAST(id % 50 AS INT) AS customer_id", "IF(id % 4 = 0, NULL, TIMESTAMP '2020-02-01') AS return_date",
    )
    inventory = spark.range(500).selectExpr("CAST(id AS INT) AS inventory_id", "CAST(IF(id % 3 = 0, 0, id % 20) AS INT) AS film_id", "1 AS store_id")
    film = spark.range(20).selectExpr("CAST(id AS INT) AS film_id", "element_at(array('G', 'PG', 'R'), CAST(id % 3 + 1 AS INT)) AS rating")
    return payment, rental, inventory, film


def brute_weekly():
    totals = collections.Counter()
    for i in range(N):
        rental = 0 if i % 3 == 0 else i % 6000
        item = 0 if rental % 3 == 0 else rental % 500
        film = 0 if item % 3 == 0 else item % 20
        week = (datetime.date(2020, 1, 1) + datetime.timedelta(days=i % 300)).isocalendar()[1]
        rating = ("G", "PG", "R")[film % 3]
        for key in ((week, rating), (week, None), (None, rating), (None, None)):
            totals[key] += i % 100 + 1
    return dict(totals)


@pytest.fixture
def small_limits(spark):
    """Thresholds at which this small data counts as large and skewed."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_weekly_cube_is_whole(hot):
    cube = reports.weekly_sales_cube(*hot)
    assert {(r.week, r.rating): int(r.sales) for r in cube.collect()} == brute_weekly()


def test_hot_join_keys_are_split(spark, hot, small_limits):
    cube = reports.weekly_sales_cube(*hot)
    assert {(r.week, r.rating): int(r.sales) for r in cube.collect()} == brute_weekly()
    plan = cube._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan
    assert "BroadcastNestedLoop" not in plan and "Cartesian" not in plan


def test_grouping_sets_expand_the_grain_only(hot):
    """The rows are summed by week and rating before they are multiplied for the cube."""
    plan = reports.weekly_sales_cube(*hot)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    expand = next(i for i, line in enumerate(lines) if "Expand" in line)
    assert "HashAggregate" in lines[expand + 1]


def test_stock_with_a_hot_item(hot):
    _, rental, inventory, _ = hot
    out = {0 if i % 3 == 0 else i % 500 for i in range(6000) if i % 4 == 0}
    assert {r.inventory_id for r in rentals.film_not_in_stock(inventory, rental).collect()} == out
    assert {r.inventory_id for r in rentals.film_in_stock(inventory, rental).collect()} == set(range(500)) - out
    held = {r.inventory_id: r.customer_id for r in rentals.held_by(rental).collect()}
    assert set(held) == out and held[0] == 0


def lookups(spark, hot):
    """Joins whose left side holds a third of its rows on one key, with the number of rows they return."""
    _, rental, inventory, _ = hot
    out = {0 if i % 3 == 0 else i % 500 for i in range(6000) if i % 4 == 0}
    left = spark.range(N).selectExpr("id", "CAST(IF(id % 3 = 0, 0, id % 500) AS INT) AS inventory_id").repartition(8)
    shelf = left.selectExpr("inventory_id", "id AS film_id", "1 AS store_id")
    hit = sum((0 if i % 3 == 0 else i % 500) in out for i in range(N))
    some = spark.range(400).selectExpr("CAST(id AS INT) AS inventory_id", "id").repartition(8)
    known = sum((0 if i % 3 == 0 else i % 500) < 400 for i in range(N))
    moved = spark.range(400).selectExpr("CAST(id AS INT) AS old", "CAST(id + 1000 AS INT) AS new").repartition(8)
    return {
        "stock": (rentals.stock(shelf, rental), N),
        "items_in_stock": (rentals.items_in_stock(left, rental), N),
        "film_in_stock": (rentals.film_in_stock(shelf, rental), N - hit),
        "film_not_in_stock": (rentals.film_not_in_stock(shelf, rental), hit),
        "delete_insert": (upsert.delete_insert(left, some.select("id", "inventory_id"), ["inventory_id"]), N - known + 400),
        "check_fk": (quality.check_fk(left, "inventory_id", some, "inventory_id"), N - known),
        "check_restrict": (quality.check_restrict(left, "inventory_id", some, "inventory_id"), known),
        "cascade": (quality.cascade(left, "inventory_id", moved), N),
    }


@pytest.mark.parametrize(
    "name", "stock items_in_stock film_in_stock film_not_in_stock delete_insert check_fk check_restrict cascade".split()
)
def test_hot_keys_of_lookups_are_split(spark, hot, small_limits, name):
    df, rows = lookups(spark, hot)[name]
    assert len(df.collect()) == rows
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_facts_of_a_hot_key(hot):
    payment, rental, inventory, _ = hot
    doubled = payment.unionByName(payment)
    facts = star.build_sales_facts(doubled, rental, inventory)
    expected = set()
    for i in range(N):
        item = 0 if (0 if i % 3 == 0 else i % 6000) % 3 == 0 else (i % 6000) % 500
        film = 0 if item % 3 == 0 else item % 20
        expected.add((film, i % 300, i % 100 + 1))
    assert facts.count() == len(expected)


def test_delete_insert_with_a_hot_stage_key(spark):
    target = spark.range(1000).selectExpr("IF(id < 300, NULL, id) AS k", "'old' AS v")
    stage = spark.range(3000).selectExpr("IF(id % 3 = 0, 500, id + 10000) AS k", "'new' AS v")
    merged = upsert.delete_insert(target, stage, ["k"])
    assert merged.count() == 999 + 3000
    assert merged.filter("v = 'old' AND k = 500").count() == 0
    assert merged.filter("k = 500").count() == 1000
    assert merged.filter("k IS NULL").count() == 300


def test_hot_day_of_facts_goes_to_several_files(spark, tmp_path, small_limits):
    facts = spark.range(N).selectExpr(
        "CAST(IF(id % 3 = 0, 20200101, 20200102 + id % 20) AS INT) AS date_id", "CAST(id % 7 AS INT) AS film_id",
        "CAST(id AS INT) AS customer_id", "1 AS staff_id",
    )
    path = tables.write_fact(facts.repartition(8), str(tmp_path / "facts"))
    kept = spark.read.parquet(path)
    files = kept.filter("date_id = 20200101").select(F.input_file_name()).distinct().count()
    assert files >= 2 and kept.count() == N


def test_day_delivered_over_and_over(spark):
    days = spark.range(N).selectExpr(
        "IF(id % 3 = 0, 'hot', CONCAT('l', id % 100)) AS location", "DATE '2020-01-01' AS date", "id"
    )
    newest = {r.location: r.id for r in weather.latest_per_day(days, ["location", "date"], [F.col("id").desc()]).collect()}
    expected = {}
    for i in range(N):
        expected["hot" if i % 3 == 0 else f"l{i % 100}"] = i
    assert newest == expected


def test_keys_and_references_with_a_hot_value(spark):
    child = spark.range(N).selectExpr("id", "IF(id % 3 = 0, -1, id % 100) AS parent")
    parent = spark.range(50).withColumnRenamed("id", "pid").unionByName(spark.range(50).withColumnRenamed("id", "pid"))
    orphans = quality.check_fk(child, "parent", parent, "pid")
    assert orphans.count() == sum(1 for i in range(N) if i % 3 == 0 or i % 100 >= 50)
    repeated = {r.parent: r.n for r in quality.check_unique(child, ["parent"]).collect()}
    assert repeated[-1] == N // 3
