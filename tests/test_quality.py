import datetime
from decimal import Decimal as D

from pyspark.sql import functions as F

from martlake import schemas
from martlake.operators import quality
from martlake.sources.tables import outside_months


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_null(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "k INT, v STRING")
    assert rows(quality.check_null(df, ["k"])) == [(None, "b")]
    assert len(rows(quality.check_null(df, ["k", "v"]))) == 2


def test_unique(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1), (None, 1)], "k INT, j INT")
    assert rows(quality.check_unique(df, ["k", "j"])) == [(1, 1, 2)]
    assert rows(quality.check_unique(df, ["k"])) == [(1, 3)]


def test_foreign_key(spark):
    child = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "id INT, parent INT")
    parent = spark.createDataFrame([(10,)], "parent_id INT")
    assert rows(quality.check_fk(child, "parent", parent, "parent_id")) == [(2, 99)]


def test_restrict(spark):
    removed = spark.createDataFrame([(1, "a"), (2, "b")], "k INT, v STRING")
    child = spark.createDataFrame([(2,), (2,), (3,)], "parent INT")
    assert rows(quality.check_restrict(removed, "k", child, "parent")) == [(2, "b")]


def test_cascade(spark):
    child = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "id INT, parent INT")
    moved = spark.createDataFrame([(10, 11)], "old INT, new INT")
    assert rows(quality.cascade(child, "parent", moved)) == [(1, 11), (2, 20), (3, None)]


def test_range_and_enum_let_null_pass(spark):
    df = spark.createDataFrame([(1900, "G"), (1901, "PG-13"), (2155, None), (2156, "X"), (None, "g")], "y INT, rating STRING")
    assert [r.y for r in quality.check_range(df, "y", *schemas.YEAR_RANGE).orderBy("y").collect()] == [1900, 2156]
    assert [r.rating for r in quality.check_enum(df, "rating", schemas.RATINGS).orderBy("rating").collect()] == ["X", "g"]


def test_bounds_are_half_open(spark):
    moments = ["2019-12-31 23:59:59", "2020-01-01 00:00:00", "2020-06-30 23:59:59", "2020-07-01 00:00:00", None]
    df = spark.createDataFrame([(m,) for m in moments], "m STRING").select(F.col("m").cast("timestamp").alias("payment_date"))
    found = [str(r.payment_date) if r.payment_date else None for r in outside_months(df).collect()]
    assert sorted(found, key=str) == ["2019-12-31 23:59:59", "2020-07-01 00:00:00", None]


def test_length(spark):
    df = spark.createDataFrame([("a" * 254, "PG-13"), ("a" * 255, "G"), (None, "x" * 11)], "title STRING, rating STRING")
    assert quality.check_length(df, schemas.STAR_LENGTHS["film_dim"]).count() == 2


def _valid(spark):
    now = datetime.datetime(2020, 1, 1)
    data = {
        "country": [(1, "C", now)],
        "city": [(1, "c", 1, now)],
        "address": [(1, "a", None, "d", 1, None, "p", now)],
        "language": [(1, "English", now)],
        "film": [(1, "T", None, 2000, 1, None, 3, D("4.99"), None, D("9.99"), "G", now, None, [])],
        "category": [(1, "Drama", now)],
        "film_category": [(1, 1, now)],
        "actor": [(1, "A", "B", now)],
        "film_actor": [(1, 1, now)],
        "store": [(1, 1, 1, now)],
        "staff": [(1, "A", "B", 1, None, 1, True, "u", None, now, None)],
        "customer": [(1, 1, "A", "B", None, 1, True, now.date(), None, None)],
        "inventory": [(1, 1, 1, now)],
        "rental": [(1, now, 1, 1, None, 1, now)],
        "payment": [(1, 1, 1, 1, D("1.00"), now)],
    }
    return {name: spark.createDataFrame(r, schemas.OLTP[name]) for name, r in data.items()}


def test_all_declared_constraints(spark):
    tables = _valid(spark)
    checks = quality.check_tables(tables)
    assert len([c for c in checks if ".fk(" in c]) == 21
    assert len([c for c in checks if ".unique(" in c]) == 16
    merged = None
    for name, df in checks.items():
        one = df.select(F.lit(name).alias("rule"))
        merged = one if merged is None else merged.unionByName(one)
    assert merged.collect() == []


def test_audit_counts_what_the_checks_list(spark):
    tables = _valid(spark)
    assert [tuple(r) for r in quality.audit(tables).filter("violations <> 0").collect()] == []
    film = tables["film"]
    tables["film"] = film.unionByName(film.withColumn("rating", F.lit("X")).withColumn("release_year", F.lit(1900)))
    tables["inventory"] = tables["inventory"].unionByName(tables["inventory"]).withColumn("store_id", F.lit(9))
    tables["rental"] = tables["rental"].withColumn("rental_date", F.lit(None).cast("timestamp"))
    del tables["language"]
    tables["actor"] = tables["actor"].drop("last_name")
    found = {r.rule: r.violations for r in quality.audit(tables).filter("violations IS NULL OR violations <> 0").collect()}
    assert found == {
        "film.unique(film_id)": 1, "film.rating": 1, "film.release_year": 1, "inventory.fk(store_id)": 2,
        "inventory.unique(inventory_id)": 1, "rental.not_null(rental_date)": 1, "film.fk(language_id)": None,
        "film.fk(original_language_id)": None, "actor.not_null(last_name)": None,
    }


def test_broken_rows_are_named(spark):
    tables = _valid(spark)
    film = tables["film"]
    tables["film"] = film.unionByName(film.withColumn("rating", F.lit("X")).withColumn("release_year", F.lit(1900)))
    tables["inventory"] = tables["inventory"].withColumn("store_id", F.lit(9))
    broken = {name for name in ("film.unique(film_id)", "film.rating", "film.release_year", "inventory.fk(store_id)", "film.not_null")
              if not quality.check_tables(tables)[name].isEmpty()}
    assert broken == {"film.unique(film_id)", "film.rating", "film.release_year", "inventory.fk(store_id)"}


def test_audit_marks_are_narrow(spark):
    """Marks are as many as keys in all tables: a rule is a number and a key of one column its plain text."""
    store = spark.createDataFrame([(1,), (1,), (None,)], "store_id INT")
    marks, _ = quality._marks("store", store, {"store": store}, rules := {})
    found = store.select(F.explode(F.array(*marks)).alias("m")).select("m.*").filter("key IS NOT NULL")
    unique = rules["store.unique(store_id)"]
    assert rows(found.filter(F.col("rule") == unique).select("key")) == [("1",), ("1",)]
    counted = {r.rule: r.violations for r in quality.audit({"store": store}).collect()}
    assert counted["store.unique(store_id)"] == 1 and counted["store.not_null(store_id)"] == 1
