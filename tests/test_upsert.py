import datetime

import pytest
from pyspark.sql import functions as F

from martlake import schemas
from martlake.operators import quality, upsert
from martlake.operators.keys import assign_keys, next_key
from martlake.session import drop_scratch, scratch_path


def table(spark, rows, ddl="k INT, v STRING"):
    return spark.createDataFrame(rows, ddl)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_upsert_update(spark):
    target = table(spark, [(1, "a"), (2, "b"), (3, "c")])
    stage = table(spark, [(2, "B"), (3, "c"), (4, "D")])
    once = upsert.upsert_update(target, stage, ["k"])
    assert rows(once) == [(1, "a"), (2, "B"), (3, "c"), (4, "D")]
    assert rows(upsert.upsert_update(once, stage, ["k"])) == rows(once)


@pytest.mark.parametrize("bad, message", [([(2, "x"), (2, "y")], "more than one row"), ([(None, "x")], "NULL in key")])
def test_upsert_refuses_bad_keys(spark, bad, message):
    with pytest.raises(Exception, match=message):
        upsert.upsert_update(table(spark, [(1, "a")]), table(spark, bad), ["k"]).collect()


def test_upsert_two_keys_and_other_column_order(spark):
    target = table(spark, [(1, 1, "a"), (1, 2, "b")], "k INT, j INT, v STRING")
    stage = table(spark, [("B", 2, 1)], "v STRING, j INT, k INT")
    assert rows(upsert.upsert_update(target, stage, ["k", "j"])) == [(1, 1, "a"), (1, 2, "B")]


def test_stamp_marks_updated_rows_only(spark):
    old = datetime.datetime(2000, 1, 1)
    target = table(spark, [(1, old), (2, old)], "k INT, last_update TIMESTAMP")
    stage = table(spark, [(2, old), (3, old)], "k INT, last_update TIMESTAMP")
    merged = upsert.upsert_update(target, stage, ["k"], stamp="last_update")
    assert {r.k: r.last_update > old for r in merged.collect()} == {1: False, 2: True, 3: False}


def test_insert_absent(spark):
    target = table(spark, [(1, "a")])
    stage = table(spark, [(1, "x"), (2, "z"), (2, "y")])
    once = upsert.insert_absent(target, stage, ["k"])
    assert rows(once) == [(1, "a"), (2, "y")]
    assert rows(upsert.insert_absent(once, stage, ["k"])) == rows(once)


def test_insert_absent_refuses_null_key(spark):
    with pytest.raises(Exception, match="NULL in key"):
        upsert.insert_absent(table(spark, [(1, "a")]), table(spark, [(None, "n")]), ["k"]).collect()


def test_insert_absent_of_keys_alone(spark):
    target, stage = table(spark, [(1,)], "k INT"), table(spark, [(1,), (2,), (2,)], "k INT")
    assert rows(upsert.insert_absent(target, stage, ["k"])) == [(1,), (2,)]


def test_delete_insert_keeps_duplicates_and_nulls(spark):
    target = table(spark, [(1, "a"), (2, "b"), (None, "n")])
    stage = table(spark, [(2, "x"), (2, "y"), (None, "m")])
    merged = upsert.delete_insert(target, stage, ["k"])
    assert rows(merged) == sorted([(1, "a"), (None, "n"), (2, "x"), (2, "y"), (None, "m")], key=repr)


def test_delete_insert_is_idempotent_on_filled_keys(spark):
    target, stage = table(spark, [(1, "a"), (2, "b")]), table(spark, [(2, "x"), (3, "y")])
    once = upsert.delete_insert(target, stage, ["k"])
    assert rows(upsert.delete_insert(once, stage, ["k"])) == rows(once) == [(1, "a"), (2, "x"), (3, "y")]


def test_delete_insert_matches_all_four_keys(spark):
    ddl = "film_id INT, customer_id INT, staff_id INT, date_id INT, amount INT"
    target = table(spark, [(1, 1, 1, 1, 5), (1, 2, 1, 1, 6), (1, 1, 2, 1, 7), (1, 1, 1, 2, 8)], ddl)
    merged = upsert.delete_insert(target, table(spark, [(1, 1, 1, 1, 50)], ddl), schemas.STAR_KEYS["sales_facts"])
    assert rows(merged.select("amount")) == [(50,), (6,), (7,), (8,)]


def test_defaults_fill_absent_columns_only(spark):
    df = table(spark, [(1, None)], "film_id INT, rating STRING")
    row = upsert.apply_defaults(df, schemas.column_defaults("film")).first()
    assert row.rating is None and row.rental_duration == 3 and str(row.rental_rate) == "4.99"
    customer = upsert.apply_defaults(table(spark, [(1,)], "customer_id INT"), schemas.column_defaults("customer")).first()
    assert customer.activebool is True and customer.create_date is not None and customer.last_update is not None


def test_assigned_keys_are_dense(spark):
    df = spark.range(0, 1000, 1, 7).filter("id % 3 <> 1").withColumn("v", F.col("id") * 2)
    keyed = assign_keys(df, "key", start=11)
    found = [(r.key, r.id, r.v) for r in keyed.collect()]
    assert sorted(k for k, _, _ in found) == list(range(11, 11 + df.count()))
    assert sorted((i, v) for _, i, v in found) == sorted((r.id, r.v) for r in df.collect())


def test_assigned_keys_of_nothing(spark):
    assert assign_keys(spark.range(0), "key").count() == 0


def test_next_key(spark):
    assert next_key(spark.range(5), "id") == 5
    assert next_key(spark.range(0), "id") == 1


def test_scratch_is_dropped(spark):
    path = scratch_path(spark, "some")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    drop_scratch(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_no_sort_aggregates_in_merges(spark):
    target, stage = table(spark, [(1, "a")]), table(spark, [(1, "b")])
    for df in (upsert.upsert_update(target, stage, ["k"]), upsert.delete_insert(target, stage, ["k"])):
        assert "SortAggregate" not in df._jdf.queryExecution().executedPlan().toString()


def test_cascade_refuses_a_repeated_old_key(spark):
    moved = table(spark, [(1, 5), (1, 6)], "old INT, new INT")
    with pytest.raises(ValueError, match="key map: more than one row"):
        quality.cascade(table(spark, [(1, "a")]), "k", moved)
