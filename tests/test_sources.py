import datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from martlake import schemas
from martlake.operators import textindex
from martlake.plans import jobs, snapshots
from martlake.sources import extract, publish, tables
from martlake.sources.tables import typed


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


FILMS = [
    (1, "A, B", 2000, "G"), (2, 'say "x"', None, None), (3, "", 2001, "R"), (4, " blanks ", 2002, "PG"),
    (5, "two\nlines", 2003, "PG"), (6, None, 2004, "back\\slash"),
]


def test_csv_roundtrip(spark, tmp_path):
    df = spark.createDataFrame(FILMS, schemas.STAR["film_dim"])
    path = extract.export_extract(df, str(tmp_path / "films"), ["film_id"])
    assert rows(extract.read_extract(spark, path, schemas.STAR["film_dim"])) == rows(df)
    extract.export_extract(df.limit(1), path)
    assert extract.read_extract(spark, path, schemas.STAR["film_dim"]).count() == 1  # replaced, not added


def test_malformed_extract_row_stops_the_job(spark, tmp_path):
    (tmp_path / "x.csv").write_text("1,20\n2,not a number\n")
    schema = schemas.STAR["date_dim"][:2]
    with pytest.raises(Exception):
        extract.read_extract(spark, str(tmp_path / "x.csv"), schema).collect()


def test_customers_of_three_plain_fields(spark, tmp_path):
    (tmp_path / "customers.csv").write_text("1,MARY,SMITH\n2,PATRICIA,JOHNSON\n")
    df = extract.read_extract(spark, str(tmp_path / "customers.csv"), schemas.STAR["customer_dim"])
    assert rows(df) == [(1, "MARY", "SMITH"), (2, "PATRICIA", "JOHNSON")]


def payments(spark, moments):
    return spark.createDataFrame([(i, datetime.datetime.fromisoformat(m)) for i, m in enumerate(moments)], "payment_id INT, payment_date TIMESTAMP")


def test_month_folders(spark, tmp_path):
    df = payments(spark, ["2020-01-01", "2020-01-31T23:59:59", "2020-02-01", "2020-06-30"])
    path = tables.write_partitioned(df, str(tmp_path / "payment"))
    assert sorted(p.name for p in (tmp_path / "payment").glob("pay_month=*")) == [f"pay_month=2020-{m}" for m in ("01", "02", "06")]
    assert tables.read_months(spark, path, df.schema, "2020-01", "2020-01").count() == 2


def test_payment_outside_all_months_is_refused(spark, tmp_path):
    with pytest.raises(Exception, match="no partition for"):
        tables.write_partitioned(payments(spark, ["2020-07-01"]), str(tmp_path / "payment"))


def test_fact_files_are_sorted(spark, tmp_path):
    df = spark.range(1000).selectExpr("CAST(id % 7 AS INT) AS film_id", "CAST(id AS INT) AS customer_id", "1 AS staff_id",
                                      "IF(id % 3 = 0, 20200101, CAST(20200102 + id % 20 AS INT)) AS date_id")
    path = tables.write_fact(df, str(tmp_path / "facts"))
    parts = sorted((tmp_path / "facts").glob("part-*"))
    for part in parts:
        keys = [(r.date_id, r.film_id) for r in spark.read.parquet(str(part)).collect()]
        assert keys == sorted(keys)
    assert spark.read.parquet(path).count() == 1000


def test_bucketed_fact_joins_without_shuffle(spark, tmp_path):
    df = spark.range(100).selectExpr("CAST(id % 5 AS INT) AS date_id", "CAST(id AS INT) AS film_id")
    for name in ("fact_a", "fact_b"):
        tables.write_bucketed_fact(df, name, str(tmp_path / name), 4)
    a, b = spark.table("fact_a"), spark.table("fact_b").hint("merge")
    plan = a.join(b, "date_id")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    for name in ("fact_a", "fact_b"):
        spark.sql(f"DROP TABLE {name}")


def test_create_table(spark, tmp_path):
    tables.create_table(spark, "film_dim_made", schemas.STAR["film_dim"], str(tmp_path / "t"))
    tables.create_table(spark, "film_dim_made", schemas.STAR["film_dim"], str(tmp_path / "t"), replace=True)
    assert spark.table("film_dim_made").columns == ["film_id", "title", "release_year", "rating"]
    spark.sql("DROP TABLE film_dim_made")


def test_typed_is_strict(spark):
    good = spark.createDataFrame([("7", "A", "B")], "customer_id STRING, first_name STRING, last_name STRING")
    assert rows(typed(good, schemas.STAR["customer_dim"])) == [(7, "A", "B")]
    bad = spark.createDataFrame([("x", "A", "B")], good.schema)
    with pytest.raises(Exception):
        typed(bad, schemas.STAR["customer_dim"]).collect()


# --- publishing


def test_publish_all_or_nothing(spark, tmp_path):
    base = str(tmp_path / "out")
    one, two = spark.range(3), spark.range(5)
    publish.publish(spark, {"a": one, "b": one}, base, "run-1")
    checks = {"b": [lambda df: df.filter("id > 3")]}
    with pytest.raises(publish.CheckFailed):
        publish.publish(spark, {"a": two, "b": two}, base, "run-2", checks)
    assert publish.read_published(spark, base, "a").count() == 3  # the failed run shows nowhere
    publish.publish(spark, {"a": two, "b": one}, base, "run-2", checks)  # may be tried again
    assert publish.read_published(spark, base, "a").count() == 5
    with pytest.raises(ValueError, match="already published"):
        publish.publish(spark, {"a": one}, base, "run-2")


def test_nothing_published_yet(spark, tmp_path):
    assert publish.published_run(spark, str(tmp_path), "a") is None
    with pytest.raises(LookupError):
        publish.read_published(spark, str(tmp_path), "a")


def test_rebuild_swap_leaves_readers_of_the_old_version_alone(spark, tmp_path):
    base = str(tmp_path / "out")
    old = publish.rebuild_swap(spark, "swapped", spark.range(3), base, "run-1")
    publish.rebuild_swap(spark, "swapped", old.unionByName(spark.range(4)), base, "run-2")
    assert old.count() == 3
    assert spark.table("swapped").count() == 7


# --- jobs


def shop(spark, title="Alpha", extra=()):
    ts = datetime.datetime(2020, 1, 6, 12)
    return {
        "customer": spark.createDataFrame([(1, "A", "B")], "customer_id INT, first_name STRING, last_name STRING"),
        "staff": spark.createDataFrame([(1, "S", "T")], "staff_id INT, first_name STRING, last_name STRING"),
        "film": spark.createDataFrame([(1, title, 2000, "G")], "film_id INT, title STRING, release_year INT, rating STRING"),
        "inventory": spark.createDataFrame([(1, 1)], "inventory_id INT, film_id INT"),
        "rental": spark.createDataFrame([(1, 1)], "rental_id INT, inventory_id INT"),
        "payment": spark.createDataFrame(
            [(1, 1, 1, D("2.00"), ts), *extra], "rental_id INT, customer_id INT, staff_id INT, amount DECIMAL(5,2), payment_date TIMESTAMP"
        ),
    }


def test_elt_updates_dimensions_and_rebuilds_facts(spark, tmp_path):
    base = str(tmp_path / "star")
    jobs.run_elt(spark, shop(spark), base, "run-1", start="2020-01-01", days=10)
    later = (1, 1, 1, D("3.00"), datetime.datetime(2020, 1, 7, 12))
    star = jobs.run_elt(spark, shop(spark, "Beta, 2", [later]), base, "run-2", start="2020-01-05", days=10)
    assert rows(star["film_dim"]) == [(1, "Beta, 2", 2000, "G")]
    assert star["date_dim"].count() == 15
    assert star["sales_facts"].count() == 2
    stored = snapshots.snapshot(spark, "weekly_rating_sales", base)
    assert {r.sales for r in stored.collect()} == {D("5.00")}


def test_extract_and_load(spark, tmp_path):
    files, base = str(tmp_path / "files"), str(tmp_path / "star")
    jobs.export(spark, shop(spark, "A, B"), files, "2020-01-01", 10)
    jobs.run_warehouse_load(spark, files, base, "run-1")
    jobs.export(spark, shop(spark, "C"), files, "2020-01-01", 10)
    star = jobs.run_warehouse_load(spark, files, base, "run-2")
    assert rows(star["film_dim"]) == [(1, "C", 2000, "G")]
    assert rows(star["sales_facts"]) == [(1, 1, 1, 20200106, D("2.00"))]
    assert star["date_dim"].count() == 11


def test_failed_load_raises_and_publishes_nothing(spark, tmp_path):
    files, base = tmp_path / "files", str(tmp_path / "star")
    jobs.export(spark, shop(spark), str(files), "2020-01-01", 10)
    (files / "staff" / "extra.csv").write_text("1,Again,Twice\n")  # the key is there twice
    with pytest.raises(publish.CheckFailed):
        jobs.run_warehouse_load(spark, str(files), base, "run-1")
    assert jobs.published_star(spark, base) is None


def folders(spark, base, name):
    return publish.published_folders(spark, base)[name][1]


def test_untouched_months_keep_their_files(spark, tmp_path):
    base, files = str(tmp_path / "star"), str(tmp_path / "files")
    march = (1, 1, 1, D("9.00"), datetime.datetime(2020, 3, 7, 12))
    jobs.export(spark, shop(spark, extra=[march]), files, "2020-01-01", 100)
    jobs.run_warehouse_load(spark, files, base, "run-1")
    before = folders(spark, base, "sales_facts")
    changed = shop(spark)
    changed["payment"] = changed["payment"].withColumn("amount", F.lit(D("7.00")).cast("decimal(5,2)"))
    jobs.export(spark, changed, files, "2020-01-01", 100)
    star = jobs.run_warehouse_load(spark, files, base, "run-2")
    assert rows(star["sales_facts"].select("date_id", "amount")) == [(20200106, D("7.00")), (20200307, D("9.00"))]
    after = folders(spark, base, "sales_facts")
    assert [f for f in after if f in before] == [f for f in before if f.endswith("=202003")]
    dropped = publish.drop_old_versions(spark, base)
    assert [f for f in before if f.endswith("=202001")] == [f for f in dropped if "sales_facts" in f]
    assert rows(jobs.published_star(spark, base)["sales_facts"]) == rows(star["sales_facts"])
    with pytest.raises(ValueError, match="already published"):
        jobs.run_warehouse_load(spark, files, base, "run-2")


def test_elt_can_be_run_again_after_a_failed_report(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "star")
    jobs.run_elt(spark, shop(spark), base, "run-1", start="2020-01-01", days=10)

    def fails(star):
        raise RuntimeError("no report today")

    later = (1, 1, 1, D("3.00"), datetime.datetime(2020, 1, 7, 12))
    with monkeypatch.context() as patch:
        patch.setitem(snapshots.SNAPSHOTS, "weekly_rating_sales", fails)
        with pytest.raises(RuntimeError):
            jobs.run_elt(spark, shop(spark, extra=[later]), base, "run-2", start="2020-01-01", days=10)
    assert jobs.published_star(spark, base)["sales_facts"].count() == 1
    jobs.run_elt(spark, shop(spark, extra=[later]), base, "run-2", start="2020-01-01", days=10)
    assert {r.sales for r in snapshots.snapshot(spark, "weekly_rating_sales", base).collect()} == {D("5.00")}


def test_second_publisher_of_a_run_id_fails(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "out")
    publish.publish(spark, {"a": spark.range(3)}, base, "run-1")
    monkeypatch.setattr(publish, "_manifest", lambda spark, base: None)  # it looked before the first was done
    with pytest.raises(ValueError, match="already published"):
        publish.publish(spark, {"a": spark.range(4)}, base, "run-1")


def test_long_texts_stop_a_load(spark, tmp_path):
    with pytest.raises(publish.CheckFailed):
        jobs.run_elt(spark, shop(spark, "é" * 200), str(tmp_path / "star"), "run-1", start="2020-01-01", days=10)


def test_extract_is_sorted_across_files(spark, tmp_path):
    df = spark.range(5000).selectExpr("id % 7 AS a", "-id AS b").repartition(5)
    path = tmp_path / "sorted"
    extract.export_extract(df, str(path), ["a", "b"])
    lines = [line for part in sorted(path.glob("part-*")) for line in part.read_text().splitlines()]
    found = [tuple(map(int, line.split(","))) for line in lines]
    assert len(found) == 5000 and found == sorted(found)


@pytest.mark.parametrize("job", ["elt", "export", "load", "weather"])
def test_jobs_from_the_command_line(spark, tmp_path, monkeypatch, job):
    monkeypatch.setattr(jobs, "build_session", lambda app: spark)
    tables, base, files = str(tmp_path / "tables"), str(tmp_path / "out"), str(tmp_path / "files")
    for name, df in shop(spark).items():
        df.write.parquet(f"{tables}/{name}")
    dates = ["--start", "2020-01-01", "--days", "10"]
    if job == "elt":
        jobs.main(["elt", "--tables", tables, *dates, "--base", base, "--run-id", "run-1"])
        assert jobs.published_star(spark, base)["date_dim"].count() == 11
    elif job in ("export", "load"):
        jobs.main(["export", "--tables", tables, *dates, "--base", files])
        assert spark.read.csv(f"{files}/films").count() == 1
        if job == "load":
            jobs.main(["load", "--extracts", files, "--base", base, "--run-id", "run-1"])
            assert jobs.published_star(spark, base)["sales_facts"].count() == 1
    else:
        folder = tmp_path / "raw" / "location=a" / "year=2020" / "month=01" / "day=02"
        folder.mkdir(parents=True)
        (folder / "20200102.json").write_text('{"date": "2020-01-02", "maxtempF": "4", "hourly": []}')
        jobs.main(["weather", "--raw", str(tmp_path / "raw"), "--out", base])
        assert [r.maxtempF for r in spark.read.parquet(base).collect()] == [4.0]


def test_first_load_appends(spark):
    stage = {name: spark.createDataFrame([], schema) for name, schema in schemas.STAR.items()}
    stage["staff_dim"] = spark.createDataFrame([(1, "a", "b")], schemas.STAR["staff_dim"])
    both = jobs.first_load(stage, stage)
    assert both["staff_dim"].count() == 2


# --- word index


def test_token_index_and_search(spark):
    df = spark.createDataFrame(
        [(1, "The Long Film", "A film of the LONG night"), (2, "Être", None), (3, None, None)],
        "film_id INT, title STRING, description STRING",
    )
    index = textindex.token_index(df, "film_id", ["title", "description"])
    found = {(r.token, r.film_id): r.positions for r in index.collect()}
    assert found == {
        ("long", 1): [2, 8], ("film", 1): [3, 5], ("night", 1): [9], ("être", 2): [1],
    }
    assert rows(textindex.search(index, "film_id", ["the", "LONG", "film"])) == [(1, 4)]
    assert rows(textindex.search(index, "film_id", ["long", "être"])) == []
    assert rows(textindex.search(index, "film_id", ["long", "être"], need_all=False)) == [(1, 2), (2, 1)]


def test_stored_index_is_read_by_word(spark, tmp_path):
    df = spark.range(200).selectExpr("CAST(id AS INT) AS film_id", "CONCAT('w', id % 20, ' common') AS title")
    path = textindex.write_index(textindex.token_index(df, "film_id", ["title"]), "film_id", str(tmp_path / "index"))
    found = textindex.search(textindex.read_index(spark, path), "film_id", ["W7", "common"])
    assert sorted(r.film_id for r in found.collect()) == list(range(7, 200, 20))
    assert "PushedFilters: [In(token" in found._jdf.queryExecution().toString()


def test_extract_without_line_breaks_is_split(spark, tmp_path):
    films = spark.range(50).selectExpr("CAST(id AS INT) AS film_id", "'A, \"B\"' AS title")
    path = extract.export_extract(films, str(tmp_path / "films"))
    assert rows(extract.read_extract(spark, path, films.schema, multiline=False)) == rows(films)


def test_stop_words():
    assert len(textindex.STOP_WORDS) == len(set(textindex.STOP_WORDS)) == 127
