"""Crawls over folders that grow: new partitions, columns and types."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlake.sources import crawl


@pytest.fixture
def table(spark):
    yield "crawled"
    spark.sql("DROP TABLE IF EXISTS crawled")


def put(df, path, mode="append", keys=("place", "month")):
    df.write.mode(mode).partitionBy(*keys).parquet(str(path))


def test_new_months_columns_and_types(spark, tmp_path, table):
    path = str(tmp_path / "days")
    first = spark.sql("SELECT 'a b' AS place, '01' AS month, 1 AS n, CAST(0.5 AS FLOAT) AS x, named_struct('p', 1) AS s")
    put(first, path)
    before = crawl.crawl(spark, table, path, ["place", "month"])
    assert [tuple(r) for r in before.collect()] == [(1, 0.5, (1,), "a b", "01")]
    second = spark.sql(
        "SELECT 'a b' AS place, '02' AS month, 5000000000 AS n, 0.1D AS x, named_struct('p', 2L, 'q', 'z') AS s, 'new' AS extra"
    )
    put(second, path)
    # A folder that appeared is not part of the table, nor of a frame made before, until the crawl.
    assert before.count() == 1
    after = crawl.crawl(spark, table, path, ["place", "month"])
    assert after.schema.simpleString() == (
        "struct<n:bigint,x:double,s:struct<p:bigint,q:string>,extra:string,place:string,month:string>"
    )
    rows = sorted((r.month, r.n, r.x, r.extra) for r in after.collect())
    assert rows == [("01", 1, 0.5, None), ("02", 5_000_000_000, 0.1, "new")]
    assert [tuple(r) for r in before.collect()] == [(1, 0.5, (1,), "a b", "01")]
    # Files of a narrower schema change nothing more.
    put(first.withColumn("month", F.lit("03")).drop("s"), path)
    assert crawl.crawl(spark, table, path, ["place", "month"]).schema == after.schema
    assert spark.table(table).count() == 3


def test_only_new_folders_are_read(spark, tmp_path, table, monkeypatch):
    path = str(tmp_path / "days")
    read = []
    real = crawl.folders_schema
    monkeypatch.setattr(crawl, "folders_schema", lambda s, folders, p=(): read.append(folders) or real(s, folders, p))
    put(spark.sql("SELECT id, CAST(id AS STRING) AS place, '01' AS month FROM range(5)"), path)
    crawl.crawl(spark, table, path, ["place", "month"])
    put(spark.sql("SELECT 7L AS id, '7' AS place, '02' AS month"), path)
    crawl.crawl(spark, table, path, ["place", "month"])
    assert crawl.crawl(spark, table, path, ["place", "month"]).count() == 6
    assert [len(folders) for folders in read] == [5, 1] and read[1] == [f"{path}/place=7/month=02"]


def test_types_that_change_within_one_crawl(spark, tmp_path, table):
    path = str(tmp_path / "days")
    for month in range(9):
        kind = "INT" if month < 6 else "BIGINT"
        put(spark.sql(f"SELECT CAST({month} AS {kind}) AS n, '0{month}' AS month"), path, keys=("month",))
    found = crawl.crawl(spark, table, path, ["month"])
    assert found.schema["n"].dataType == T.LongType() and found.agg(F.sum("n")).first()[0] == 36


def test_what_stops_a_crawl(spark, tmp_path, table):
    path = str(tmp_path / "days")
    (tmp_path / "days" / "month=00").mkdir(parents=True)
    with pytest.raises(LookupError, match="no Parquet files"):
        crawl.crawl(spark, table, path, ["month"])
    put(spark.sql("SELECT 1 AS n, '01' AS month"), path, keys=("month",))
    crawl.crawl(spark, table, path, ["month"])
    put(spark.sql("SELECT 'one' AS n, '02' AS month"), path, keys=("month",))
    with pytest.raises(ValueError, match="n is int and string"):
        crawl.crawl(spark, table, path, ["month"])
    assert spark.table(table).count() == 1 and spark.table(table).schema["n"].dataType == T.IntegerType()
    with pytest.raises(ValueError, match="another folder"):
        crawl.crawl(spark, table, str(tmp_path / "other"), ["month"])


def test_folder_without_partitions(spark, tmp_path, table):
    path = str(tmp_path / "rows")
    spark.sql("SELECT 1 AS n").write.parquet(path)
    assert crawl.crawl(spark, table, path).columns == ["n"]
    spark.sql("SELECT 2 AS n, 'x' AS y").write.mode("append").parquet(path)
    assert sorted(crawl.crawl(spark, table, path).collect()) == [(1, None), (2, "x")]


def test_types():
    assert crawl.wider(T.DecimalType(8, 2), T.DecimalType(6, 4), "c") == T.DecimalType(10, 4)
    assert crawl.wider(T.ArrayType(T.IntegerType()), T.ArrayType(T.LongType()), "c") == T.ArrayType(T.LongType())
    assert crawl.wider(T.DateType(), T.TimestampNTZType(), "c") == T.TimestampNTZType()
    with pytest.raises(ValueError, match=r"c\[\] is int and string"):
        crawl.wider(T.ArrayType(T.IntegerType()), T.ArrayType(T.StringType()), "c")
