"""Crawls that bring a catalog table up to date with its folder, in place.

A crawl looks at the partition folders that the catalog does not know yet, and at those alone. Their schema is united with the
registered one: new columns go behind the others, types widen where Parquet's reader can widen them. The table's schema is
changed first and the partitions are added after, so whoever reads the table meanwhile sees the old rows or all rows, and old files
show NULL in new columns. Nothing is dropped, and a type that can't be widened stops the crawl before it changes anything.

Defined cases: a table that does not exist is declared; a folder without files is passed over until it holds some; columns that new
files lack stay; a crawl that finds nothing new changes nothing; a crawl that failed can be run again. Without partitions all files
are looked at, since the catalog knows none of them.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from martlake.sources.tables import _qualified, table_folder

#: Types that Parquet files of the first type can be read as.
WIDER = {
    T.ByteType: (T.ShortType, T.IntegerType, T.LongType, T.DoubleType),
    T.ShortType: (T.IntegerType, T.LongType, T.DoubleType),
    T.IntegerType: (T.LongType, T.DoubleType),
    T.FloatType: (T.DoubleType,),
    T.DateType: (T.TimestampNTZType,),
}


def wider(one: T.DataType, other: T.DataType, name: str) -> T.DataType:
    """The type that values of both can be read as."""
    if isinstance(one, T.StructType) and isinstance(other, T.StructType):
        return united(one, other, f"{name}.")
    if isinstance(one, T.ArrayType) and isinstance(other, T.ArrayType):
        return T.ArrayType(wider(one.elementType, other.elementType, f"{name}[]"))
    if isinstance(one, T.MapType) and isinstance(other, T.MapType) and one.keyType == other.keyType:
        return T.MapType(one.keyType, wider(one.valueType, other.valueType, f"{name}[]"))
    if isinstance(one, T.DecimalType) and isinstance(other, T.DecimalType):
        scale = max(one.scale, other.scale)
        digits = max(one.precision - one.scale, other.precision - other.scale) + scale
        if digits <= 38:
            return T.DecimalType(digits, scale)
    if type(one) is type(other) and not isinstance(one, T.DecimalType):
        return one
    if type(other) in WIDER.get(type(one), ()):
        return other
    if type(one) in WIDER.get(type(other), ()):
        return one
    raise ValueError(f"{name} is {one.simpleString()} and {other.simpleString()}")


def united(one: T.StructType, other: T.StructType, prefix: str = "") -> T.StructType:
    """Columns of both, those of the first in front; names are compared as Spark does, without case."""
    others = {f.name.lower(): f for f in other.fields}
    fields = []
    for f in one.fields:
        found = others.pop(f.name.lower(), None)
        kind = wider(f.dataType, found.dataType, prefix + f.name) if found else f.dataType
        fields.append(T.StructField(f.name, kind, True, f.metadata))
    return T.StructType([*fields, *[T.StructField(f.name, f.dataType) for f in others.values()]])


def folders_schema(spark: SparkSession, folders: list[str], partitions: list[str] = ()) -> T.StructType:
    """United schema of the Parquet files below folders; footers are read in tasks.

    Spark unites what agrees in its types; where it does not, the folders, in order, are halved until the change is found, so a type
    that changed once costs a logarithm of reads.
    """
    try:
        found = spark.read.option("mergeSchema", True).parquet(*folders).schema
        return T.StructType([f for f in found.fields if f.name not in partitions])
    except (PySparkException, Py4JJavaError) as error:
        condition = (error.java_exception if isinstance(error, Py4JJavaError) else error).getCondition() or ""
        if condition == "UNABLE_TO_INFER_SCHEMA":
            return T.StructType([])
        if condition != "CANNOT_MERGE_SCHEMAS" or len(folders) == 1:
            raise
    half = len(folders) // 2
    return united(folders_schema(spark, folders[:half], partitions), folders_schema(spark, folders[half:], partitions))


def partition_folders(spark: SparkSession, path: str, partitions: list[str]) -> set[str]:
    """Partition folders below a path, as the catalog writes them (a=1/b=2). Their names are all the driver holds."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root, "/".join(f"{p}=*" for p in partitions))
    found = files.globStatus(pattern) or []
    return {"/".join(f.getPath().toString().rsplit("/", len(partitions))[1:]) for f in found if f.isDirectory()}


def crawl(spark: SparkSession, name: str, path: str, partitions: list[str] | None = None) -> DataFrame:
    """The table over a folder of Parquet files, declared if it is new, else with new columns, types and partitions taken in."""
    partitions = partitions or []
    exists = spark.catalog.tableExists(name)
    if exists and table_folder(spark, name).rstrip("/") != _qualified(spark, path).rstrip("/"):
        raise ValueError(f"{name} is a table over another folder")
    registered = T.StructType([f for f in spark.table(name).schema.fields if f.name not in partitions]) if exists else T.StructType([])
    if partitions:
        known = {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()} if exists else set()
        fresh = [f"{path.rstrip('/')}/{f}" for f in sorted(partition_folders(spark, path, partitions) - known)]
    else:
        fresh = [path]
    if not fresh:
        return spark.table(name) if exists else _missing(path)
    schema = united(registered, folders_schema(spark, fresh, partitions))
    if not schema.fields:
        return _missing(path)
    if not exists:
        columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields] + [f"`{p}` STRING" for p in partitions]
        split = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in partitions)})" if partitions else ""
        place = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE {name} ({', '.join(columns)}) USING parquet{split} LOCATION '{place}'")
    elif [(f.name, f.dataType) for f in schema.fields] != [(f.name, f.dataType) for f in registered.fields]:
        # SQL can add columns to such a table, but not widen one.
        state = spark._jsparkSession.sessionState()
        wanted = spark.sparkContext._jvm.org.apache.spark.sql.types.DataType.fromJson(schema.json())
        state.catalog().alterTableDataSchema(state.sqlParser().parseTableIdentifier(name), wanted)
    if partitions:
        spark.sql(f"MSCK REPAIR TABLE {name} ADD PARTITIONS")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def _missing(path: str) -> DataFrame:
    raise LookupError(f"no Parquet files below {path}")
