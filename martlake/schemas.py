"""Table layouts, defaults and declared keys of the rental database and the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T


TYPES = {
    "INT": T.IntegerType(),
    "SMALLINT": T.ShortType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
    "STRING": T.StringType(),
    "BOOLEAN": T.BooleanType(),
    "FLOAT": T.FloatType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "BINARY": T.BinaryType(),
    "DECIMAL(4,2)": T.DecimalType(4, 2),
    "DECIMAL(5,2)": T.DecimalType(5, 2),
    "ARRAY<STRING>": T.ArrayType(T.StringType()),
}


def _table(columns: str) -> T.StructType:
    """Layout from 'name TYPE [NOT NULL]' items; needs no running session."""
    fields = []
    for column in columns.split(", "):
        name, kind, *required = column.split()
        fields.append(T.StructField(name, TYPES[kind], not required))
    return T.StructType(fields)


# The rating enumeration in its declared order, and the range of the year domain.
RATINGS = ["G", "PG", "PG-13", "R", "NC-17"]
YEAR_RANGE = (1901, 2155)

# Months a payment may fall in: half-open, six monthly ranges from here.
PAYMENT_RANGE = ("2020-01-01", "2020-07-01")

# Layouts of the rental tables and, below, of the star schema.
OLTP = {
    "customer": _table(
        "customer_id INT NOT NULL, store_id INT NOT NULL, first_name STRING NOT NULL, "
        "last_name STRING NOT NULL, email STRING, address_id INT NOT NULL, "
        "activebool BOOLEAN NOT NULL, create_date DATE NOT NULL, last_update TIMESTAMP, active INT"
    ),
    "actor": _table(
        "actor_id INT NOT NULL, first_name STRING NOT NULL, last_name STRING NOT NULL, "
        "last_update TIMESTAMP NOT NULL"
    ),
    "category": _table("category_id INT NOT NULL, name STRING NOT NULL, last_update TIMESTAMP NOT NULL"),
    "film": _table(
        "film_id INT NOT NULL, title STRING NOT NULL, description STRING, release_year INT, "
        "language_id INT NOT NULL, original_language_id INT, rental_duration SMALLINT NOT NULL, "
        "rental_rate DECIMAL(4,2) NOT NULL, length SMALLINT, replacement_cost DECIMAL(5,2) NOT NULL, "
        "rating STRING, last_update TIMESTAMP NOT NULL, special_features ARRAY<STRING>, "
        "fulltext ARRAY<STRING> NOT NULL"
    ),
    "film_actor": _table("actor_id INT NOT NULL, film_id INT NOT NULL, last_update TIMESTAMP NOT NULL"),
    "film_category": _table("film_id INT NOT NULL, category_id INT NOT NULL, last_update TIMESTAMP NOT NULL"),
    "address": _table(
        "address_id INT NOT NULL, address STRING NOT NULL, address2 STRING, district STRING NOT NULL, "
        "city_id INT NOT NULL, postal_code STRING, phone STRING NOT NULL, last_update TIMESTAMP NOT NULL"
    ),
    "city": _table("city_id INT NOT NULL, city STRING NOT NULL, country_id INT NOT NULL, last_update TIMESTAMP NOT NULL"),
    "country": _table("country_id INT NOT NULL, country STRING NOT NULL, last_update TIMESTAMP NOT NULL"),
    "inventory": _table("inventory_id INT NOT NULL, film_id INT NOT NULL, store_id INT NOT NULL, last_update TIMESTAMP NOT NULL"),
    "language": _table("language_id INT NOT NULL, name STRING NOT NULL, last_update TIMESTAMP NOT NULL"),
    "payment": _table(
        "payment_id INT NOT NULL, customer_id INT NOT NULL, staff_id INT NOT NULL, "
        "rental_id INT NOT NULL, amount DECIMAL(5,2) NOT NULL, payment_date TIMESTAMP NOT NULL"
    ),
    "rental": _table(
        "rental_id INT NOT NULL, rental_date TIMESTAMP NOT NULL, inventory_id INT NOT NULL, "
        "customer_id INT NOT NULL, return_date TIMESTAMP, staff_id INT NOT NULL, last_update TIMESTAMP NOT NULL"
    ),
    "staff": _table(
        "staff_id INT NOT NULL, first_name STRING NOT NULL, last_name STRING NOT NULL, "
        "address_id INT NOT NULL, email STRING, store_id INT NOT NULL, active BOOLEAN NOT NULL, "
        "username STRING NOT NULL, password STRING, last_update TIMESTAMP NOT NULL, picture BINARY"
    ),
    "store": _table("store_id INT NOT NULL, manager_staff_id INT NOT NULL, address_id INT NOT NULL, last_update TIMESTAMP NOT NULL"),
}

STAR = {
    "customer_dim": _table("customer_id INT NOT NULL, first_name STRING, last_name STRING"),
    "film_dim": _table("film_id INT NOT NULL, title STRING, release_year INT, rating STRING"),
    "staff_dim": _table("staff_id INT NOT NULL, first_name STRING, last_name STRING"),
    "date_dim": _table(
        "date_id INT NOT NULL, date DATE, year INT, month INT, day_of_month INT, "
        "week_of_year INT, day_of_week INT"
    ),
    "sales_facts": _table(
        "film_id INT NOT NULL, customer_id INT NOT NULL, staff_id INT NOT NULL, "
        "date_id INT NOT NULL, amount DECIMAL(5,2)"
    ),
}

# Keys of the star schema and of the rental tables.
STAR_KEYS = {
    "customer_dim": ["customer_id"],
    "film_dim": ["film_id"],
    "staff_dim": ["staff_id"],
    "date_dim": ["date_id"],
    "sales_facts": ["film_id", "customer_id", "staff_id", "date_id"],
}

# The longest text in bytes the star schema takes, per column.
STAR_LENGTHS = {
    "customer_dim": {"first_name": 254, "last_name": 254},
    "film_dim": {"title": 254, "rating": 10},
    "staff_dim": {"first_name": 254, "last_name": 254},
}

PRIMARY_KEYS = {
    "actor": ["actor_id"],
    "address": ["address_id"],
    "category": ["category_id"],
    "city": ["city_id"],
    "country": ["country_id"],
    "customer": ["customer_id"],
    "film": ["film_id"],
    "film_actor": ["actor_id", "film_id"],
    "film_category": ["film_id", "category_id"],
    "inventory": ["inventory_id"],
    "language": ["language_id"],
    "rental": ["rental_id"],
    "staff": ["staff_id"],
    "store": ["store_id"],
}

UNIQUE_KEYS = {
    "store": [["manager_staff_id"]],
    "rental": [["rental_date", "inventory_id", "customer_id"]],
}

# child table, child column, parent table (whose key column carries the parent's own name)
FOREIGN_KEYS = [
    ("address", "city_id", "city", "city_id"),
    ("city", "country_id", "country", "country_id"),
    ("customer", "address_id", "address", "address_id"),
    ("customer", "store_id", "store", "store_id"),
    ("film", "language_id", "language", "language_id"),
    ("film", "original_language_id", "language", "language_id"),
    ("film_actor", "actor_id", "actor", "actor_id"),
    ("film_actor", "film_id", "film", "film_id"),
    ("film_category", "category_id", "category", "category_id"),
    ("film_category", "film_id", "film", "film_id"),
    ("inventory", "film_id", "film", "film_id"),
    ("inventory", "store_id", "store", "store_id"),
    ("payment", "customer_id", "customer", "customer_id"),
    ("payment", "rental_id", "rental", "rental_id"),
    ("payment", "staff_id", "staff", "staff_id"),
    ("rental", "customer_id", "customer", "customer_id"),
    ("rental", "inventory_id", "inventory", "inventory_id"),
    ("rental", "staff_id", "staff", "staff_id"),
    ("staff", "address_id", "address", "address_id"),
    ("staff", "store_id", "store", "store_id"),
    ("store", "address_id", "address", "address_id"),
]


def column_defaults(table: str) -> dict:
    """Values a column takes when an insert leaves it out (fixed values)."""
    columns = set(OLTP[table].fieldNames())
    found = {}
    if "last_update" in columns:
        found["last_update"] = F.current_timestamp()
    if table == "customer":
        found["activebool"] = F.lit(True)
        found["create_date"] = F.current_date()
    if table == "staff":
        found["active"] = F.lit(True)
    if table == "film":
        found["rental_duration"] = F.lit(3).cast("smallint")
        found["rental_rate"] = F.lit("4.99").cast("decimal(4,2)")
        found["replacement_cost"] = F.lit("19.99").cast("decimal(5,2)")
        found["rating"] = F.lit("G")
    return found


# The given order tables; declared, so that no job is spent on looking at file footers.
GIVEN = {
    "region": _table("r_regionkey INT, r_name STRING"),
    "nation": _table("n_nationkey INT, n_name STRING, n_regionkey INT"),
    "customer": _table("c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"),
    "supplier": _table("s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE"),
    "part": _table(
        "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE"
    ),
    "orders": _table(
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": _table(
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
        "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"
    ),
    "events": _table(
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    ),
    "documents": _table("doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"),
}


# Weather: one raw day, only with the fields the clean table is made from. Every leaf is text.
HOURLY = _table("time STRING, humidity STRING, pressure STRING, precipMM STRING")
RAW_DAY = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("date", "maxtempF", "mintempF", "avgtempF", "totalSnow_cm", "sunHour", "uvIndex")
    ]
    + [T.StructField("hourly", T.ArrayType(HOURLY))]
)
LANDING_KEYS = ["location", "year", "month", "day"]
LANDING = T.StructType(
    [
        T.StructField("data", T.StructType([T.StructField("weather", T.ArrayType(RAW_DAY))])),
        T.StructField("weather", T.ArrayType(RAW_DAY)),
        *RAW_DAY.fields,
        *[T.StructField(name, T.StringType()) for name in LANDING_KEYS],
    ]
)
CLEAN_DAY = _table(
    "date DATE, maxtempF FLOAT, mintempF FLOAT, avgtempF FLOAT, totalSnow_cm FLOAT, sunHour FLOAT, "
    "uvIndex INT, avgHumidity FLOAT, avgPressure FLOAT, minHumidity FLOAT, minPressure FLOAT, "
    "maxHumidity FLOAT, maxPressure FLOAT, totalPrecipMM FLOAT, "
    "location STRING, year STRING, month STRING, day STRING"
)
