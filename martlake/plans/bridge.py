"""The given order tables in the shape of the rental tables.

A line item is a payment; the distinct (order, line number) pairs are the rentals; each part is a
film with a fixed number of copies; suppliers are staff and actors; nations are cities and
stores. Everything is a projection or one aggregation of whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake import schemas

COPIES = 16
LINE_NUMBERS = 10
STORES = 25
DATE_START = "1995-01-01"


class Bridge:
    """Rental tables over one folder of Parquet files, each made when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def source(self, name: str) -> DataFrame:
        return self.spark.read.schema(schemas.GIVEN[name]).parquet(f"{self.folder}/{name}.parquet")

    # --- payments and rentals

    def payment_lines(self) -> DataFrame:
        """Payments without their customer, which is on the order."""
        return self.source("lineitem").select(
            _rental_id().alias("payment_id"),
            F.col("l_suppkey").alias("staff_id"),
            _rental_id().alias("rental_id"),
            F.col("l_extendedprice").cast("decimal(8,2)").alias("amount"),
            F.col("l_shipdate").alias("payment_date"),
            "l_orderkey",
        )

    def payment(self) -> DataFrame:
        owner = self.source("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer_id"))
        return self.payment_lines().join(owner, "l_orderkey").select(
            "payment_id", "customer_id", "staff_id", "rental_id", "amount", "payment_date"
        )

    def rental_items(self) -> DataFrame:
        """Rentals without what the order holds: one per order and line number.

        A rental is returned once all its lines are finished, on the last of their dates.
        """
        return (
            self.source("lineitem")
            .groupBy(_rental_id().alias("rental_id"))
            .agg(
                F.min(F.col("l_partkey") * COPIES + F.col("l_suppkey") % COPIES).alias("inventory_id"),
                F.min("l_suppkey").alias("staff_id"),
                F.max(F.when(F.col("l_linestatus") == "F", 0).when(F.col("l_linestatus").isNotNull(), 1)).alias("_open"),
                F.max("l_shipdate").alias("_shipped"),
            )
            .select(
                "rental_id", "inventory_id", "staff_id",
                F.when(F.col("_open") == 0, F.col("_shipped")).alias("return_date"),
            )
        )

    def rental(self) -> DataFrame:
        owner = self.source("orders").select(
            "o_orderkey", F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").alias("rental_date")
        )
        order = F.expr(f"rental_id div {LINE_NUMBERS}")
        return self.rental_items().withColumn("o_orderkey", order).join(owner, "o_orderkey").select(
            "rental_id", "rental_date", "inventory_id", "customer_id", "return_date", "staff_id"
        )

    def inventory(self) -> DataFrame:
        """Every part once for each copy.

        A join and not an exploded array: Spark counts an exploded row as one, and would broadcast items of any number.
        Each copy is a partition, as the keys of a few megabytes of parts make more items than one task should hold.
        """
        copies = self.spark.range(0, COPIES, 1, COPIES).withColumnRenamed("id", "_copy").hint("shuffle_replicate_nl")
        return self.source("part").select("p_partkey").crossJoin(copies).select(
            (F.col("p_partkey") * COPIES + F.col("_copy")).alias("inventory_id"),
            F.col("p_partkey").alias("film_id"),
            ((F.col("p_partkey") + F.col("_copy")) % STORES).cast("int").alias("store_id"),
        )

    # --- films

    def film(self) -> DataFrame:
        rate = F.col("p_retailprice").cast("decimal(8,2)")
        size = F.col("p_size")
        rating = F.element_at(F.array(*map(F.lit, schemas.RATINGS), F.lit(None).cast("string")), size % 6 + 1)
        return self.source("part").select(
            F.col("p_partkey").alias("film_id"),
            F.col("p_name").alias("title"),
            F.concat("p_brand", F.lit(" "), "p_type").alias("description"),
            (1990 + size % 30).alias("release_year"),
            size.alias("rental_duration"),
            rate.alias("rental_rate"),
            (size + 60).alias("length"),
            (rate * 10).cast("decimal(10,2)").alias("replacement_cost"),
            rating.alias("rating"),
        )

    def category(self) -> DataFrame:
        return self.source("part").select(_brand().alias("category_id"), F.col("p_brand").alias("name")).distinct()

    def film_category(self) -> DataFrame:
        """The brand of each part, and the next brand as well for every fifth size."""
        both = F.array(_brand(), F.when(F.col("p_size") % 5 == 0, _brand() % 25 + 1))
        return (
            self.source("part")
            .select(F.col("p_partkey").alias("film_id"), F.explode(F.array_compact(both)).alias("category_id"))
        )

    def actor(self) -> DataFrame:
        return self.source("supplier").select(F.col("s_suppkey").alias("actor_id"), *_names("s_name"))

    def film_actor(self) -> DataFrame:
        return self.source("lineitem").select(
            F.col("l_partkey").alias("film_id"), F.col("l_suppkey").alias("actor_id")
        ).distinct()

    # --- people and places

    def customer(self) -> DataFrame:
        return self.source("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_nationkey").alias("store_id"),
            *_names("c_name"),
            (F.col("c_custkey") * 2).alias("address_id"),
            (F.col("c_acctbal") > 0).alias("activebool"),
        )

    def staff(self) -> DataFrame:
        return self.source("supplier").select(
            F.col("s_suppkey").alias("staff_id"),
            *_names("s_name"),
            (F.col("s_suppkey") * 2 + 1).alias("address_id"),
            F.col("s_nationkey").alias("store_id"),
        )

    def store(self) -> DataFrame:
        """Nations with a supplier; the lowest supplier manages."""
        manager = F.min("s_suppkey")
        return self.source("supplier").groupBy(F.col("s_nationkey").alias("store_id")).agg(
            manager.alias("manager_staff_id"), (manager * 2 + 1).alias("address_id")
        )

    def address(self) -> DataFrame:
        """Homes of customers under even ids, of staff under odd ids."""

        def homes(df: DataFrame, key: str, odd: int, nation: str) -> DataFrame:
            number = F.col(key)
            return df.select(
                (number * 2 + odd).alias("address_id"),
                F.concat(number.cast("string"), F.lit(" Main Street")).alias("address"),
                F.lpad((number % 100000).cast("string"), 5, "0").alias("postal_code"),
                F.concat(F.lit("555-"), F.lpad((number % 10000).cast("string"), 4, "0")).alias("phone"),
                F.col(nation).alias("city_id"),
            )

        return homes(self.source("customer"), "c_custkey", 0, "c_nationkey").unionByName(
            homes(self.source("supplier"), "s_suppkey", 1, "s_nationkey")
        )

    def city(self) -> DataFrame:
        return self.source("nation").select(
            F.col("n_nationkey").alias("city_id"), F.col("n_name").alias("city"), F.col("n_regionkey").alias("country_id")
        )

    def country(self) -> DataFrame:
        return self.source("region").select(F.col("r_regionkey").alias("country_id"), F.col("r_name").alias("country"))

    # --- weather

    def weather_days(self) -> DataFrame:
        """One raw day per event type and date, all leaves text.

        Events are first summed up by hour, so the hourly array never holds more than 24 entries
        however many events a day has.
        """
        value = F.col("value").cast("decimal(10,2)")
        day = F.to_date("ts")
        hours = (
            self.source("events")
            .groupBy(F.col("event_type").alias("location"), day.alias("_day"), F.hour("ts").alias("_hour"))
            .agg(
                F.max(value).alias("_high"), F.min(value).alias("_low"), F.count(F.lit(1)).alias("_n"),
                F.max(F.col("user_id")).alias("_user"),
            )
        )
        hour = F.struct(
            F.col("_hour").alias("_at"),
            (F.col("_hour") * 100).cast("string").alias("time"),
            F.col("_high").cast("string").alias("humidity"),
            F.col("_low").cast("string").alias("pressure"),
            # hours with an even top user report no rain
            F.when(F.col("_user") % 2 == 0, F.lit("")).otherwise(F.col("_n").cast("string")).alias("precipMM"),
        )
        per_day = hours.groupBy("location", "_day").agg(
            F.array_sort(F.collect_list(hour)).alias("_hours"),
            F.max("_high").alias("_high"), F.min("_low").alias("_low"), F.sum("_n").alias("_n"),
        )
        return per_day.select(
            F.date_format("_day", "yyyy-MM-dd").alias("date"),
            F.col("_high").cast("string").alias("maxtempF"),
            F.col("_low").cast("string").alias("mintempF"),
            F.lit("x").alias("avgtempF"),
            F.lit("0.0").alias("totalSnow_cm"),
            F.lit("8.7").alias("sunHour"),
            F.concat(F.col("_n").cast("string"), F.lit(".0")).alias("uvIndex"),
            F.transform("_hours", lambda h: F.struct(h["time"], h["humidity"], h["pressure"], h["precipMM"])).alias("hourly"),
            "location",
            F.date_format("_day", "yyyy").alias("year"),
            F.date_format("_day", "MM").alias("month"),
            F.date_format("_day", "dd").alias("day"),
        )


def _rental_id() -> Column:
    return F.col("l_orderkey") * LINE_NUMBERS + F.col("l_linenumber")


def _brand() -> Column:
    return F.expr("cast(substring(p_brand, 7) as int)")


def _names(column: str) -> list[Column]:
    pieces = F.split(F.col(column), "#")
    return [pieces[0].alias("first_name"), pieces[1].alias("last_name")]
