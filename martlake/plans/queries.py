"""The registered queries: each operator over whole tables, with the SQL that must agree.

``SHAPES`` gives the rental tables over the given ones in SQL, as ``Bridge`` does in Spark; a
query's SQL names those it needs in ``uses``.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martlake import schemas
from martlake.functions.calendar import date_id, month_bounds
from martlake.operators import quality, rentals, textindex, upsert, weather
from martlake.operators.keys import assign_keys, next_key
from martlake.operators.lookup import anti_join, semi_join
from martlake.plans import functions, jobs, maintained, reports, snapshots, star
from martlake.plans.bridge import DATE_START, Bridge
from martlake.session import RUNTIME, TABLES, configure, scratch_path, size_shuffles, stored
from martlake.sources import crawl, extract, landing, tables
from martlake.streaming import intake

SHAPES = {
    "payment": """
        SELECT l_orderkey * 10 + l_linenumber AS payment_id, o_custkey AS customer_id, l_suppkey AS staff_id,
               l_orderkey * 10 + l_linenumber AS rental_id, CAST(l_extendedprice AS DECIMAL(8,2)) AS amount,
               l_shipdate AS payment_date, l_returnflag
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
    "rental": """
        SELECT l_orderkey * 10 + l_linenumber AS rental_id, min(l_partkey * 16 + l_suppkey % 16) AS inventory_id,
               min(l_suppkey) AS staff_id, CASE WHEN max(l_linestatus) = 'F' THEN max(l_shipdate) END AS return_date,
               min(o_custkey) AS customer_id, min(o_orderdate) AS rental_date
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY l_orderkey * 10 + l_linenumber""",
    "inventory": """
        SELECT p_partkey * 16 + c.range AS inventory_id, p_partkey AS film_id,
               CAST((p_partkey + c.range) % 25 AS INTEGER) AS store_id
        FROM part CROSS JOIN range(16) c""",
    "film": """
        SELECT p_partkey AS film_id, p_name AS title, p_brand || ' ' || p_type AS description,
               CAST(1990 + p_size % 30 AS INTEGER) AS release_year, p_size AS rental_duration,
               CAST(p_retailprice AS DECIMAL(8,2)) AS rental_rate, CAST(p_size + 60 AS INTEGER) AS length,
               CAST(CAST(p_retailprice AS DECIMAL(8,2)) * 10 AS DECIMAL(10,2)) AS replacement_cost,
               CASE p_size % 6 WHEN 0 THEN 'G' WHEN 1 THEN 'PG' WHEN 2 THEN 'PG-13' WHEN 3 THEN 'R'
                    WHEN 4 THEN 'NC-17' END AS rating
        FROM part""",
    "category": "SELECT DISTINCT CAST(substring(p_brand, 7) AS INTEGER) AS category_id, p_brand AS name FROM part",
    "film_category": """
        SELECT p_partkey AS film_id, CAST(substring(p_brand, 7) AS INTEGER) AS category_id FROM part
        UNION ALL
        SELECT p_partkey, CAST(substring(p_brand, 7) AS INTEGER) % 25 + 1 FROM part WHERE p_size % 5 = 0""",
    "actor": "SELECT s_suppkey AS actor_id, split_part(s_name, '#', 1) AS first_name, split_part(s_name, '#', 2) AS last_name FROM supplier",
    "film_actor": "SELECT DISTINCT l_partkey AS film_id, l_suppkey AS actor_id FROM lineitem",
    "customers": """
        SELECT c_custkey AS customer_id, c_nationkey AS store_id, split_part(c_name, '#', 1) AS first_name,
               split_part(c_name, '#', 2) AS last_name, c_custkey * 2 AS address_id, c_acctbal > 0 AS activebool
        FROM customer""",
    "staff": """
        SELECT s_suppkey AS staff_id, split_part(s_name, '#', 1) AS first_name, split_part(s_name, '#', 2) AS last_name,
               s_suppkey * 2 + 1 AS address_id, s_nationkey AS store_id
        FROM supplier""",
    "store": """
        SELECT s_nationkey AS store_id, min(s_suppkey) AS manager_staff_id, min(s_suppkey) * 2 + 1 AS address_id
        FROM supplier GROUP BY s_nationkey""",
    "address": """
        SELECT c_custkey * 2 AS address_id, c_custkey || ' Main Street' AS address,
               lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS postal_code,
               '555-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS phone, c_nationkey AS city_id FROM customer
        UNION ALL
        SELECT s_suppkey * 2 + 1, s_suppkey || ' Main Street', lpad(CAST(s_suppkey % 100000 AS VARCHAR), 5, '0'),
               '555-' || lpad(CAST(s_suppkey % 10000 AS VARCHAR), 4, '0'), s_nationkey FROM supplier""",
    "place": """
        SELECT n_nationkey AS city_id, n_name AS city, r_name AS country FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "sold": """
        SELECT p.*, r.inventory_id, i.film_id, i.store_id, f.rating
        FROM payment p JOIN rental r ON p.rental_id = r.rental_id JOIN inventory i ON r.inventory_id = i.inventory_id
             JOIN film f ON i.film_id = f.film_id""",
    "date_dim": """
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, d AS date, CAST(isoyear(d) AS INTEGER) AS year,
               CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day_of_month,
               CAST(week(d) AS INTEGER) AS week_of_year, CAST(isodow(d) AS INTEGER) AS day_of_week
        FROM (SELECT CAST(DATE '1995-01-01' + CAST(range AS INTEGER) AS DATE) AS d FROM range(5001))""",
    "facts": """
        SELECT DISTINCT film_id, customer_id, staff_id, CAST(strftime(payment_date, '%Y%m%d') AS INTEGER) AS date_id, amount
        FROM sold""",
    "hours": """
        SELECT event_type AS location, CAST(ts AS DATE) AS d, hour(ts) AS h, max(CAST(value AS DECIMAL(10,2))) AS hi,
               min(CAST(value AS DECIMAL(10,2))) AS lo, count(*) AS n, max(user_id) AS u
        FROM events GROUP BY ALL""",
    "clean": """
        SELECT d AS date, CAST(max(hi) AS FLOAT) AS "maxtempF", CAST(min(lo) AS FLOAT) AS "mintempF",
               CAST(NULL AS FLOAT) AS "avgtempF", CAST(0 AS FLOAT) AS "totalSnow_cm", CAST(8.7 AS FLOAT) AS "sunHour",
               CAST(sum(n) AS INTEGER) AS "uvIndex", CAST(avg(CAST(hi AS DOUBLE)) AS FLOAT) AS "avgHumidity",
               CAST(avg(CAST(lo AS DOUBLE)) AS FLOAT) AS "avgPressure", CAST(min(hi) AS FLOAT) AS "minHumidity",
               CAST(min(lo) AS FLOAT) AS "minPressure", CAST(max(hi) AS FLOAT) AS "maxHumidity",
               CAST(max(lo) AS FLOAT) AS "maxPressure",
               CAST(coalesce(CAST(sum(CASE WHEN u % 2 <> 0 THEN n END) AS DOUBLE), 'nan'::DOUBLE) AS FLOAT) AS "totalPrecipMM",
               location, strftime(d, '%Y') AS year, strftime(d, '%m') AS month, strftime(d, '%d') AS day
        FROM hours GROUP BY location, d""",
    "busy_days": "SELECT DISTINCT event_type || (user_id % 97) AS location, CAST(ts AS DATE) AS date FROM events",
}
NEEDS = {
    "sold": ["payment", "rental", "inventory", "film"],
    "facts": ["sold"],
    "clean": ["hours"],
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _with(uses: list[str], body: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for name in uses:
        add(name)
    parts = ", ".join(f"{name} AS ({SHAPES[name]})" for name in order)
    if parts:
        return f"WITH {parts} {body}"
    return f"WITH {body[1:]}" if body.startswith(",") else body


def query(body: str | None, *uses: str):
    """Register a function of a Bridge under its own name, with its SQL."""

    def register(build: Callable[[Bridge], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Bridge(size_shuffles(configure(spark, {**RUNTIME, **TABLES}), folder), folder))

        QUERIES[build.__name__] = run
        if body is not None:
            ORACLES[build.__name__] = _with(list(uses), body)
        return build

    return register


def _oltp(b: Bridge) -> tuple:
    return b.payment_lines(), b.rental_items(), b.inventory(), b.film()


# --- reports ------------------------------------------------------------------------------


@query("SELECT CAST(isodow(payment_date) AS INTEGER) AS dow, CAST(sum(amount) AS DECIMAL(38,2)) AS sales FROM sold GROUP BY 1", "sold")
def oltp_daily_sales(b: Bridge) -> DataFrame:
    return reports.order_report(reports.daily_sales(*_oltp(b)), ["dow"])


WEEKLY = """SELECT CAST(week(payment_date) AS INTEGER) AS week, rating, CAST(sum(amount) AS DECIMAL(38,2)) AS sales
            FROM sold GROUP BY {kind}(CAST(week(payment_date) AS INTEGER), rating)"""


@query(WEEKLY.format(kind="CUBE"), "sold")
def oltp_weekly_cube(b: Bridge) -> DataFrame:
    return reports.order_report(reports.weekly_sales_cube(*_oltp(b)), ["week", "rating", "sales"])


@query(
    """SELECT CAST(isoyear(payment_date) AS INTEGER) AS year, CAST(week(payment_date) AS INTEGER) AS week, rating,
              CAST(sum(amount) AS DECIMAL(38,2)) AS sales,
              CAST(grouping_id(CAST(isoyear(payment_date) AS INTEGER), CAST(week(payment_date) AS INTEGER), rating) AS INTEGER) AS gid
       FROM sold GROUP BY CUBE(CAST(isoyear(payment_date) AS INTEGER), CAST(week(payment_date) AS INTEGER), rating)""",
    "sold",
)
def oltp_weekly_cube_by_year(b: Bridge) -> DataFrame:
    cube = reports.weekly_sales_cube(*_oltp(b), with_year=True, with_gid=True)
    return reports.order_report(cube, ["year", "week", "rating", "sales"])


@query(
    """, w AS (SELECT CAST(week(payment_date) AS INTEGER) AS week, rating, amount FROM sold)
       SELECT week, rating, CAST(sum(amount) AS DECIMAL(38,2)) AS sales FROM w GROUP BY week, rating
       UNION ALL SELECT week, NULL, CAST(sum(amount) AS DECIMAL(38,2)) FROM w GROUP BY week
       UNION ALL SELECT NULL, NULL, CAST(sum(amount) AS DECIMAL(38,2)) FROM w""",
    "sold",
)
def oltp_weekly_rollup(b: Bridge) -> DataFrame:
    return reports.order_report(reports.weekly_sales_rollup(*_oltp(b)), ["week", "rating"])


def _facts(b: Bridge) -> DataFrame:
    return star.build_sales_facts(b.payment(), b.rental_items(), b.inventory())


def _dates(b: Bridge) -> DataFrame:
    return star.build_date_dim(b.spark, DATE_START)


DAILY_AVG = """SELECT day_of_week, round(CAST(sum(amount) AS DOUBLE) / count(amount), 6) AS sales
               FROM facts JOIN date_dim USING (date_id) GROUP BY CUBE(day_of_week)"""
STAR_WEEKLY = """SELECT week_of_year, rating, CAST(sum(amount) AS DECIMAL(38,2)) AS sales
                 FROM facts JOIN date_dim USING (date_id) JOIN film USING (film_id) GROUP BY CUBE(week_of_year, rating)"""


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("sales", F.round("sales", 6))


@query(DAILY_AVG, "facts", "date_dim")
def olap_daily_avg(b: Bridge) -> DataFrame:
    return reports.order_report(_rounded(reports.star_daily_avg(_facts(b), _dates(b))), ["day_of_week"])


@query(STAR_WEEKLY, "facts", "date_dim")
def olap_weekly_cube(b: Bridge) -> DataFrame:
    cube = reports.star_weekly_cube(_facts(b), _dates(b), star.build_film_dim(b.film()))
    return reports.order_report(cube, ["week_of_year", "rating", "sales"])


@query(DAILY_AVG, "facts", "date_dim")
def stored_daily_average(b: Bridge) -> DataFrame:
    base = scratch_path(b.spark, "reports")
    snapshots.refresh(b.spark, "daily_average_sales", {"sales_facts": _facts(b), "date_dim": _dates(b)}, base, "run-1")
    return _rounded(snapshots.snapshot(b.spark, "daily_average_sales", base))


@query(STAR_WEEKLY, "facts", "date_dim")
def stored_weekly_rating(b: Bridge) -> DataFrame:
    base = scratch_path(b.spark, "reports")
    tables_ = {"sales_facts": _facts(b), "date_dim": _dates(b), "film_dim": star.build_film_dim(b.film())}
    snapshots.refresh(b.spark, "weekly_rating_sales", tables_, base, "run-1")
    return snapshots.snapshot(b.spark, "weekly_rating_sales", base)


# --- star schema --------------------------------------------------------------------------


@query(
    """SELECT d.*, count(l_shipdate) AS payments FROM date_dim d
       LEFT JOIN lineitem ON CAST(l_shipdate AS DATE) = d.date GROUP BY ALL""",
    "date_dim",
)
def date_dimension(b: Bridge) -> DataFrame:
    paid = b.payment_lines().groupBy(date_id(F.col("payment_date")).alias("date_id")).agg(F.count("*").alias("payments"))
    return _dates(b).join(paid, "date_id", "left").fillna(0, ["payments"])


@query(
    """SELECT CAST(o_orderdate AS DATE) AS date, last_day(o_orderdate) AS month_end, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
              CAST(date_trunc('month', o_orderdate - INTERVAL 3 MONTH) AS DATE) AS back_start,
              CAST(date_trunc('month', o_orderdate - INTERVAL 3 MONTH) + INTERVAL 1 MONTH AS DATE) AS back_after, count(*) AS orders
       FROM orders GROUP BY ALL"""
)
def order_months(b: Bridge) -> DataFrame:
    """Month bounds around every order date, and of the month three months before."""
    day = F.to_date("o_orderdate")
    first, after = month_bounds(F.col("date"), 3)
    return (
        b.source("orders").groupBy(day.alias("date")).agg(F.count("*").alias("orders"))
        .select("date", F.last_day("date").alias("month_end"), month_bounds(F.col("date"), 0)[0].alias("month_start"),
                first.alias("back_start"), after.alias("back_after"), "orders")
    )


@query("SELECT * FROM facts", "facts")
def sales_facts_distinct(b: Bridge) -> DataFrame:
    """Every payment twice: equal ones must collapse."""
    doubled = b.payment().unionByName(b.payment())
    return star.build_sales_facts(doubled, b.rental_items(), b.inventory())


@query(
    """, f AS (SELECT * FROM facts UNION SELECT film_id, customer_id, staff_id, date_id, CAST(amount + 1 AS DECIMAL(8,2)) FROM facts)
       SELECT film_id, customer_id, staff_id, date_id, count(*) AS n FROM f GROUP BY ALL HAVING count(*) > 1""",
    "facts",
)
def sales_fact_conflicts(b: Bridge) -> DataFrame:
    dearer = b.payment().withColumn("amount", (F.col("amount") + 1).cast("decimal(8,2)"))
    both = b.payment().unionByName(dearer)
    return star.fact_key_conflicts(star.build_sales_facts(both, b.rental_items(), b.inventory()))


# --- views --------------------------------------------------------------------------------


@query(
    """, t AS (SELECT fa.actor_id, fc.category_id, string_agg(f.title, ', ' ORDER BY f.film_id) AS titles
               FROM film_actor fa JOIN film_category fc USING (film_id) JOIN film f USING (film_id) GROUP BY ALL),
       n AS (SELECT actor_id, c.name || ': ' || titles AS line, min(category_id) AS category_id
             FROM t JOIN category c USING (category_id) GROUP BY 1, 2),
       i AS (SELECT actor_id, string_agg(line, ', ' ORDER BY category_id) AS film_info FROM n GROUP BY 1)
       SELECT a.actor_id, a.first_name, a.last_name, i.film_info FROM actor a LEFT JOIN i USING (actor_id)""",
    "actor", "film_actor", "film_category", "film", "category",
)
def actor_info(b: Bridge) -> DataFrame:
    return reports.actor_info(b.actor(), b.film_actor(), b.film_category(), b.category(), b.film())


FILM_LIST = """SELECT f.film_id AS fid, f.title, f.description, c.name AS category, f.rental_rate AS price, f.length,
                      f.rating, string_agg({name}, ', ' ORDER BY a.actor_id) AS actors
               FROM category c JOIN film_category USING (category_id) JOIN film f USING (film_id)
                    JOIN film_actor USING (film_id) JOIN actor a USING (actor_id)
               GROUP BY 1, 2, 3, 4, 5, 6, 7"""


@query(FILM_LIST.format(name="a.first_name || ' ' || a.last_name"), "actor", "film_actor", "film_category", "film", "category")
def film_list(b: Bridge) -> DataFrame:
    return reports.film_list(b.category(), b.film_category(), b.film(), b.film_actor(), b.actor())


@query(
    FILM_LIST.format(
        name="upper(substring(a.first_name, 1, 1)) || lower(substring(a.first_name, 2)) || "
        "upper(substring(a.last_name, 1, 1)) || lower(substring(a.last_name, 2))"
    ),
    "actor", "film_actor", "film_category", "film", "category",
)
def film_list_names(b: Bridge) -> DataFrame:
    return reports.film_list(b.category(), b.film_category(), b.film(), b.film_actor(), b.actor(), names="joined")


@query(
    """SELECT customer_id AS id, first_name || ' ' || last_name AS name, address, postal_code AS "zip code", phone, city,
              country, CASE WHEN activebool THEN 'active' ELSE '' END AS notes, store_id AS sid
       FROM customers JOIN address USING (address_id) JOIN place USING (city_id)""",
    "customers", "address", "place",
)
def customer_list(b: Bridge) -> DataFrame:
    return reports.customer_list(b.customer(), b.address(), b.city(), b.country())


@query(
    """SELECT staff_id AS id, first_name || ' ' || last_name AS name, address, postal_code AS "zip code", phone, city,
              country, store_id AS sid
       FROM staff JOIN address USING (address_id) JOIN place USING (city_id)""",
    "staff", "address", "place",
)
def staff_list(b: Bridge) -> DataFrame:
    return reports.staff_list(b.staff(), b.address(), b.city(), b.country())


@query(
    """SELECT c.name AS category, CAST(sum(amount) AS DECIMAL(38,2)) AS total_sales
       FROM sold JOIN film_category USING (film_id) JOIN category c USING (category_id) GROUP BY 1""",
    "sold", "film_category", "category",
)
def sales_by_category(b: Bridge) -> DataFrame:
    return reports.sales_by_category(*_oltp(b), b.film_category(), b.category())


@query(
    """SELECT city || ',' || country AS store, first_name || ' ' || last_name AS manager,
              CAST(sum(amount) AS DECIMAL(38,2)) AS total_sales
       FROM sold JOIN store s ON sold.store_id = s.store_id JOIN address a ON s.address_id = a.address_id
            JOIN place USING (city_id) JOIN staff m ON s.manager_staff_id = m.staff_id
       GROUP BY country, city, s.store_id, first_name, last_name""",
    "sold", "store", "address", "place", "staff",
)
def sales_by_store(b: Bridge) -> DataFrame:
    payment, rental, inventory, _ = _oltp(b)
    return reports.sales_by_store(payment, rental, inventory, b.store(), b.address(), b.city(), b.country(), b.staff())


@query(
    """SELECT first_name || ' ' || last_name AS manager, sid, count(*) AS customers FROM
       (SELECT store_id AS sid FROM customers JOIN address USING (address_id) JOIN place USING (city_id)) c
       JOIN store ON store.store_id = c.sid JOIN staff ON staff_id = manager_staff_id GROUP BY ALL""",
    "customers", "address", "place", "store", "staff",
)
def registered_views(b: Bridge) -> DataFrame:
    """The views under their names, queried with SQL."""
    names = ("actor", "film_actor", "film_category", "category", "film", "customer", "address", "city", "country",
             "staff", "store", "inventory")
    shapes = {name: getattr(b, name)() for name in names}
    snapshots.register_views(shapes | {"payment": b.payment_lines(), "rental": b.rental_items()})
    b.store().createOrReplaceTempView("store")
    return b.spark.sql(
        """SELECT staff_list.name AS manager, customer_list.sid, count(*) AS customers
           FROM customer_list JOIN store ON store.store_id = customer_list.sid
                JOIN staff_list ON staff_list.id = store.manager_staff_id
           GROUP BY staff_list.name, customer_list.sid"""
    )


VIEWS = {
    "actor_info": "actor_info", "customer_list": "customer_list", "film_list": "film_list", "staff_list": "staff_list",
    "nicer_but_slower_film_list": "film_list_names", "sales_by_film_category": "sales_by_category",
    "sales_by_store": "sales_by_store",
}


@query("".join(
    f"{' UNION ALL ' if k else ''}SELECT '{view}' AS name, count(*) AS n FROM ({ORACLES[made]})"
    for k, (view, made) in enumerate(VIEWS.items())
))
def views_by_name(b: Bridge) -> DataFrame:
    """All seven views, read by their names."""
    names = ("actor", "film_actor", "film_category", "category", "film", "customer", "address", "city", "country",
             "staff", "store", "inventory")
    shapes = {name: getattr(b, name)() for name in names}
    snapshots.register_views(shapes | {"payment": b.payment_lines(), "rental": b.rental_items()})
    return b.spark.sql(" UNION ALL ".join(f"SELECT '{view}' AS name, count(*) AS n FROM {view}" for view in VIEWS))


def _positions(df: DataFrame) -> DataFrame:
    """Rows of a sorted report with their place, counted as the rows come out. One row per line of the report."""
    placed = df.withColumn("_at", F.monotonically_increasing_id())
    return placed.withColumn("place", F.row_number().over(Window.orderBy("_at")).cast("long")).drop("_at")


@query(
    """SELECT week, rating, sales, row_number() OVER (ORDER BY week NULLS LAST,
              CASE rating WHEN 'G' THEN 1 WHEN 'PG' THEN 2 WHEN 'PG-13' THEN 3 WHEN 'R' THEN 4 WHEN 'NC-17' THEN 5 END NULLS LAST,
              sales NULLS LAST) AS place
       FROM (""" + ORACLES["oltp_weekly_cube"] + ")",
)
def weekly_cube_in_order(b: Bridge) -> DataFrame:
    return _positions(oltp_weekly_cube(b))


@query("SELECT category, total_sales, row_number() OVER (ORDER BY total_sales DESC) AS place FROM (" + ORACLES["sales_by_category"] + ")")
def categories_in_order(b: Bridge) -> DataFrame:
    return _positions(sales_by_category(b))


# --- rentals ------------------------------------------------------------------------------


@query(
    """SELECT * FROM customers WHERE customer_id IN (
         SELECT customer_id FROM payment WHERE CAST(payment_date AS DATE) BETWEEN DATE '2001-04-01' AND DATE '2001-04-30'
         GROUP BY customer_id HAVING sum(amount) > 100000 AND count(customer_id) > 1)""",
    "payment", "customers",
)
def rewards(b: Bridge) -> DataFrame:
    return rentals.rewards_report(b.payment(), b.customer(), 1, 100000, as_of="2001-07-15")


OUT = "SELECT inventory_id FROM rental WHERE return_date IS NULL"


@query(f"SELECT *, inventory_id NOT IN ({OUT}) AS in_stock FROM inventory", "rental", "inventory")
def stock(b: Bridge) -> DataFrame:
    return rentals.stock(b.inventory(), b.rental_items())


@query(f"SELECT * FROM inventory WHERE inventory_id NOT IN ({OUT})", "rental", "inventory")
def stock_in(b: Bridge) -> DataFrame:
    return rentals.film_in_stock(b.inventory(), b.rental_items())


@query(f"SELECT * FROM inventory WHERE inventory_id IN ({OUT})", "rental", "inventory")
def stock_out(b: Bridge) -> DataFrame:
    return rentals.film_not_in_stock(b.inventory(), b.rental_items())


@query(
    f"""SELECT l_orderkey, l_linenumber, l_partkey * 16 + l_suppkey AS inventory_id,
               l_partkey * 16 + l_suppkey NOT IN ({OUT}) AS in_stock FROM lineitem""",
    "rental",
)
def stock_lookup(b: Bridge) -> DataFrame:
    """The flag for ids as they come, many of them unknown."""
    wanted = b.source("lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_partkey") * 16 + F.col("l_suppkey")).alias("inventory_id")
    )
    return rentals.items_in_stock(wanted, b.rental_items())


@query("SELECT inventory_id, min(customer_id) AS customer_id FROM rental WHERE return_date IS NULL GROUP BY 1", "rental")
def held_by(b: Bridge) -> DataFrame:
    return rentals.held_by(b.rental())


BALANCE = """, kept AS (
         SELECT r.customer_id, f.rental_rate, f.rental_duration AS days, f.replacement_cost,
                CAST(trunc((epoch(return_date) - epoch(rental_date)) / 86400) AS BIGINT) AS kept
         FROM rental r JOIN inventory USING (inventory_id) JOIN film f USING (film_id)
         WHERE rental_date <= TIMESTAMP '2000-06-30 12:00:00'),
       fees AS (SELECT customer_id, sum(rental_rate + coalesce(greatest(kept - days, 0), 0) {extra}) AS due FROM kept GROUP BY 1),
       paid AS (SELECT customer_id, sum(amount) AS paid FROM payment WHERE payment_date <= TIMESTAMP '2000-06-30 12:00:00' GROUP BY 1)
       SELECT customer_id, CAST(coalesce(due, 0) - coalesce(paid, 0) AS DECIMAL(18,2)) AS balance
       FROM customers LEFT JOIN fees USING (customer_id) LEFT JOIN paid USING (customer_id)"""
AS_OF = datetime.datetime(2000, 6, 30, 12)


def _balance(b: Bridge, charge: bool) -> DataFrame:
    as_of = F.lit(AS_OF).cast("timestamp_ntz")
    return rentals.customer_balance(
        b.customer(), b.rental(), b.inventory(), b.film(), b.payment(), as_of, charge_replacement=charge
    )


@query(BALANCE.format(extra=""), "payment", "rental", "inventory", "film", "customers")
def customer_balance(b: Bridge) -> DataFrame:
    return _balance(b, charge=False)


@query(
    BALANCE.format(extra="+ CASE WHEN kept > 2 * days THEN replacement_cost ELSE 0 END"),
    "payment", "rental", "inventory", "film", "customers",
)
def customer_balance_replacement(b: Bridge) -> DataFrame:
    return _balance(b, charge=True)


# --- routines called by name


def _call(b: Bridge, text: str) -> DataFrame:
    functions.register_functions(b.spark, {name: getattr(b, name)() for name in functions.NAMES})
    return b.spark.sql(text)


@query(
    f"""SELECT inventory_id, inventory_id NOT IN ({OUT}) AS in_stock, h.customer_id
       FROM inventory LEFT JOIN (SELECT inventory_id, min(customer_id) AS customer_id FROM rental
                                 WHERE return_date IS NULL GROUP BY 1) h USING (inventory_id)""",
    "rental", "inventory",
)
def stock_by_name(b: Bridge) -> DataFrame:
    return _call(
        b,
        """SELECT inventory_id, inventory_in_stock(inventory_id) AS in_stock,
                  inventory_held_by_customer(inventory_id) AS customer_id
           FROM rental_shop_inventory""",
    )


@query(
    f"""SELECT film_id, inventory_id, inventory_id NOT IN ({OUT}) AS in_stock FROM inventory
       WHERE store_id = film_id % 25""",
    "rental", "inventory",
)
def shelf_by_name(b: Bridge) -> DataFrame:
    """Items of each film in one store, those on the shelf and those on rent."""
    call = "SELECT f.film_id, s.inventory_id, {flag} AS in_stock FROM rental_shop_film f, LATERAL {name}(f.film_id, CAST(f.film_id % 25 AS INT)) s"
    here, out = call.format(flag="true", name="film_in_stock"), call.format(flag="false", name="film_not_in_stock")
    return _call(b, f"{here} UNION ALL {out}")


@query(BALANCE.format(extra=""), "payment", "rental", "inventory", "film", "customers")
def balances_by_name(b: Bridge) -> DataFrame:
    return _call(b, f"SELECT * FROM customer_balances(TIMESTAMP_NTZ '{AS_OF}')")


@query(BALANCE.format(extra=""), "payment", "rental", "inventory", "film", "customers")
def balance_by_name(b: Bridge) -> DataFrame:
    return _call(b, f"SELECT customer_id, get_customer_balance(customer_id, TIMESTAMP_NTZ '{AS_OF}') AS balance FROM rental_shop_customer")


@query(ORACLES["rewards"])
def rewards_by_name(b: Bridge) -> DataFrame:
    return _call(b, "SELECT * FROM rewards_report(1, 100000, DATE '2001-07-15')")


@query(
    """SELECT f.film_id, f.customer_id, f.staff_id, f.amount, d.*, last_day(d.date) AS month_end
       FROM facts f JOIN date_dim d USING (date_id)""",
    "facts", "date_dim",
)
def facts_by_name(b: Bridge) -> DataFrame:
    """Facts with their dates, both from table functions."""
    return _call(
        b,
        f"""SELECT f.film_id, f.customer_id, f.staff_id, f.amount, d.*, last_day_of_month(d.date) AS month_end
            FROM get_sales_facts() f JOIN get_date_dim(DATE '{DATE_START}', 5000) d ON d.date_id = f.date_id""",
    )


# --- merges -------------------------------------------------------------------------------


@query(
    """, t AS (SELECT film_id, title, release_year, rating FROM film WHERE description NOT LIKE '% PROMO'),
       s AS (SELECT film_id, upper(title) AS title, release_year, rating FROM film
             WHERE description LIKE '% PROMO' OR description LIKE '% SMALL')
       SELECT * FROM t WHERE film_id NOT IN (SELECT film_id FROM s) UNION ALL SELECT * FROM s""",
    "film",
)
def dim_upsert(b: Bridge) -> DataFrame:
    """Promo films are new to the dimension, small ones change, the rest stays."""
    kind = F.split("description", " ")[1]
    films = b.film()
    target = star.build_film_dim(films.filter(kind != "PROMO"))
    stage = star.build_film_dim(films.filter(kind.isin("PROMO", "SMALL")).withColumn("title", F.upper("title")))
    return upsert.upsert_update(target, stage, ["film_id"])


@query(
    """SELECT customer_id, first_name, last_name, activebool AS known,
              activebool AND store_id < 12 AS stamped FROM customers""",
    "customers",
)
def dim_upsert_stamped(b: Bridge) -> DataFrame:
    """Active customers are known; the others and those of the first stores are staged. Only known ones are stamped."""
    old = F.lit(datetime.datetime(2000, 1, 1)).cast("timestamp")
    people = b.customer().withColumn("last_update", old).withColumnRenamed("activebool", "known")
    columns = ["customer_id", "first_name", "last_name", "known", "last_update"]
    target = people.filter("known").select(*columns)
    stage = people.filter(~F.col("known") | (F.col("store_id") < 12)).select(*columns)
    merged = upsert.upsert_update(target, stage, ["customer_id"], stamp="last_update")
    return merged.withColumn("stamped", F.col("last_update") > old).drop("last_update")


@query(
    """, t AS (SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_id, max(o_orderkey) AS seen FROM orders GROUP BY 1),
       s AS (SELECT CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS date_id, min(l_orderkey) AS seen FROM lineitem GROUP BY 1)
       SELECT * FROM t UNION ALL SELECT * FROM s WHERE date_id NOT IN (SELECT date_id FROM t)""",
)
def dim_insert_absent(b: Bridge) -> DataFrame:
    """Order dates are known; ship dates come many times each."""
    known = b.source("orders").groupBy(date_id(F.col("o_orderdate")).alias("date_id")).agg(F.max("o_orderkey").alias("seen"))
    stage = b.source("lineitem").select(date_id(F.col("l_shipdate")).alias("date_id"), F.col("l_orderkey").alias("seen"))
    return upsert.insert_absent(known, stage, ["date_id"])


@query(
    """, s AS (SELECT film_id, customer_id, staff_id, CAST(strftime(payment_date, '%Y%m%d') AS INTEGER) AS date_id,
                      CAST(amount + 1 AS DECIMAL(8,2)) AS amount FROM sold WHERE rating = 'R')
       SELECT * FROM facts t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.film_id = t.film_id
              AND s.customer_id = t.customer_id AND s.staff_id = t.staff_id AND s.date_id = t.date_id)
       UNION ALL SELECT * FROM s""",
    "facts",
)
def fact_delete_insert(b: Bridge) -> DataFrame:
    """Facts of restricted films come again, one dearer and with their repeats.

    Facts and stage are made from the same sales lines, which are joined once.
    """
    rated = b.film().filter("rating = 'R'").select("film_id")
    again = semi_join(b.inventory(), rated, ["film_id"]).withColumn("again", F.lit(True))
    items = again.unionByName(anti_join(b.inventory(), rated, ["film_id"]).withColumn("again", F.lit(False)))
    lines = star.stored_sales_lines(b.payment(), b.rental_items(), items, "again")
    stage = lines.filter("again").withColumn("amount", (F.col("amount") + 1).cast("decimal(8,2)"))
    facts = stored(star.distinct_facts(lines), scratch_path(b.spark, "facts"))
    return upsert.delete_insert(facts, stage, schemas.STAR_KEYS["sales_facts"])


@query(
    """, t AS (SELECT CASE WHEN c_acctbal > 0 THEN c_custkey END AS k, c_name FROM customer),
       s AS (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS k, o_orderpriority AS c_name FROM orders)
       SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.k = t.k) UNION ALL SELECT * FROM s""",
)
def delete_insert_null_keys(b: Bridge) -> DataFrame:
    """Keys are NULL on both sides for some rows: those never match."""
    target = b.source("customer").select(F.when(F.col("c_acctbal") > 0, F.col("c_custkey")).alias("k"), "c_name")
    stage = b.source("orders").select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("k"), F.col("o_orderpriority").alias("c_name")
    )
    return upsert.delete_insert(target, stage, ["k"])


@query(
    """SELECT film_id, title, CAST(3 AS SMALLINT) AS rental_duration, rental_rate, CAST(19.99 AS DECIMAL(5,2)) AS replacement_cost, rating
       FROM film""",
    "film",
)
def film_defaults(b: Bridge) -> DataFrame:
    """Columns left out take their default; a rating given as NULL stays NULL."""
    given = b.film().select("film_id", "title", "rental_rate", "rating")
    filled = upsert.apply_defaults(given, schemas.column_defaults("film"))
    return filled.select("film_id", "title", "rental_duration", "rental_rate", "replacement_cost", "rating")


@query(
    """, n AS (SELECT l_orderkey * 10 + l_linenumber AS id FROM lineitem)
       SELECT 'row' AS what, id AS value, count(*) AS n FROM n GROUP BY 2
       UNION ALL SELECT 'key', unnest(range(max(id) + 1, max(id) + 1 + count(*))), 1 FROM n"""
)
def surrogate_keys(b: Bridge) -> DataFrame:
    """Every line item numbered on from the highest id in use: how often each row and each key comes out."""
    items = b.source("lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"))
    numbered = assign_keys(items, "key", start=next_key(items, "id"))
    both = F.explode(F.array(F.struct(F.lit("row").alias("what"), F.col("id").alias("value")), F.struct(F.lit("key").alias("what"), F.col("key").alias("value"))))
    return numbered.select(both.alias("b")).groupBy("b.what", "b.value").agg(F.count(F.lit(1)).alias("n"))


# --- writing and reading back -------------------------------------------------------------


@query("SELECT film_id, title, release_year, rating FROM film", "film")
def extract_roundtrip(b: Bridge) -> DataFrame:
    films = star.build_film_dim(b.film())
    path = extract.export_extract(films, scratch_path(b.spark, "films"), ["film_id"])
    return extract.read_extract(b.spark, path, films.schema)


def _maintained(b: Bridge, name: str) -> DataFrame:
    """Facts of which the later months are wrong at first and put right by a load."""
    base, later = scratch_path(b.spark, "maintained"), F.col("date_id") >= 19980101
    facts = _facts(b)
    dims = {"sales_facts": facts, "date_dim": _dates(b), "film_dim": star.build_film_dim(b.film())}
    wrong = F.when(later, F.col("amount") + 1).otherwise(F.col("amount")).cast(facts.schema["amount"].dataType)
    tables.write_fact_months(facts.withColumn("amount", wrong), f"{base}/facts")
    maintained.refresh(b.spark, name, f"{base}/facts", dims, f"{base}/sums")
    months = maintained.replace_facts(b.spark, f"{base}/facts", facts.filter(later))
    maintained.refresh(b.spark, name, f"{base}/facts", dims, f"{base}/sums", months)
    return maintained.read_report(b.spark, name, f"{base}/sums")


@query(DAILY_AVG, "facts", "date_dim")
def maintained_daily_average(b: Bridge) -> DataFrame:
    return _rounded(_maintained(b, "daily_average_sales"))


@query(STAR_WEEKLY, "facts", "date_dim")
def maintained_weekly_rating(b: Bridge) -> DataFrame:
    return _maintained(b, "weekly_rating_sales")


BUCKETS = 16
MERGED = """, s AS (SELECT film_id, customer_id, staff_id, date_id, CAST(amount + 1 AS DECIMAL(8,2)) AS amount FROM facts WHERE film_id % 3 = 0),
       m AS (SELECT * FROM facts WHERE film_id % 3 <> 0 UNION ALL SELECT * FROM s)"""


def _merged(b: Bridge) -> DataFrame:
    """Facts dealt by their key, of which every third film's come again, one dearer."""
    keys, name = schemas.STAR_KEYS["sales_facts"], f"facts_{uuid.uuid4().hex}"
    facts = tables.write_dealt(_facts(b), name, scratch_path(b.spark, "dealt"), keys, BUCKETS)
    stage = facts.filter("film_id % 3 = 0").withColumn("amount", (F.col("amount") + 1).cast(facts.schema["amount"].dataType))
    return tables.merge_dealt(facts, stage, keys, BUCKETS)


@query(MERGED + "SELECT * FROM m", "facts")
def dealt_merge(b: Bridge) -> DataFrame:
    return _merged(b)


@query(MERGED + STAR_WEEKLY.replace("FROM facts", "FROM m"), "facts", "date_dim")
def dealt_report(b: Bridge) -> DataFrame:
    """The weekly report over merged facts, stored dealt once more."""
    path = scratch_path(b.spark, "dealt")
    facts = tables.write_dealt(_merged(b), f"facts_{uuid.uuid4().hex}", path, schemas.STAR_KEYS["sales_facts"], BUCKETS)
    return reports.star_weekly_cube(facts, _dates(b), star.build_film_dim(b.film()))


@query(
    """SELECT CAST(payment_date AS DATE) AS day, count(*) AS n, CAST(sum(amount) AS DECIMAL(38,2)) AS total FROM payment
       WHERE payment_date >= TIMESTAMP '1997-02-10' AND payment_date < TIMESTAMP '1997-05-03' GROUP BY 1""",
    "payment",
)
def payments_between(b: Bridge) -> DataFrame:
    """Payments of a span of days; the month folders to read follow from the days."""
    path = scratch_path(b.spark, "payment")
    payment = b.payment()
    tables.write_partitioned(payment, path, bounds=("1995-01-01", "2002-01-01"))
    rows = tables.read_between(b.spark, path, payment.schema, "1997-02-10", "1997-05-03")
    return rows.groupBy(F.to_date("payment_date").alias("day")).agg(
        F.count("*").alias("n"), F.sum("amount").cast("decimal(38,2)").alias("total")
    )


@query(
    """SELECT week_of_year, count(*) AS n, CAST(sum(amount) AS DECIMAL(38,2)) AS total FROM facts JOIN date_dim USING (date_id)
       WHERE year = 1997 AND week_of_year BETWEEN 10 AND 20 GROUP BY 1""",
    "facts", "date_dim",
)
def facts_of_weeks(b: Bridge) -> DataFrame:
    """Facts of some weeks of one year; the date dimension picks the month folders."""
    base = scratch_path(b.spark, "months")
    facts = _facts(b)
    tables.write_fact_months(facts, f"{base}/facts")
    _dates(b).write.parquet(f"{base}/dates")
    dates = b.spark.read.parquet(f"{base}/dates").filter("year = 1997 AND week_of_year BETWEEN 10 AND 20")
    joined = tables.join_dates(maintained.read_facts(b.spark, f"{base}/facts", facts.schema), dates)
    return joined.groupBy("week_of_year").agg(F.count("*").alias("n"), F.sum("amount").cast("decimal(38,2)").alias("total"))


@query(
    """SELECT strftime(payment_date, '%Y-%m') AS pay_month, count(*) AS n, CAST(sum(amount) AS DECIMAL(38,2)) AS total
       FROM payment GROUP BY 1""",
    "payment",
)
def partitioned_payments(b: Bridge) -> DataFrame:
    path = scratch_path(b.spark, "payment")
    payment = b.payment()
    tables.write_partitioned(payment, path, bounds=("1995-01-01", "2002-01-01"))
    months = tables.read_months(b.spark, path, payment.schema, "1995-01", "2001-12")
    return months.groupBy("pay_month").agg(F.count("*").alias("n"), F.sum("amount").cast("decimal(38,2)").alias("total"))


@query("SELECT date_id, count(*) AS n, CAST(sum(amount) AS DECIMAL(38,2)) AS total FROM facts GROUP BY 1", "facts")
def sorted_facts(b: Bridge) -> DataFrame:
    path = tables.write_fact(_facts(b), scratch_path(b.spark, "facts"))
    kept = b.spark.read.parquet(path)
    return kept.groupBy("date_id").agg(F.count("*").alias("n"), F.sum("amount").cast("decimal(38,2)").alias("total"))


def _rental_tables(b: Bridge) -> dict[str, DataFrame]:
    return {
        "customer": b.customer(), "film": b.film(), "staff": b.staff(), "payment": b.payment(),
        "rental": b.rental_items(), "inventory": b.inventory(),
    }


@query(STAR_WEEKLY, "facts", "date_dim")
def elt_published(b: Bridge) -> DataFrame:
    """The in-database load run twice, published, its stored report read back."""
    base = scratch_path(b.spark, "star")
    for run in ("run-1", "run-2"):
        jobs.run_elt(b.spark, _rental_tables(b), base, run, start=DATE_START)
    return snapshots.snapshot(b.spark, "weekly_rating_sales", base)


@query("SELECT * FROM facts", "facts")
def warehouse_load(b: Bridge) -> DataFrame:
    """Extract, first load, and the same extract loaded again: the facts must be there once."""
    base = scratch_path(b.spark, "warehouse")
    rows = _rental_tables(b)
    layout = {name: df.schema for name, df in jobs.build_star(b.spark, rows, DATE_START).items()}
    jobs.export(b.spark, rows, f"{base}/extracts", DATE_START)
    for run in ("run-1", "run-2"):
        jobs.run_warehouse_load(b.spark, f"{base}/extracts", f"{base}/star", run, layout)
    return jobs.published_star(b.spark, f"{base}/star")["sales_facts"]


@query("SELECT film_id, CASE WHEN film_id % 2 = 0 THEN upper(title) ELSE title END AS title, release_year, rating FROM film", "film")
def elt_dimension(b: Bridge) -> DataFrame:
    """The load run twice: films of the second run are updated or new, those it lacks stay."""
    base = scratch_path(b.spark, "star")
    rows, number = _rental_tables(b), F.col("film_id")
    first = rows | {"film": rows["film"].filter((number % 2 != 0) | (number % 3 == 0))}
    second = rows | {"film": rows["film"].filter(number % 2 == 0).withColumn("title", F.upper("title"))}
    for run, tables_ in (("run-1", first), ("run-2", second)):
        jobs.run_elt(b.spark, tables_, base, run, start=DATE_START)
    return jobs.published_star(b.spark, base)["film_dim"]


@query(
    """, s AS (SELECT DISTINCT film_id, customer_id, staff_id, CAST(strftime(payment_date, '%Y%m%d') AS INTEGER) AS date_id,
                      CAST(amount + 1 AS DECIMAL(8,2)) AS amount FROM sold WHERE payment_date >= TIMESTAMP '1998-01-01'),
       f AS (SELECT * FROM facts t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.film_id = t.film_id
                    AND s.customer_id = t.customer_id AND s.staff_id = t.staff_id AND s.date_id = t.date_id)
             UNION ALL SELECT * FROM s)
       SELECT 'sales_facts' AS name, concat_ws('-', film_id, customer_id, staff_id, date_id) AS key, CAST(amount AS VARCHAR) AS value FROM f
       UNION ALL SELECT 'film_dim', CAST(film_id AS VARCHAR), CASE WHEN film_id % 2 = 0 THEN upper(title) ELSE title END FROM film
       UNION ALL SELECT 'customer_dim', CAST(customer_id AS VARCHAR),
                        CASE WHEN customer_id % 2 = 1 THEN last_name || 'x' ELSE last_name END FROM customers
       UNION ALL SELECT 'staff_dim', CAST(staff_id AS VARCHAR), last_name FROM staff
       UNION ALL SELECT 'date_dim', CAST(date_id AS VARCHAR), CAST(date AS VARCHAR) FROM date_dim""",
    "facts", "film", "customers", "staff", "date_dim",
)
def warehouse_reload(b: Bridge) -> DataFrame:
    """A first load, then extracts of a part that is changed: all five tables as they are after it."""
    base = scratch_path(b.spark, "warehouse")
    rows = _rental_tables(b)
    layout = {name: df.schema for name, df in jobs.build_star(b.spark, rows, DATE_START).items()}
    part = rows | {
        "payment": rows["payment"].filter("payment_date >= TIMESTAMP_NTZ '1998-01-01'")
        .withColumn("amount", (F.col("amount") + 1).cast(rows["payment"].schema["amount"].dataType)),
        "film": rows["film"].filter("film_id % 2 = 0").withColumn("title", F.upper("title")),
        "customer": rows["customer"].filter("customer_id % 2 = 1").withColumn("last_name", F.concat("last_name", F.lit("x"))),
    }
    for run, tables_ in (("run-1", rows), ("run-2", part)):
        jobs.export(b.spark, tables_, f"{base}/{run}", DATE_START)
        jobs.run_warehouse_load(b.spark, f"{base}/{run}", f"{base}/star", run, layout)
    loaded = jobs.published_star(b.spark, f"{base}/star")
    shown = {
        "sales_facts": (F.concat_ws("-", "film_id", "customer_id", "staff_id", "date_id"), F.col("amount")),
        "film_dim": (F.col("film_id"), F.col("title")),
        "customer_dim": (F.col("customer_id"), F.col("last_name")),
        "staff_dim": (F.col("staff_id"), F.col("last_name")),
        "date_dim": (F.col("date_id"), F.col("date")),
    }
    parts = [
        loaded[name].select(F.lit(name).alias("name"), key.cast("string").alias("key"), value.cast("string").alias("value"))
        for name, (key, value) in shown.items()
    ]
    return reduce(DataFrame.unionByName, parts)


# --- weather ------------------------------------------------------------------------------


@query("SELECT * FROM clean", "clean")
def weather_daily(b: Bridge) -> DataFrame:
    return weather.clean_days(b.weather_days())


@query("SELECT * FROM clean", "clean")
def weather_shapes(b: Bridge) -> DataFrame:
    """The same days landed in three envelopes, read in one go and cleaned by the job."""
    base = scratch_path(b.spark, "weather")
    bare = F.struct(*weather.DAY_FIELDS)
    shape = F.when(F.col("location") == "click", 0).when(F.col("location") == "view", 1).otherwise(2)
    days = b.weather_days()
    wrapped = days.select(
        F.when(shape == 0, F.struct(F.array(bare).alias("weather"))).alias("data"),
        F.when(shape == 1, F.array(bare)).alias("weather"),
        *[F.when(shape == 2, F.col(c)).alias(c) for c in weather.DAY_FIELDS],
        *schemas.LANDING_KEYS,
    )
    # Every day comes twice, first with a temperature that is put right by the second file.
    stale = days.withColumn("maxtempF", F.lit("-1"))
    landing.write_landing(stale, f"{base}/raw")
    landing.write_landing(wrapped, f"{base}/raw")
    for _ in range(2):
        jobs.clean_weather(b.spark, f"{base}/raw", f"{base}/clean")
    return landing.read_clean(b.spark, f"{base}/clean")


@query(
    """SELECT location, year, month, count(*) AS days, CAST(max("maxtempF") AS FLOAT) AS high FROM clean GROUP BY ALL""",
    "clean",
)
def weather_registered(b: Bridge) -> DataFrame:
    """Raw and clean folder as catalog tables with their partitions; the job reads one by name.

    The tables have names of their own and are gone from the catalog once the result is stored.
    """
    base = scratch_path(b.spark, "catalog")
    raw, clean = (f"{kind}weather_{uuid.uuid4().hex}" for kind in ("raw", "clean"))
    landing.write_landing(b.weather_days(), f"{base}/raw")
    tables.register(b.spark, raw, f"{base}/raw", schemas.LANDING_KEYS, "json", schemas.LANDING)
    jobs.clean_weather(b.spark, raw, f"{base}/clean", catalog=True)
    table = tables.register(b.spark, clean, f"{base}/clean", landing.CLEAN_PARTITIONS)
    found = table.groupBy("location", "year", "month").agg(F.count("*").alias("days"), F.max("maxtempF").alias("high"))
    found.write.parquet(f"{base}/found")
    for name in (raw, clean):
        b.spark.sql(f"DROP TABLE {name}")
    return b.spark.read.parquet(f"{base}/found")


@query(
    """SELECT location, year, month, count(*) AS days, CAST(sum("uvIndex") AS BIGINT) AS uv,
              max(CASE WHEN location = 'click' THEN CAST("maxtempF" AS DOUBLE) - CAST("mintempF" AS DOUBLE) END) AS widest
       FROM clean GROUP BY ALL""",
    "clean",
)
def weather_crawled(b: Bridge) -> DataFrame:
    """A table that is crawled twice: one location comes later, with a wider type and a column of its own."""
    base, name = scratch_path(b.spark, "crawled"), f"crawled_{uuid.uuid4().hex}"
    clean = weather.clean_days(b.weather_days()).withColumns(
        {"year": F.date_format("date", "yyyy"), "month": F.date_format("date", "MM")}
    ).select(*landing.CLEAN_PARTITIONS, "uvIndex", "maxtempF", "mintempF", "date")
    late = F.col("location") == "click"
    landing.write_clean(clean.filter(~late), base, "append")
    crawl.crawl(b.spark, name, base, landing.CLEAN_PARTITIONS)
    spread = F.col("maxtempF").cast("double") - F.col("mintempF").cast("double")
    wider = clean.filter(late).withColumns({"uvIndex": F.col("uvIndex").cast("long"), "spread": spread})
    landing.write_clean(wider, base, "append")
    table = crawl.crawl(b.spark, name, base, landing.CLEAN_PARTITIONS)
    found = table.groupBy("location", "year", "month").agg(
        F.count("*").alias("days"), F.sum("uvIndex").alias("uv"), F.max("spread").alias("widest")
    )
    found.write.parquet(f"{base}_found")
    b.spark.sql(f"DROP TABLE {name}")
    return b.spark.read.parquet(f"{base}_found")


@query(
    """SELECT date, "mintempF", "avgtempF", "maxtempF", "avgHumidity", "avgPressure", "totalPrecipMM"
       FROM clean ORDER BY date, location LIMIT 5""",
    "clean",
)
def weather_preview(b: Bridge) -> DataFrame:
    return weather.preview_days(weather.clean_days(b.weather_days()))


def _busy_days(b: Bridge) -> DataFrame:
    """Days with an event, for each kind and group of users; with this many groups, days are missing."""
    location = F.concat("event_type", (F.col("user_id") % 97).cast("string"))
    return b.source("events").select(location.alias("location"), F.to_date("ts").alias("date"))


@query(
    """, span AS (SELECT location, min(date) AS low FROM busy_days GROUP BY 1),
       wanted AS (SELECT location, CAST(unnest(generate_series(low, DATE '2024-02-04', INTERVAL 1 DAY)) AS DATE) AS date FROM span)
       SELECT * FROM wanted w WHERE NOT EXISTS (SELECT 1 FROM busy_days b WHERE b.location = w.location AND b.date = w.date)""",
    "busy_days",
)
def weather_missing_days(b: Bridge) -> DataFrame:
    return weather.missing_days(_busy_days(b), "2024-02-05")


@query(
    """SELECT location, CAST(max(date) + 1 AS DATE) AS date FROM busy_days GROUP BY 1 HAVING max(date) + 1 < DATE '2024-02-05'""",
    "busy_days",
)
def weather_next_day(b: Bridge) -> DataFrame:
    return weather.next_day(_busy_days(b), "2024-02-05")


@query("SELECT * FROM clean", "clean")
def streamed_days(b: Bridge) -> DataFrame:
    """Days landed in two deliveries that overlap, some broken or empty at first, taken in by two runs on one log."""
    base = scratch_path(b.spark, "intake")
    days = b.weather_days()
    early = (F.col("day") < "16") & ~F.col("day").isin(*BROKEN_DAYS, *EMPTY_DAYS)
    stale = days.withColumn("maxtempF", F.when(early, F.col("maxtempF")).otherwise(F.lit("-1")))
    for delivery in (_replies(stale), days.filter(~early)):
        _land(delivery, f"{base}/raw")
        intake.take_in(b.spark, f"{base}/raw", f"{base}/log")
        done = intake.compact_days(b.spark, f"{base}/log", f"{base}/clean")
    return done


BROKEN_DAYS, EMPTY_DAYS = ("07", "14"), ("21",)


def _replies(days: DataFrame) -> DataFrame:
    """Days as the text of replies; some end too early, some hold no day."""
    text = F.to_json(F.struct(*weather.DAY_FIELDS))
    cut = F.expr("substring(_text, 1, length(_text) div 2)")
    return days.withColumn("_text", text).select(
        F.when(F.col("day").isin(*BROKEN_DAYS), cut)
        .when(F.col("day").isin(*EMPTY_DAYS), F.lit('{"data": {"weather": []}}'))
        .otherwise(F.col("_text"))
        .alias("value"),
        *schemas.LANDING_KEYS,
    )


def _land(days: DataFrame, root: str) -> None:
    if "value" in days.columns:
        days.hint("rebalance", *schemas.LANDING_KEYS).write.mode("append").partitionBy(*schemas.LANDING_KEYS).text(root)
    else:
        landing.write_landing(days, root)


@query(
    """SELECT location, year, month, day, CASE WHEN day = '21' THEN 'no day in it' ELSE 'not a JSON document' END AS reason
       FROM clean WHERE day IN ('07', '14', '21')""",
    "clean",
)
def weather_rejected(b: Bridge) -> DataFrame:
    """Replies without a day, in batches of few files; they are kept with the reason."""
    base = scratch_path(b.spark, "rejects")
    _land(_replies(b.weather_days()), f"{base}/raw")
    intake.take_in(b.spark, f"{base}/raw", f"{base}/log", files_per_batch=100)
    return intake.rejected_documents(b.spark, f"{base}/log").select(*schemas.LANDING_KEYS, "reason")


# --- data quality -------------------------------------------------------------------------


@query(
    """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"""
)
def quality_unique(b: Bridge) -> DataFrame:
    return quality.check_unique(b.source("lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    """SELECT payment_id, staff_id, amount FROM payment
       WHERE staff_id NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)""",
    "payment",
)
def quality_fk(b: Bridge) -> DataFrame:
    """Payments of staff that is gone: those with a balance below zero."""
    staff = b.source("supplier").filter("s_acctbal > 0").select(F.col("s_suppkey").alias("staff_id"))
    payment = b.payment().select("payment_id", "staff_id", "amount")
    return quality.check_fk(payment, "staff_id", staff, "staff_id")


@query("SELECT film_id, rating FROM film WHERE rating NOT IN ('G', 'PG', 'PG-13')", "film")
def quality_enum(b: Bridge) -> DataFrame:
    return quality.check_enum(b.film().select("film_id", "rating"), "rating", schemas.RATINGS[:3])


@query("SELECT film_id, release_year FROM film WHERE release_year NOT BETWEEN 1995 AND 2010", "film")
def quality_range(b: Bridge) -> DataFrame:
    return quality.check_range(b.film().select("film_id", "release_year"), "release_year", 1995, 2010)


@query("SELECT rental_id, return_date FROM rental WHERE return_date IS NULL", "rental")
def quality_null(b: Bridge) -> DataFrame:
    return quality.check_null(b.rental().select("rental_id", "return_date"), ["return_date"])


@query(
    """SELECT payment_id, payment_date FROM payment
       WHERE payment_date < TIMESTAMP '1996-01-01' OR payment_date >= TIMESTAMP '2001-01-01'""",
    "payment",
)
def quality_bounds(b: Bridge) -> DataFrame:
    payment = b.payment().select("payment_id", "payment_date")
    return tables.outside_months(payment, bounds=("1996-01-01", "2001-01-01"))


@query("SELECT doc_id, source, lang FROM documents WHERE strlen(text) > 254 OR strlen(source) > 4")
def quality_length(b: Bridge) -> DataFrame:
    rows = b.source("documents")
    return quality.check_length(rows, {"text": 254, "source": 4}).select("doc_id", "source", "lang")


@query(
    """SELECT customer_id, last_name FROM customers WHERE NOT activebool AND customer_id IN (SELECT o_custkey FROM orders)""",
    "customers",
)
def quality_restrict(b: Bridge) -> DataFrame:
    """Inactive customers that cannot be removed, because orders point at them."""
    removed = b.customer().filter(~F.col("activebool")).select("customer_id", "last_name")
    return quality.check_restrict(removed, "customer_id", b.source("orders"), "o_custkey")


@query(
    """SELECT o_orderkey, CASE WHEN c_acctbal < 0 THEN o_custkey + 1000000000 ELSE o_custkey END AS o_custkey
       FROM orders LEFT JOIN customer ON o_custkey = c_custkey"""
)
def quality_cascade(b: Bridge) -> DataFrame:
    """Customers in debt get a new key; their orders follow."""
    moved = b.source("customer").filter("c_acctbal < 0").select(
        F.col("c_custkey").alias("old"), (F.col("c_custkey") + 1000000000).alias("new")
    )
    return quality.cascade(b.source("orders").select("o_orderkey", "o_custkey"), "o_custkey", moved)


@query(
    """, f AS (SELECT film_id AS old, CASE WHEN film_id % 3 = 0 THEN film_id + 1000000000 ELSE film_id END AS new FROM film),
       s AS (SELECT staff_id AS old, CASE WHEN staff_id % 2 = 0 THEN staff_id + 2000000000 ELSE staff_id END AS new FROM staff)
       SELECT 'film' AS name, new AS key, count(*) AS n FROM f GROUP BY 2
       UNION ALL SELECT 'inventory', new, count(*) FROM inventory JOIN f ON film_id = old GROUP BY 2
       UNION ALL SELECT 'film_category', new, count(*) FROM film_category JOIN f ON film_id = old GROUP BY 2
       UNION ALL SELECT 'film_actor', new, count(*) FROM film_actor JOIN f ON film_id = old GROUP BY 2
       UNION ALL SELECT 'staff', new, count(*) FROM s GROUP BY 2
       UNION ALL SELECT 'payment', new, count(*) FROM payment JOIN s ON staff_id = old GROUP BY 2
       UNION ALL SELECT 'rental', new, count(*) FROM rental JOIN s ON staff_id = old GROUP BY 2""",
    "film", "staff", "inventory", "film_category", "film_actor", "payment", "rental",
)
def quality_cascade_all(b: Bridge) -> DataFrame:
    """New keys of films and staff, followed through all tables that point at them."""
    changes = {
        name: df.filter(F.col(key) % every == 0).select(F.col(key).alias("old"), (F.col(key) + shift).alias("new"))
        for name, df, key, every, shift in (("film", b.film(), "film_id", 3, 1_000_000_000), ("staff", b.staff(), "staff_id", 2, 2_000_000_000))
    }
    names = {"film": "film_id", "inventory": "film_id", "film_category": "film_id", "film_actor": "film_id", "staff": "staff_id",
             "payment": "staff_id", "rental": "staff_id"}
    moved = quality.cascade_keys({name: getattr(b, name)() for name in names}, changes)
    parts = [
        moved[name].groupBy(F.lit(name).alias("name"), F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
        for name, key in names.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    """SELECT film_id, 'inventory' AS child, 'film_id' AS "column" FROM film WHERE film_id % 10 = 0 AND film_id IN (SELECT film_id FROM inventory)
       UNION ALL SELECT film_id, 'film_category', 'film_id' FROM film WHERE film_id % 10 = 0 AND film_id IN (SELECT film_id FROM film_category)
       UNION ALL SELECT film_id, 'film_actor', 'film_id' FROM film WHERE film_id % 10 = 0 AND film_id IN (SELECT film_id FROM film_actor)""",
    "film", "inventory", "film_category", "film_actor",
)
def quality_restrict_all(b: Bridge) -> DataFrame:
    """Every reference that keeps a film from being removed."""
    names = ("film", "inventory", "film_category", "film_actor")
    return quality.restrict_keys({n: getattr(b, n)() for n in names}, "film", b.film().filter("film_id % 10 = 0"))


# Rules whose column or parent table the given tables have no counterpart for.
ABSENT = """
    ('actor.not_null(last_update)'), ('address.not_null(district)'), ('address.not_null(last_update)'),
    ('category.not_null(last_update)'), ('city.not_null(last_update)'), ('country.not_null(last_update)'),
    ('customer.not_null(create_date)'), ('film.fk(language_id)'), ('film.fk(original_language_id)'),
    ('film.not_null(fulltext)'), ('film.not_null(language_id)'), ('film.not_null(last_update)'),
    ('film_actor.not_null(last_update)'), ('film_category.not_null(last_update)'),
    ('inventory.not_null(last_update)'), ('rental.not_null(last_update)'), ('staff.not_null(active)'),
    ('staff.not_null(last_update)'), ('staff.not_null(username)'), ('store.not_null(last_update)')
"""


@query(
    """, uniq AS (SELECT count(*) AS n FROM (SELECT rental_date, inventory_id, customer_id FROM rental GROUP BY ALL HAVING count(*) > 1)),
       noroom AS (SELECT count(*) AS n FROM inventory WHERE store_id NOT IN (SELECT store_id FROM store)),
       nohome AS (SELECT count(*) AS n FROM customers WHERE store_id NOT IN (SELECT store_id FROM store))
       SELECT 'rental.unique(rental_date,inventory_id,customer_id)' AS rule, n AS violations FROM uniq WHERE n > 0
       UNION ALL SELECT 'inventory.fk(store_id)', n FROM noroom WHERE n > 0
       UNION ALL SELECT 'customer.fk(store_id)', n FROM nohome WHERE n > 0
       UNION ALL SELECT rule, NULL FROM (VALUES """ + ABSENT + ") AS t(rule)",
    "rental", "inventory", "store", "customers",
)
def quality_all(b: Bridge) -> DataFrame:
    """Every declared constraint: the rules that some row breaks, and those that lack a column."""
    names = ("customer", "staff", "store", "address", "city", "country", "film", "inventory", "rental", "payment",
             "actor", "category", "film_actor", "film_category")
    found = quality.audit({name: getattr(b, name)() for name in names})
    return found.filter("violations > 0 OR violations IS NULL")


# --- word index ---------------------------------------------------------------------------

STOPS = ", ".join(f"'{w}'" for w in textindex.STOP_WORDS)
INDEX = f""", w AS (SELECT {{key}}, regexp_extract_all(lower({{text}}), '[\\p{{{{L}}}}\\p{{{{N}}}}]+') AS ws FROM {{table}}),
       t AS (SELECT {{key}}, unnest(ws) AS token, generate_subscripts(ws, 1) AS spot FROM w),
       idx AS (SELECT token, {{key}}, list(CAST(spot AS INTEGER) ORDER BY spot) AS positions FROM t WHERE token NOT IN ({STOPS}) GROUP BY 1, 2)
       """
DOC_INDEX = INDEX.format(key="doc_id", text="source || ' ' || text", table="documents")
FILM_INDEX = INDEX.format(key="film_id", text="title || ' ' || description", table="film")


@query(
    DOC_INDEX + "SELECT token, doc_id, len(positions) AS hits, CAST(list_sum(positions) AS BIGINT) AS position_sum FROM idx"
)
def text_index(b: Bridge) -> DataFrame:
    """The word index of whole texts; positions are summed up to one number for the comparison."""
    index = textindex.token_index(b.source("documents"), "doc_id", ["source", "text"])
    total = F.aggregate("positions", F.lit(0).cast("bigint"), lambda acc, at: acc + at)
    return index.select("token", "doc_id", F.size("positions").cast("bigint").alias("hits"), total.alias("position_sum"))


@query(
    FILM_INDEX + "SELECT token, film_id, array_to_string(positions, ' ') AS positions FROM idx", "film"
)
def film_fulltext(b: Bridge) -> DataFrame:
    index = textindex.token_index(b.film(), "film_id", ["title", "description"])
    return index.withColumn("positions", F.array_join(F.col("positions").cast("array<string>"), " "))


@query(
    r""", w AS (SELECT doc_id, ' ' || array_to_string(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+'), '  ') || ' ' AS ws
               FROM documents)
       SELECT doc_id, CAST((length(ws) - length(replace(ws, ' mit  license ', ''))) // length(' mit  license ') AS BIGINT) AS places
       FROM w WHERE contains(ws, ' mit  license ')""",
)
def phrase_places(b: Bridge) -> DataFrame:
    """Where two words stand one after the other, from the positions of the index."""
    index = textindex.token_index(b.source("documents"), "doc_id", ["text"])
    return textindex.phrase_search(index, "doc_id", "MIT License")


KEPT = INDEX.format(key="film_id", text="title || ' ' || description", table="kept")


@query(
    """, kept AS (SELECT film_id, CASE WHEN film_id % 7 = 0 THEN upper(title) || ' again ' || title ELSE title END AS title, description
                  FROM film WHERE film_id % 11 <> 0)""" + KEPT +
    "SELECT token, film_id, array_to_string(positions, ' ') AS positions FROM idx", "film"
)
def film_index_kept(b: Bridge) -> DataFrame:
    """The stored index after some films got a new title and others were removed; only their slices are written again."""
    path = scratch_path(b.spark, "film-kept")
    text = ["title", "description"]
    films = b.film()
    textindex.write_kept_index(textindex.token_index(films, "film_id", text), "film_id", path)
    changed = films.filter("film_id % 7 = 0 AND film_id % 11 <> 0")
    changed = changed.withColumn("title", F.concat_ws(" again ", F.upper("title"), "title"))
    textindex.update_index(b.spark, path, "film_id", changed, text, gone=films.filter("film_id % 11 = 0"))
    index = textindex.read_kept_index(b.spark, path)
    return index.select("token", "film_id", F.array_join(F.col("positions").cast("array<string>"), " ").alias("positions"))


@query(
    FILM_INDEX + """SELECT film_id, CAST(sum(len(positions)) AS BIGINT) AS hits FROM idx WHERE token IN ('widget', 'promo')
       GROUP BY 1 HAVING count(*) = 2""",
    "film",
)
def film_search(b: Bridge) -> DataFrame:
    """Search in the stored index."""
    index = textindex.token_index(b.film(), "film_id", ["title", "description"])
    path = textindex.write_index(index, "film_id", scratch_path(b.spark, "film-index"))
    return textindex.search(textindex.read_index(b.spark, path), "film_id", ["Widget", "the", "PROMO"])
