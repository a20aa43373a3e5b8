"""The routines of the rental shop by name, as functions of Spark SQL.

Each is one expression or query over the tables. Spark puts a function's body in place of its call, so a call for every
row of a table plans as joins and aggregations of whole tables, and only the needed columns are read.
The functions are temporary, as are the views they read; they belong to the session they are registered in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martlake.operators.rentals import MONEY

#: Prefix of the views that the functions read, so that no table of the session is hidden.
PREFIX = "rental_shop_"

# Name, parameters, result and body. Tables stand in braces, functions that a body calls come first.
SCALARS = [
    (
        "inventory_in_stock",
        "p_inventory_id BIGINT",
        "BOOLEAN",
        "(SELECT count(*) = 0 FROM {rental} r WHERE r.inventory_id = p_inventory_id AND r.return_date IS NULL)",
    ),
    (
        "inventory_held_by_customer",
        "p_inventory_id BIGINT",
        "BIGINT",
        "(SELECT min(r.customer_id) FROM {rental} r WHERE r.inventory_id = p_inventory_id AND r.return_date IS NULL)",
    ),
    # A date for each row would join rentals with the different dates of the call; for one date, `customer_balances` has no such join.
    (
        "get_customer_balance",
        "p_customer_id BIGINT, p_effective_date TIMESTAMP_NTZ",
        MONEY,
        """CAST(coalesce((
             SELECT sum(f.rental_rate + coalesce(greatest(timestampdiff(DAY, r.rental_date, r.return_date) - f.rental_duration, 0), 0))
             FROM {rental} r JOIN {inventory} i ON r.inventory_id = i.inventory_id JOIN {film} f ON i.film_id = f.film_id
             WHERE r.customer_id = p_customer_id AND r.rental_date <= p_effective_date), 0)
           - coalesce((
             SELECT sum(p.amount) FROM {payment} p
             WHERE p.customer_id = p_customer_id AND p.payment_date <= p_effective_date), 0) AS """ + MONEY + ")",
    ),
    ("last_day_of_month", "p_date DATE", "DATE", "last_day(p_date)"),
]
TABLES = [
    (
        "film_in_stock",
        "p_film_id BIGINT, p_store_id INT",
        "inventory_id BIGINT",
        """SELECT i.inventory_id FROM {inventory} i
           LEFT ANTI JOIN (SELECT inventory_id FROM {rental} WHERE return_date IS NULL) o ON o.inventory_id = i.inventory_id
           WHERE i.film_id = p_film_id AND i.store_id = p_store_id""",
    ),
    (
        "film_not_in_stock",
        "p_film_id BIGINT, p_store_id INT",
        "inventory_id BIGINT",
        """SELECT i.inventory_id FROM {inventory} i
           LEFT SEMI JOIN (SELECT inventory_id FROM {rental} WHERE return_date IS NULL) o ON o.inventory_id = i.inventory_id
           WHERE i.film_id = p_film_id AND i.store_id = p_store_id""",
    ),
    (
        "customer_balances",
        "p_effective_date TIMESTAMP_NTZ",
        f"customer_id BIGINT, balance {MONEY}",
        """SELECT c.customer_id, CAST(coalesce(due, 0) - coalesce(paid, 0) AS """ + MONEY + """)
           FROM {customer} c
           LEFT JOIN (
             SELECT r.customer_id,
                    sum(f.rental_rate + coalesce(greatest(timestampdiff(DAY, r.rental_date, r.return_date) - f.rental_duration, 0), 0)) AS due
             FROM {rental} r JOIN {inventory} i ON r.inventory_id = i.inventory_id JOIN {film} f ON i.film_id = f.film_id
             WHERE r.rental_date <= p_effective_date GROUP BY r.customer_id) d ON d.customer_id = c.customer_id
           LEFT JOIN (
             SELECT customer_id, sum(amount) AS paid FROM {payment}
             WHERE payment_date <= p_effective_date GROUP BY customer_id) p ON p.customer_id = c.customer_id""",
    ),
    (
        "rewards_report",
        "min_monthly_purchases INT, min_dollar_amount_purchased DECIMAL(18,2), p_as_of DATE",
        "{customer}",
        """SELECT c.* FROM {customer} c LEFT SEMI JOIN (
             SELECT customer_id FROM {payment}
             WHERE CAST(payment_date AS DATE) >= trunc(add_months(p_as_of, -3), 'MM')
               AND CAST(payment_date AS DATE) <= last_day(add_months(p_as_of, -3))
             GROUP BY customer_id
             HAVING sum(amount) > min_dollar_amount_purchased AND count(customer_id) > min_monthly_purchases
           ) e ON e.customer_id = c.customer_id
           WHERE CASE WHEN coalesce(min_monthly_purchases, 0) = 0 OR coalesce(min_dollar_amount_purchased, 0) = 0
                      THEN raise_error('minimum purchases and amount must be numbers other than 0') ELSE true END""",
    ),
    (
        "get_sales_facts",
        "",
        "film_id BIGINT, customer_id BIGINT, staff_id BIGINT, date_id INT, amount DECIMAL(18,2)",
        """SELECT DISTINCT i.film_id, p.customer_id, p.staff_id, CAST(date_format(p.payment_date, 'yyyyMMdd') AS INT), p.amount
           FROM {payment} p JOIN {rental} r ON p.rental_id = r.rental_id JOIN {inventory} i ON r.inventory_id = i.inventory_id""",
    ),
    (
        "get_date_dim",
        "p_start DATE, p_days INT",
        "date_id INT, date DATE, year INT, month INT, day_of_month INT, week_of_year INT, day_of_week INT",
        """SELECT CAST(date_format(d, 'yyyyMMdd') AS INT), d, extract(YEAROFWEEK FROM d), month(d), dayofmonth(d), weekofyear(d),
                  weekday(d) + 1
           FROM (SELECT explode(sequence(p_start, date_add(p_start, p_days))) AS d)""",
    ),
]
NAMES = ["customer", "film", "inventory", "payment", "rental"]


def register_functions(spark: SparkSession, tables: dict[str, DataFrame], prefix: str = PREFIX) -> list[str]:
    """Make the routines callable from SQL over these rental tables; returns their names."""
    views = {name: f"{prefix}{name}" for name in NAMES}
    for name, view in views.items():
        tables[name].createOrReplaceTempView(view)
    columns = {"customer": ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tables["customer"].schema)}
    for name, given, kind, body in SCALARS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({given}) RETURNS {kind} RETURN {body.format(**views)}")
    for name, given, kind, body in TABLES:
        kind, text = kind.format(**columns), body.format(**views)
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({given}) RETURNS TABLE({kind}) RETURN {text}")
    return sorted(name for name, *_ in SCALARS + TABLES)
