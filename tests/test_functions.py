"""Routines called by name from SQL: plans, values on a few rows, and arguments that stop."""

import datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException

from martlake.plans import functions


@pytest.fixture(scope="module")
def shop(spark):
    day = datetime.datetime
    tables = {
        "customer": spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "customer_id long, first_name string"),
        "film": spark.createDataFrame([(7, Decimal("2.00"), 3)], "film_id long, rental_rate decimal(8,2), rental_duration int"),
        "inventory": spark.createDataFrame([(70, 7, 1), (71, 7, 1), (72, 7, 2)], "inventory_id long, film_id long, store_id int"),
        "rental": spark.createDataFrame(
            [
                (1, day(2020, 1, 1), 70, 1, day(2020, 1, 6, 1)),
                (2, day(2020, 2, 1), 71, 2, None),
                (3, day(2020, 3, 1), 71, 1, None),
            ],
            "rental_id long, rental_date timestamp_ntz, inventory_id long, customer_id long, return_date timestamp_ntz",
        ),
        "payment": spark.createDataFrame(
            [(1, 1, Decimal("5.50"), day(2020, 1, 7)), (2, 1, Decimal("5.50"), day(2020, 1, 31, 23)), (3, 2, Decimal("9"), day(2020, 2, 1))],
            "rental_id long, customer_id long, amount decimal(8,2), payment_date timestamp_ntz",
        ).selectExpr("rental_id", "customer_id", "1L AS staff_id", "amount", "payment_date"),
    }
    functions.register_functions(spark, tables)
    return spark


def rows(spark, text):
    return sorted(tuple(r) for r in spark.sql(text).collect())


def test_stock_and_holder(shop):
    found = rows(shop, "SELECT x, inventory_in_stock(x), inventory_held_by_customer(x) FROM VALUES (70), (71), (99) t(x)")
    assert found == [(70, True, None), (71, False, 1), (99, True, None)]
    assert rows(shop, "SELECT * FROM film_in_stock(7, 1)") == [(70,)]
    assert rows(shop, "SELECT * FROM film_not_in_stock(7, 1)") == [(71,)]
    assert rows(shop, "SELECT * FROM film_in_stock(8, 1)") == []


def test_balance(shop):
    text = "SELECT customer_id, get_customer_balance(customer_id, TIMESTAMP_NTZ '2020-01-31') FROM rental_shop_customer"
    # Five days and an hour at a duration of three: two dollars on top of the rate.
    assert rows(shop, text) == [(1, Decimal("-1.50")), (2, Decimal("0.00")), (3, Decimal("0.00"))]
    assert rows(shop, "SELECT * FROM customer_balances(TIMESTAMP_NTZ '2020-01-31')") == rows(shop, text)


def test_rewards(shop):
    found = rows(shop, "SELECT customer_id FROM rewards_report(1, 10, DATE '2020-04-15')")
    assert found == [(1,)]
    with pytest.raises(PySparkException, match="other than 0"):
        shop.sql("SELECT * FROM rewards_report(0, 10, DATE '2020-04-15')").collect()


def test_dates_and_facts(shop):
    days = rows(shop, "SELECT * FROM get_date_dim(DATE '2012-12-31', 1)")
    assert days == [
        (20121231, datetime.date(2012, 12, 31), 2013, 12, 31, 1, 1),
        (20130101, datetime.date(2013, 1, 1), 2013, 1, 1, 1, 2),
    ]
    assert len(rows(shop, "SELECT * FROM get_sales_facts()")) == 3
    assert rows(shop, "SELECT last_day_of_month(DATE '2024-02-03')") == [(datetime.date(2024, 2, 29),)]


@pytest.mark.parametrize(
    "call",
    [
        "SELECT inventory_id, inventory_in_stock(inventory_id), inventory_held_by_customer(inventory_id) FROM rental_shop_inventory",
        "SELECT s.* FROM rental_shop_film f, LATERAL film_in_stock(f.film_id, 1) s",
        "SELECT * FROM customer_balances(TIMESTAMP_NTZ '2020-01-31')",
        "SELECT * FROM rewards_report(1, 10, DATE '2020-04-15')",
    ],
)
def test_calls_plan_as_equality_joins(shop, call):
    plan = shop.sql(call)._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan
