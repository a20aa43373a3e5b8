import datetime
from decimal import Decimal as D

import pytest

from martlake.operators import rentals


def ts(text):
    return datetime.datetime.fromisoformat(text)


@pytest.fixture(scope="module")
def shop(spark):
    inventory = spark.createDataFrame([(i, 1 + i // 10, 1) for i in (1, 2, 3, 4, 11)], "inventory_id INT, film_id INT, store_id INT")
    rental = spark.createDataFrame(
        [
            # item 1 never rented; 2 returned; 3 open; 4 open twice; 11 rented late
            (1, 2, 7, ts("2020-01-01T12:00:00"), ts("2020-01-04T12:00:00")),  # back exactly on time
            (2, 2, 7, ts("2020-02-01T12:00:00"), ts("2020-02-04T13:00:00")),  # one hour late
            (3, 2, 8, ts("2020-02-01T12:00:00"), ts("2020-02-07T00:00:00")),  # 2.5 days late
            (4, 3, 8, ts("2020-03-01T12:00:00"), None),
            (5, 4, 9, ts("2020-03-01T12:00:00"), None),
            (6, 4, 8, ts("2020-03-02T12:00:00"), None),
            (7, 11, 7, ts("2020-09-01T12:00:00"), ts("2020-12-01T12:00:00")),  # after the cut-off
            (8, 2, 10, ts("2020-01-01T12:00:00"), ts("2020-01-08T12:00:00")),  # kept past twice the duration
        ],
        "rental_id INT, inventory_id INT, customer_id INT, rental_date TIMESTAMP, return_date TIMESTAMP",
    )
    film = spark.createDataFrame(
        [(1, D("2.00"), 3, D("20.00")), (2, D("5.00"), 3, D("20.00"))],
        "film_id INT, rental_rate DECIMAL(4,2), rental_duration INT, replacement_cost DECIMAL(5,2)",
    )
    payment = spark.createDataFrame(
        [(7, D("1.50"), ts("2020-02-10T00:00:00")), (7, D("9.00"), ts("2020-06-30T12:00:01")), (8, D("4.00"), ts("2020-06-30T12:00:00"))],
        "customer_id INT, amount DECIMAL(5,2), payment_date TIMESTAMP",
    )
    customer = spark.createDataFrame([(7, "a"), (8, "b"), (9, "c"), (10, "d"), (11, "e")], "customer_id INT, first_name STRING")
    return inventory, rental, film, payment, customer


def test_stock(shop):
    inventory, rental, *_ = shop
    found = {r.inventory_id: r.in_stock for r in rentals.stock(inventory, rental).collect()}
    assert found == {1: True, 2: True, 3: False, 4: False, 11: True}


def test_in_and_out_make_all(shop):
    inventory, rental, *_ = shop
    inside = {r.inventory_id for r in rentals.film_in_stock(inventory, rental, 1, 1).collect()}
    outside = {r.inventory_id for r in rentals.film_not_in_stock(inventory, rental, 1, 1).collect()}
    assert (inside, outside) == ({1, 2}, {3, 4})
    assert rentals.film_in_stock(inventory, rental).count() + rentals.film_not_in_stock(inventory, rental).count() == 5
    assert rentals.film_in_stock(inventory, rental, 1, 2).count() == 0


def test_unknown_item_is_in_stock(spark, shop):
    ids = spark.createDataFrame([(3,), (777,)], "inventory_id INT")
    assert {tuple(r) for r in rentals.items_in_stock(ids, shop[1]).collect()} == {(3, False), (777, True)}


def test_held_by(shop):
    assert {tuple(r) for r in rentals.held_by(shop[1]).collect()} == {(3, 8), (4, 8)}


@pytest.mark.parametrize(
    "charge, expected",
    [
        # 7: two rentals at 2, nothing overdue for a whole day, less 1.50
        # 8: three rentals at 2, two whole days overdue, less 4; open ones add nothing
        # 10: one rental at 2, four days overdue, kept 7 > 6 days; 11: neither rentals nor payments
        (False, {7: D("2.50"), 8: D("4.00"), 9: D("2.00"), 10: D("6.00"), 11: D("0.00")}),
        (True, {7: D("2.50"), 8: D("4.00"), 9: D("2.00"), 10: D("26.00"), 11: D("0.00")}),
    ],
)
def test_customer_balance(shop, charge, expected):
    inventory, rental, film, payment, customer = shop
    as_of = ts("2020-06-30T12:00:00")
    found = rentals.customer_balance(customer, rental, inventory, film, payment, as_of, charge_replacement=charge)
    assert {r.customer_id: r.balance for r in found.collect()} == expected


def rewards_payments(spark):
    rows = [
        (1, D("60.00"), ts("2020-02-01T00:00:00")), (1, D("60.00"), ts("2020-02-29T23:59:59")),
        (2, D("50.00"), ts("2020-02-10T00:00:00")), (2, D("50.00"), ts("2020-02-11T00:00:00")),  # exactly 100
        (3, D("500.00"), ts("2020-02-10T00:00:00")),  # exactly one purchase
        (4, D("60.00"), ts("2020-01-31T23:59:59")), (4, D("60.00"), ts("2020-03-01T00:00:00")),  # other months
    ]
    return spark.createDataFrame(rows, "customer_id INT, amount DECIMAL(5,2), payment_date TIMESTAMP")


def test_rewards_report(spark):
    customer = spark.createDataFrame([(i, f"c{i}") for i in range(1, 6)], "customer_id INT, first_name STRING")
    for as_of in ("2020-05-31", "2020-05-01"):  # three months before 31 May is 29 February
        report = rentals.rewards_report(rewards_payments(spark), customer, 1, 100, as_of=as_of)
        assert [tuple(r) for r in report.collect()] == [(1, "c1")]


@pytest.mark.parametrize("purchases, amount", [(0, 5), (None, 5), (1, 0), (1, "0.00"), (1, None)])
def test_rewards_limits_must_not_be_zero(spark, purchases, amount):
    with pytest.raises(ValueError):
        rentals.rewards_report(None, None, purchases, amount)
