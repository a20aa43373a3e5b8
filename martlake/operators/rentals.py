"""Stock, balance and reward operators over whole tables; single ids are filters on top."""

from __future__ import annotations

import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlake.functions.calendar import month_bounds, whole_days
from martlake.operators.lookup import anti_join, semi_join

MONEY = "decimal(18,2)"


def open_rentals(rental: DataFrame) -> DataFrame:
    return rental.filter(F.col("return_date").isNull())


def items_out(rental: DataFrame) -> DataFrame:
    """Items on rent, once for each open rental."""
    return open_rentals(rental).select("inventory_id")


def stock(inventory: DataFrame, rental: DataFrame) -> DataFrame:
    """Every item with a flag: in stock unless some rental of it is still open."""
    return items_in_stock(inventory.select("inventory_id", "film_id", "store_id"), rental)


def items_in_stock(items: DataFrame, rental: DataFrame) -> DataFrame:
    """The flag for any set of ids; an id never rented, or unknown, is in stock.

    A join that adds a flag would need each item once on its right side; those in and those out of stock are
    two joins that can split a hot item.
    """
    out = items_out(rental)
    here = anti_join(items, out, ["inventory_id"]).withColumn("in_stock", F.lit(True))
    return here.unionByName(semi_join(items, out, ["inventory_id"]).withColumn("in_stock", F.lit(False)))


def film_in_stock(inventory: DataFrame, rental: DataFrame, film_id=None, store_id=None) -> DataFrame:
    """Items on the shelf, for one film and store or for all."""
    return anti_join(_shelf(inventory, film_id, store_id), items_out(rental), ["inventory_id"])


def film_not_in_stock(inventory: DataFrame, rental: DataFrame, film_id=None, store_id=None) -> DataFrame:
    """Items out on rent, for one film and store or for all."""
    return semi_join(_shelf(inventory, film_id, store_id), items_out(rental), ["inventory_id"])


def _shelf(inventory: DataFrame, film_id, store_id) -> DataFrame:
    items = inventory.select("inventory_id", "film_id", "store_id")
    if film_id is not None:
        items = items.filter(F.col("film_id") == film_id)
    if store_id is not None:
        items = items.filter(F.col("store_id") == store_id)
    return items


def held_by(rental: DataFrame) -> DataFrame:
    """Customer holding each item that is out; with several open rentals, the lowest id."""
    return open_rentals(rental).groupBy("inventory_id").agg(F.min("customer_id").alias("customer_id"))


def customer_balance(
    customer: DataFrame, rental: DataFrame, inventory: DataFrame, film: DataFrame,
    payment: DataFrame, as_of, charge_replacement: bool = False,
) -> DataFrame:
    """Rental fees plus one dollar per whole day overdue, less payments, up to ``as_of``.

    Rentals and payments are summed apart and meet per customer. An open rental is not overdue.
    ``charge_replacement`` adds the replacement cost of rentals kept past twice their duration.
    """
    terms = inventory.select("inventory_id", "film_id").join(
        film.select("film_id", "rental_rate", "rental_duration", "replacement_cost"), "film_id"
    )
    kept = whole_days(F.col("rental_date"), F.col("return_date"))
    overdue = F.coalesce(F.greatest(kept - F.col("rental_duration"), F.lit(0)), F.lit(0))
    fee = F.col("rental_rate") + overdue
    if charge_replacement:
        lost = F.coalesce(kept > 2 * F.col("rental_duration"), F.lit(False))
        fee = fee + F.when(lost, F.col("replacement_cost")).otherwise(F.lit(0))
    charged = (
        rental.filter(F.col("rental_date") <= F.lit(as_of))
        .select("inventory_id", "customer_id", "rental_date", "return_date")
        .join(terms, "inventory_id")
        .groupBy("customer_id")
        .agg(F.sum(fee).alias("_charged"))
    )
    paid = (
        payment.filter(F.col("payment_date") <= F.lit(as_of))
        .groupBy("customer_id")
        .agg(F.sum("amount").alias("_paid"))
    )
    balance = F.coalesce(F.col("_charged"), F.lit(0)) - F.coalesce(F.col("_paid"), F.lit(0))
    return (
        customer.select("customer_id")
        .join(charged, "customer_id", "left")
        .join(paid, "customer_id", "left")
        .select("customer_id", balance.cast(MONEY).alias("balance"))
    )


def rewards_report(
    payment: DataFrame, customer: DataFrame, min_purchases: int, min_amount, as_of=None
) -> DataFrame:
    """Whole customer rows of those above both limits in the month three months before ``as_of``."""
    if not isinstance(min_purchases, int) or min_purchases == 0:
        raise ValueError("minimum monthly purchases must be a number other than 0")
    if min_amount is None or Decimal(str(min_amount)) == 0:
        raise ValueError("minimum monthly amount must be a number other than 0")
    first, after = month_bounds(_day(as_of), 3)
    moment = F.col("payment_date")
    earned = (
        payment.filter((moment >= first) & (moment < after))
        .groupBy("customer_id")
        .agg(F.sum("amount").alias("_amount"), F.count("customer_id").alias("_purchases"))
        .filter((F.col("_amount") > F.lit(Decimal(str(min_amount)))) & (F.col("_purchases") > min_purchases))
    )
    return customer.join(earned, "customer_id", "left_semi")


def _day(as_of) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, str):
        as_of = datetime.date.fromisoformat(as_of)
    return F.lit(as_of)
