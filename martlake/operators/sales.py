"""Sales totals over the rental tables.

What a report wants to know of an item is first looked up on the inventory, which is smaller than
the rentals, so that payments are shuffled by rental and by item only, and by item only where the
items are too many to be broadcast. Totals are summed to the grain of the report before any
grouping sets or many-to-many table come in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOTAL = "decimal(38,2)"


def item_payments(payment: DataFrame, rental: DataFrame, items: DataFrame, **parts: Column) -> DataFrame:
    """Each payment's amount and date parts next to the columns of its item."""
    paid = payment.select("rental_id", "amount", *[c.alias(n) for n, c in parts.items()])
    return (
        paid.join(rental.select("rental_id", "inventory_id"), "rental_id")
        .select("inventory_id", "amount", *parts)
        .join(items, "inventory_id")
    )


def film_items(inventory: DataFrame, film: DataFrame, *columns: str) -> DataFrame:
    """Items with columns of their film; items of an unknown film drop out."""
    return inventory.select("inventory_id", "film_id").join(film.select("film_id", *columns), "film_id")


def film_sales(payment: DataFrame, rental: DataFrame, inventory: DataFrame, film: DataFrame) -> DataFrame:
    """Payment total per film."""
    sold = item_payments(payment, rental, film_items(inventory, film))
    return sold.groupBy("film_id").agg(F.sum("amount").alias("sales"))


def store_sales(payment: DataFrame, rental: DataFrame, inventory: DataFrame) -> DataFrame:
    """Payment total per store."""
    sold = item_payments(payment, rental, inventory.select("inventory_id", "store_id"))
    return sold.groupBy("store_id").agg(F.sum("amount").alias("sales"))


def grouping_sets(grain: DataFrame, keys: list[str], kind: str, with_gid: bool = False) -> DataFrame:
    """CUBE or ROLLUP over rows already summed to the finest grain.

    ``gid`` tells a subtotal from a group whose key is NULL in the data.
    """
    summed = F.sum("sales").cast(TOTAL).alias("sales")
    grouped = getattr(grain, kind)(*keys)
    if with_gid:
        return grouped.agg(summed, F.grouping_id().cast("int").alias("gid"))
    return grouped.agg(summed)
