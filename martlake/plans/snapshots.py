"""Stored results of reports, and the listing views by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from martlake.plans import reports
from martlake.sources.publish import read_published, rebuild_swap

Tables = dict[str, DataFrame]


def daily_average_sales(star: Tables) -> DataFrame:
    return reports.star_daily_avg(star["sales_facts"], star["date_dim"])


def weekly_rating_sales(star: Tables) -> DataFrame:
    return reports.star_weekly_cube(star["sales_facts"], star["date_dim"], star["film_dim"])


SNAPSHOTS: dict[str, Callable[[Tables], DataFrame]] = {
    "daily_average_sales": daily_average_sales,
    "weekly_rating_sales": weekly_rating_sales,
}


def refresh(spark: SparkSession, name: str, star: Tables, base: str, run_id: str) -> DataFrame:
    """Compute one stored report again; readers of the old version are not disturbed."""
    return rebuild_swap(spark, name, SNAPSHOTS[name](star), base, run_id)


def refresh_all(spark: SparkSession, star: Tables, base: str, run_id: str) -> Tables:
    """To be run after every rebuild of the facts."""
    return {name: refresh(spark, name, star, base, run_id) for name in SNAPSHOTS}


def snapshot(spark: SparkSession, name: str, base: str) -> DataFrame:
    """The stored result as of its last refresh."""
    return read_published(spark, base, name)


def views(t: Tables) -> Tables:
    """The seven listing and sales views over a set of rental tables."""
    places = (t["address"], t["city"], t["country"])
    films = (t["category"], t["film_category"], t["film"], t["film_actor"], t["actor"])
    return {
        "actor_info": reports.actor_info(t["actor"], t["film_actor"], t["film_category"], t["category"], t["film"]),
        "customer_list": reports.customer_list(t["customer"], *places),
        "film_list": reports.film_list(*films),
        "nicer_but_slower_film_list": reports.film_list(*films, names="joined"),
        "sales_by_film_category": reports.sales_by_category(
            t["payment"], t["rental"], t["inventory"], t["film"], t["film_category"], t["category"]
        ),
        "sales_by_store": reports.sales_by_store(
            t["payment"], t["rental"], t["inventory"], t["store"], *places, t["staff"]
        ),
        "staff_list": reports.staff_list(t["staff"], *places),
    }


def register_views(tables: Tables) -> list[str]:
    """Make the views readable from SQL under their names."""
    made = views(tables)
    for name, df in made.items():
        df.createOrReplaceTempView(name)
    return sorted(made)
