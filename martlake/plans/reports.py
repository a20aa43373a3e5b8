"""The sales reports and the listing views.

Reports come unsorted; ``order_report`` puts the few finished rows in their shown order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlake.functions.calendar import iso_week, iso_weekday
from martlake.functions.text import full_name, group_concat, joined_name
from martlake.operators.sales import TOTAL, film_items, film_sales, grouping_sets, item_payments, store_sales
from martlake.schemas import RATINGS


def rating_rank(rating: Column) -> Column:
    """Position in the declared order of the ratings."""
    return F.when(rating.isNotNull(), F.array_position(F.array(*map(F.lit, RATINGS)), rating))


def order_report(df: DataFrame, keys: list[str]) -> DataFrame:
    """Ascending, NULL last; ratings in their declared order."""
    return df.orderBy(
        *[(rating_rank(F.col(k)) if k == "rating" else F.col(k)).asc_nulls_last() for k in keys]
    )


# --- reports from the rental tables -------------------------------------------------------


def daily_sales(payment: DataFrame, rental: DataFrame, inventory: DataFrame, film: DataFrame) -> DataFrame:
    """Sales per weekday."""
    items = film_items(inventory, film)
    sold = item_payments(payment, rental, items, dow=iso_weekday(F.col("payment_date")))
    return sold.groupBy("dow").agg(F.sum("amount").cast(TOTAL).alias("sales"))


def _weekly_grain(payment, rental, inventory, film, with_year: bool) -> tuple[DataFrame, list[str]]:
    moment = F.col("payment_date")
    parts = {"week": iso_week(moment)}
    if with_year:
        parts = {"year": F.extract(F.lit("YEAROFWEEK"), moment), **parts}
    keys = [*parts, "rating"]
    sold = item_payments(payment, rental, film_items(inventory, film, "rating"), **parts)
    return sold.groupBy(*keys).agg(F.sum("amount").alias("sales")), keys


def weekly_sales_cube(payment, rental, inventory, film, with_year=False, with_gid=False) -> DataFrame:
    """Sales per ISO week and rating with all subtotals. Weeks of all years add up unless ``with_year``."""
    grain, keys = _weekly_grain(payment, rental, inventory, film, with_year)
    return grouping_sets(grain, keys, "cube", with_gid)


def weekly_sales_rollup(payment, rental, inventory, film, with_year=False, with_gid=False) -> DataFrame:
    """Sales per ISO week and rating, per week, and in all."""
    grain, keys = _weekly_grain(payment, rental, inventory, film, with_year)
    return grouping_sets(grain, keys, "rollup", with_gid)


# --- reports from the star ----------------------------------------------------------------


def star_daily_avg(sales_facts: DataFrame, date_dim: DataFrame) -> DataFrame:
    """Average sale per weekday and over all; facts with no date row drop out."""
    per_weekday = (
        sales_facts.select("date_id", "amount")
        .join(date_dim.select("date_id", "day_of_week"), "date_id")
        .groupBy("day_of_week")
        .agg(F.sum("amount").alias("_sum"), F.count("amount").alias("_n"))
    )
    total = F.sum("_sum").cast("double") / F.nullif(F.sum("_n"), F.lit(0)).cast("double")
    return per_weekday.cube("day_of_week").agg(total.alias("sales"))


def star_weekly_cube(
    sales_facts: DataFrame, date_dim: DataFrame, film_dim: DataFrame, with_gid: bool = False
) -> DataFrame:
    """Sales per ISO week and rating with all subtotals, from the star."""
    grain = (
        sales_facts.select("date_id", "film_id", "amount")
        .join(date_dim.select("date_id", "week_of_year"), "date_id")
        .join(film_dim.select("film_id", "rating"), "film_id")
        .groupBy("week_of_year", "rating")
        .agg(F.sum("amount").alias("sales"))
    )
    return grouping_sets(grain, ["week_of_year", "rating"], "cube", with_gid)


# --- views --------------------------------------------------------------------------------


def actor_info(
    actor: DataFrame, film_actor: DataFrame, film_category: DataFrame, category: DataFrame, film: DataFrame
) -> DataFrame:
    """Per actor the films in each category as one text; NULL for an actor without any."""
    listed = film_actor.select("actor_id", "film_id").join(
        film_category.select("film_id", "category_id"), "film_id"
    )
    titled = listed.join(film.select("film_id", "title"), "film_id")
    titles = group_concat(titled, ["actor_id", "category_id"], "title", "film_id", "titles")
    lines = (
        titles.join(category.select("category_id", "name"), "category_id")
        .select("actor_id", "category_id", F.concat("name", F.lit(": "), "titles").alias("line"))
        .groupBy("actor_id", "line")
        .agg(F.min("category_id").alias("category_id"))
    )
    info = group_concat(lines, ["actor_id"], "line", "category_id", "film_info")
    return actor.select("actor_id", "first_name", "last_name").join(info, "actor_id", "left")


def film_list(
    category: DataFrame, film_category: DataFrame, film: DataFrame, film_actor: DataFrame,
    actor: DataFrame, names: str = "plain",
) -> DataFrame:
    """One row per film and category name, with its cast as one text.

    ``names='joined'`` writes each name as one word with capitals only at the two starts.
    The cast is put together once per film, before the film's own columns join in.
    """
    shown = {"plain": full_name, "joined": joined_name}[names]()
    people = actor.select("actor_id", shown.alias("_name"))
    cast = group_concat(
        film_actor.select("film_id", "actor_id").join(people, "actor_id"),
        ["film_id"], "_name", "actor_id", "_cast",
    )
    # categories that share a name fall into one row, which then lists the cast once for each
    labels = (
        film_category.select("film_id", "category_id")
        .join(category.select("category_id", "name"), "category_id")
        .groupBy("film_id", "name")
        .agg(F.count(F.lit(1)).cast("int").alias("_times"))
    )
    return (
        film.select("film_id", "title", "description", "rental_rate", "length", "rating")
        .join(cast, "film_id")
        .join(labels, "film_id")
        .select(
            F.col("film_id").alias("fid"),
            "title",
            "description",
            F.col("name").alias("category"),
            F.col("rental_rate").alias("price"),
            "length",
            "rating",
            F.when(F.col("_times") == 1, F.col("_cast"))
            .otherwise(F.array_join(F.array_repeat("_cast", F.col("_times")), ", "))
            .alias("actors"),
        )
    )


def _with_place(people: DataFrame, address: DataFrame, city: DataFrame, country: DataFrame) -> DataFrame:
    place = city.select("city_id", "city", "country_id").join(country.select("country_id", "country"), "country_id")
    home = address.select("address_id", "address", F.col("postal_code").alias("zip code"), "phone", "city_id")
    return people.join(home, "address_id").join(place, "city_id")


def customer_list(customer: DataFrame, address: DataFrame, city: DataFrame, country: DataFrame) -> DataFrame:
    people = customer.select("customer_id", "first_name", "last_name", "address_id", "activebool", "store_id")
    return _with_place(people, address, city, country).select(
        F.col("customer_id").alias("id"), full_name().alias("name"), "address", "zip code", "phone",
        "city", "country",
        F.when(F.col("activebool"), F.lit("active")).otherwise(F.lit("")).alias("notes"),
        F.col("store_id").alias("sid"),
    )


def staff_list(staff: DataFrame, address: DataFrame, city: DataFrame, country: DataFrame) -> DataFrame:
    people = staff.select("staff_id", "first_name", "last_name", "address_id", "store_id")
    return _with_place(people, address, city, country).select(
        F.col("staff_id").alias("id"), full_name().alias("name"), "address", "zip code", "phone",
        "city", "country", F.col("store_id").alias("sid"),
    )


def sales_by_category(
    payment: DataFrame, rental: DataFrame, inventory: DataFrame, film: DataFrame,
    film_category: DataFrame, category: DataFrame,
) -> DataFrame:
    """Sales per category name, highest first. A film counts in each of its categories."""
    sold = film_sales(payment, rental, inventory, film)
    return (
        sold.join(film_category.select("film_id", "category_id"), "film_id")
        .groupBy("category_id")
        .agg(F.sum("sales").alias("sales"))
        .join(category.select("category_id", "name"), "category_id")
        .groupBy(F.col("name").alias("category"))
        .agg(F.sum("sales").cast(TOTAL).alias("total_sales"))
        .orderBy(F.col("total_sales").desc_nulls_first())
    )


def sales_by_store(
    payment: DataFrame, rental: DataFrame, inventory: DataFrame, store: DataFrame, address: DataFrame,
    city: DataFrame, country: DataFrame, staff: DataFrame,
) -> DataFrame:
    """Sales per store with its place and manager, by country and city."""
    sold = store_sales(payment, rental, inventory)
    manager = staff.select(F.col("staff_id").alias("manager_staff_id"), "first_name", "last_name")
    stores = (
        store.select("store_id", "manager_staff_id", "address_id")
        .join(manager, "manager_staff_id")
        .join(address.select("address_id", "city_id"), "address_id")
        .join(city.select("city_id", "city", "country_id"), "city_id")
        .join(country.select("country_id", "country"), "country_id")
    )
    return (
        sold.join(stores, "store_id")
        .groupBy("country", "city", "store_id", "first_name", "last_name")
        .agg(F.sum("sales").cast(TOTAL).alias("total_sales"))
        .orderBy(F.col("country").asc_nulls_last(), F.col("city").asc_nulls_last())
        .select(
            F.concat("city", F.lit(","), "country").alias("store"),
            full_name().alias("manager"),
            "total_sales",
        )
    )
