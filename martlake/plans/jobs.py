"""The jobs: in-database load, extract, warehouse load, first load, weather clean-up.

Every job raises on failure, so a scheduler sees it and can try again under the same run id.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake import schemas
from martlake.operators.quality import check_length, check_null, check_unique
from martlake.operators.upsert import delete_insert, insert_absent, upsert_update
from martlake.operators.weather import clean_days, latest_per_day, normalise_days
from martlake.plans import snapshots, star
from martlake.session import TABLES, build_session, configure
from martlake.sources.extract import export_extract, read_extract
from martlake.sources.landing import accepted, read_landing, rejected, write_clean
from martlake.sources.publish import publish, published_folders, read_folders
from martlake.sources.tables import MONTH, table_folder, write_fact_months
from martlake.streaming.intake import DAY_KEYS

Tables = dict[str, DataFrame]

# extract name, table of the star it feeds, sort of its rows
EXTRACTS = [
    ("customers", "customer_dim", ["customer_id"]),
    ("films", "film_dim", ["film_id"]),
    ("staff", "staff_dim", ["staff_id"]),
    ("dates", "date_dim", ["date_id"]),
    ("sales_facts", "sales_facts", ["date_id", "film_id"]),
]


def build_star(spark: SparkSession, oltp: Tables, start: str = "2010-01-01", days: int = 5000) -> Tables:
    """All five tables of the star, straight from the rental tables."""
    return {
        "customer_dim": star.build_customer_dim(oltp["customer"]),
        "film_dim": star.build_film_dim(oltp["film"]),
        "staff_dim": star.build_staff_dim(oltp["staff"]),
        "date_dim": star.build_date_dim(spark, start, days),
        "sales_facts": star.build_sales_facts(oltp["payment"], oltp["rental"], oltp["inventory"]),
    }


def elt(
    spark: SparkSession, oltp: Tables, olap: Tables | None = None, start: str = "2010-01-01", days: int = 5000
) -> Tables:
    """New state of the star: dates inserted if absent, dimensions updated, facts built anew."""
    fresh = build_star(spark, oltp, start, days)
    if olap is None:
        return fresh
    merged = {"sales_facts": fresh["sales_facts"]}
    merged["date_dim"] = insert_absent(olap["date_dim"], fresh["date_dim"], schemas.STAR_KEYS["date_dim"])
    for name in ("film_dim", "staff_dim", "customer_dim"):
        merged[name] = upsert_update(olap[name], fresh[name], schemas.STAR_KEYS[name])
    return merged


def export(spark: SparkSession, oltp: Tables, base: str, start: str = "2010-01-01", days: int = 5000) -> dict[str, str]:
    """Write the five extracts and return their folders."""
    tables = build_star(spark, oltp, start, days)
    return {name: export_extract(tables[table], f"{base}/{name}", order) for name, table, order in EXTRACTS}


def read_stage(spark: SparkSession, base: str, layout: dict | None = None, multiline: bool | None = None) -> Tables:
    """The extracts as staging tables, typed like their targets; ``multiline`` as in ``read_extract``."""
    layout = layout or schemas.STAR
    return {table: read_extract(spark, f"{base}/{name}", layout[table], multiline) for name, table, _ in EXTRACTS}


def load_warehouse(stage: Tables, target: Tables) -> Tables:
    """New state of the warehouse: matched rows deleted, all staged rows inserted."""
    return {name: delete_insert(target[name], stage[name], schemas.STAR_KEYS[name]) for name in stage}


def first_load(stage: Tables, target: Tables | None = None) -> Tables:
    """Plain append of every extract."""
    if target is None:
        return stage
    return {name: target[name].unionByName(stage[name]) for name in stage}


def star_checks() -> dict:
    """Keys of the dimensions are filled and unique, texts fit; key columns of the facts are filled."""
    rules = {}
    for name, keys in schemas.STAR_KEYS.items():
        rules[name] = [lambda df, k=keys: check_null(df, k)]
        if name != "sales_facts":
            rules[name].append(lambda df, k=keys: check_unique(df, k))
        if name in schemas.STAR_LENGTHS:
            rules[name].append(lambda df, n=schemas.STAR_LENGTHS[name]: check_length(df, n))
    return rules


def _reports(written: Tables) -> Tables:
    star = {name: df.drop(MONTH) for name, df in written.items()}
    return {name: make(star) for name, make in snapshots.SNAPSHOTS.items()}


def publish_star(
    spark: SparkSession, tables: Tables, base: str, run_id: str, kept: list[str] | None = None, reports: bool = False
) -> None:
    """All five tables, and with ``reports`` the stored reports on them, become visible together, or none.

    ``kept`` are folders of months of facts that stay as they are.
    """
    writers = {"sales_facts": write_fact_months}
    publish(
        spark, tables, base, run_id, star_checks(), writers, {"sales_facts": kept or []}, _reports if reports else None
    )


def published_star(spark: SparkSession, base: str) -> Tables | None:
    found = published_folders(spark, base)
    if not found:
        return None
    return {name: read_folders(spark, base, name, found[name][1]).drop(MONTH) for name in schemas.STAR}


def run_elt(spark: SparkSession, oltp: Tables, base: str, run_id: str, **dates) -> Tables:
    """Load the star from the rental tables and publish it together with the stored reports.

    A run that fails, in a report too, has published nothing and can be run again under its id.
    """
    publish_star(spark, elt(spark, oltp, published_star(spark, base), **dates), base, run_id, reports=True)
    return published_star(spark, base)


def run_warehouse_load(
    spark: SparkSession, extracts: str, base: str, run_id: str, layout: dict | None = None, multiline: bool | None = None
) -> Tables:
    """Load the extracts into the published warehouse, or start it with them.

    Only the months that the staged facts touch are read and written again; the others stay by reference.
    """
    stage = read_stage(spark, extracts, layout, multiline)
    target = published_star(spark, base)
    if target is None:
        publish_star(spark, first_load(stage), base, run_id)
        return published_star(spark, base)
    # one row per month
    months = {r["m"] for r in stage["sales_facts"].select(F.expr("date_id div 100").cast("string").alias("m")).distinct().collect()}
    folders = published_folders(spark, base)["sales_facts"][1]
    touched = [f for f in folders if any(f.endswith(f"/{MONTH}={m}") for m in months)]
    # Facts without a date, or written without months, are not told apart by folder and are loaded again.
    touched += [f for f in folders if f not in touched and not f.rsplit(f"/{MONTH}=", 1)[-1].isdigit()]
    facts = target["sales_facts"].schema
    target["sales_facts"] = (
        read_folders(spark, base, "sales_facts", touched).drop(MONTH) if touched else spark.createDataFrame([], facts)
    )
    kept = [f for f in folders if f not in touched]
    publish_star(spark, load_warehouse(stage, target), base, run_id, kept)
    return published_star(spark, base)


def clean_weather(
    spark: SparkSession, raw: str, out: str, mode: str = "partitions", catalog: bool = False, rejects: str | None = None,
) -> str:
    """Clean the landing zone; the partitions it holds are replaced, so a second run adds nothing.

    Of a day that was delivered several times the newest file counts. ``raw`` is the landing folder, or with
    ``catalog`` the name of a table registered over it. Documents without a day are written to ``rejects``; without
    that folder they stop the job, after all days are written.
    """
    documents = read_landing(spark, table_folder(spark, raw) if catalog else raw)
    days = clean_days(normalise_days(accepted(documents)))
    tie = F.xxhash64(*[F.col(c) for c in schemas.CLEAN_DAY.fieldNames()])
    newest = [F.col("source_time").desc(), F.col("source_file").desc(), tie]
    write_clean(latest_per_day(days, DAY_KEYS, newest).select(*schemas.CLEAN_DAY.fieldNames()), out, mode)
    left = rejected(documents)
    if rejects:
        left.write.mode("overwrite").parquet(rejects)
    elif (row := left.first()) is not None:
        raise ValueError(f"{row['source_file']}: {row['reason']}")
    return out


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="martlake")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in ("elt", "export"):
        job = jobs.add_parser(name)
        job.add_argument("--tables", required=True, help="folder with one Parquet folder per rental table")
        job.add_argument("--start", default="2010-01-01")
        job.add_argument("--days", type=int, default=5000)
        job.add_argument("--base", required=True)
        if name == "elt":
            job.add_argument("--run-id", required=True)
    job = jobs.add_parser("load")
    for name in ("--extracts", "--base", "--run-id"):
        job.add_argument(name, required=True)
    job.add_argument("--single-line", action="store_true", help="no field holds a line break, so files can be split")
    job = jobs.add_parser("weather")
    job.add_argument("--raw", required=True, help="folder, or with --catalog the name of a table")
    job.add_argument("--catalog", action="store_true")
    job.add_argument("--out", required=True)
    job.add_argument("--mode", default="partitions", choices=["partitions", "overwrite", "append"])
    job.add_argument("--rejects", help="folder for documents without a day; without it they stop the job")
    args = parser.parse_args(argv)

    spark = configure(build_session(f"martlake-{args.job}"), TABLES)
    if args.job in ("elt", "export"):
        names = ("customer", "film", "staff", "payment", "rental", "inventory")
        oltp = {name: spark.read.parquet(f"{args.tables}/{name}") for name in names}
        if args.job == "elt":
            run_elt(spark, oltp, args.base, args.run_id, start=args.start, days=args.days)
        else:
            export(spark, oltp, args.base, args.start, args.days)
    elif args.job == "load":
        run_warehouse_load(spark, args.extracts, args.base, args.run_id, multiline=False if args.single_line else None)
    else:
        clean_weather(spark, args.raw, args.out, args.mode, args.catalog, args.rejects)


if __name__ == "__main__":
    main()
