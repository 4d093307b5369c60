"""Command line: ``python -m larder`` followed by a job.

    ingest  raw files to bronze, then the volume gate
    refine  bronze of one date to silver
    report  what a refined date rejected, matched and holds most of
    marts   silver to gold, all marts or some
    export  gold to ordered CSV

Exits with 1 when a source, a gate or a mart fails.  Sessions take their settings from
the environment; only the application name is set here.
"""

from __future__ import annotations

import argparse
import logging
import sys
from datetime import date

from pyspark.sql import SparkSession

from larder.functions.dates import parse_iso_date
from larder.operators.aggregates import class_share
from larder.plans import bronze, gold, silver
from larder.plans.runner import RunReport, run_steps
from larder.schemas import (
    INGEST_SAMPLE_ROWS,
    MART_SCHEMAS,
    MIN_ROWS_COUNTRIES,
    MIN_ROWS_PRODUCTS,
    PRODUCT_SCHEMA,
    REFINE_SAMPLE_ROWS,
    TOP_PER_CATEGORY,
)
from larder.sources.jdbc import Database
from larder.sources.lake import read_dated

log = logging.getLogger("larder")


def parse(arguments: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="larder")
    jobs = parser.add_subparsers(dest="job", required=True)

    ingest = jobs.add_parser("ingest")
    ingest.add_argument("--bronze", required=True, help="bronze root folder")
    ingest.add_argument("--products", help="product file, tab-separated")
    ingest.add_argument("--countries", help="country file, comma-separated")
    ingest.add_argument("--source", choices=["all", "products", "countries"], default="all")
    ingest.add_argument("--product-separator", default="\t")
    ingest.add_argument("--country-separator", default=",")
    ingest.add_argument("--encoding", default="utf-8")
    ingest.add_argument("--min-products", type=int, default=MIN_ROWS_PRODUCTS)
    ingest.add_argument("--min-countries", type=int, default=MIN_ROWS_COUNTRIES)

    refine = jobs.add_parser("refine")
    refine.add_argument("--bronze", required=True)
    refine.add_argument("--silver", required=True, help="silver root folder")
    refine.add_argument("--database", default="silver")

    report = jobs.add_parser("report")
    report.add_argument("--bronze", required=True)
    report.add_argument("--database", default="silver")

    marts = jobs.add_parser("marts")
    marts.add_argument("--database", default="silver")
    marts.add_argument("--gold", required=True, help="gold root folder")
    marts.add_argument("--only", nargs="+", choices=list(MART_SCHEMAS))
    marts.add_argument("--top", type=int, default=TOP_PER_CATEGORY)
    marts.add_argument("--jdbc-url", help="also copy the marts to this database")
    marts.add_argument("--jdbc-driver", default="")
    marts.add_argument("--jdbc-user", default="")
    marts.add_argument("--jdbc-password-file", help="file that holds the password alone")

    export = jobs.add_parser("export")
    export.add_argument("--gold", required=True)
    export.add_argument("--output", required=True)
    export.add_argument("--only", nargs="+", choices=list(MART_SCHEMAS))
    export.add_argument("--single-file", action="store_true", help="one file for each mart")

    for job in (ingest, refine, report):
        job.add_argument("--date", type=parse_iso_date, default=date.today(), help="YYYY-MM-DD")
    for job in (ingest, refine):
        job.add_argument("--sample", action="store_true", help="development run on few rows")
    return parser.parse_args(arguments)


def run(spark: SparkSession, options: argparse.Namespace) -> RunReport:
    if options.job == "ingest":
        return _ingest(spark, options)
    if options.job == "refine":
        report = run_steps(
            {
                "silver": lambda: silver.refine(
                    spark,
                    f"{options.bronze}/products",
                    f"{options.bronze}/countries",
                    options.silver,
                    options.database,
                    options.date,
                    REFINE_SAMPLE_ROWS if options.sample else None,
                )
            }
        )
        if report.ok:
            refined = report.results["silver"]
            report = RunReport({"silver": refined.results}, refined.errors)
        return report
    if options.job == "report":
        enriched = spark.table(f"{options.database}.products_enriched")
        tables = silver.quality_report(
            read_dated(spark, f"{options.bronze}/products", options.date, PRODUCT_SCHEMA), enriched
        )
        tables["products per grade"] = class_share(
            gold.feature_mart(enriched), "nutrition_grade_fr", digits=2
        )
        steps = {name: lambda df=df: [row.asDict() for row in df.collect()] for name, df in tables.items()}
        return run_steps(steps)
    if options.job == "marts":
        enriched = spark.table(f"{options.database}.products_enriched")
        return gold.publish_marts(
            enriched, options.gold, options.only, _database(options), top_n=options.top
        )
    return gold.export_marts(
        spark, options.gold, options.output, options.only, options.single_file
    )


def _database(options: argparse.Namespace) -> Database | None:
    if not options.jdbc_url:
        return None
    password = ""
    if options.jdbc_password_file:
        with open(options.jdbc_password_file, encoding="utf-8") as file:
            password = file.read().strip()
    return Database(options.jdbc_url, options.jdbc_driver, options.jdbc_user, password)


def _ingest(spark: SparkSession, options: argparse.Namespace) -> RunReport:
    chosen = ["products", "countries"] if options.source == "all" else [options.source]
    targets = {name: f"{options.bronze}/{name}" for name in chosen}
    sample = INGEST_SAMPLE_ROWS if options.sample else None
    steps = {
        "products": lambda: bronze.ingest_products(
            spark,
            options.products,
            targets["products"],
            options.date,
            options.product_separator,
            options.encoding,
            sample,
        ),
        "countries": lambda: bronze.ingest_countries(
            spark,
            options.countries,
            targets["countries"],
            options.date,
            options.country_separator,
            options.encoding,
        ),
    }
    report = run_steps(steps, chosen)
    written = {name: targets[name] for name in report.results}
    if written:
        least = {"products": options.min_products, "countries": options.min_countries}
        for verdict in bronze.check_volumes(spark, written, options.date, sample, least).collect():
            if not verdict.ok:
                report.errors[f"volume of {verdict.source}"] = (
                    f"{verdict.rows} rows, at least {verdict.min_rows} wanted"
                )
    return report


def main(arguments: list[str] | None = None) -> int:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    options = parse(sys.argv[1:] if arguments is None else arguments)
    spark = SparkSession.builder.appName(f"larder-{options.job}").getOrCreate()
    report = run(spark, options)
    for name, result in report.results.items():
        log.info("%s: %s", name, result)
    for name, error in report.errors.items():
        log.error("%s: %s", name, error)
    return 0 if report.ok else 1


if __name__ == "__main__":
    sys.exit(main())
