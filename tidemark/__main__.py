"""Command line: ``run`` a monitoring run, ``report`` on the latest one."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tidemark.operators import alerts
from tidemark.params import Params
from tidemark.plans.history import latest_run, of_latest_run
from tidemark.plans.report import health_score, run_summary
from tidemark.plans.run import Extensions, Stores, run
from tidemark.sources.files import read_queries


def main() -> None:
    parser = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    runner = commands.add_parser("run")
    runner.add_argument("--settings", help="YAML file with thresholds and folders")
    runner.add_argument("--queries", help="file with one query per line")
    runner.add_argument("--store", required=True)
    runner.add_argument("directories", nargs="*")
    reporter = commands.add_parser("report")
    reporter.add_argument("--store", required=True)
    given = parser.parse_args()

    spark = (
        SparkSession.builder.appName("tidemark")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    stores = Stores(spark, given.store)
    if given.command == "run":
        params = Params.from_yaml(given.settings) if given.settings else Params()
        run(
            spark,
            given.directories or params.directories,
            stores,
            queries=read_queries(spark, given.queries) if given.queries else None,
            params=params,
            extensions=Extensions(handlers=[alerts.console]),
        )
    tables = stores.history.table
    runs = tables("runs")
    children = [
        of_latest_run(tables(name), runs)
        for name in (
            "drift_results", "risks", "quality_checks", "rag_metrics", "alerts",
        )
    ]
    summary = run_summary(latest_run(runs), *children)
    summary.show(vertical=True, truncate=False)
    health_score(summary).show()
    for rows in children:
        rows.show(20, truncate=100)


if __name__ == "__main__":
    main()
