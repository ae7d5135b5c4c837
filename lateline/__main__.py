"""The jobs from the command line, for ``spark-submit`` or ``python -m lateline``.

The session, its cluster and its settings are the caller's; each job prints its report as JSON.
"""

from __future__ import annotations

import argparse
import json
import os

from pyspark.sql import SparkSession

from lateline.plans import jobs
from lateline.schema import SALES_QUANTILE_ERROR
from lateline.sources.relational import publisher


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="lateline", description=__doc__)
    commands = parser.add_subparsers(dest="job", required=True)

    def job(name: str, text: str, source: str, target: str) -> argparse.ArgumentParser:
        command = commands.add_parser(name, help=text)
        command.add_argument("source", help=source)
        command.add_argument("target", help=target)
        command.add_argument("--reports", help="table of job reports to append to")
        return command

    ingest = job("ingest", "land the raw file", "folder with one CSV file", "landed table")
    ingest.add_argument("--file", help="the CSV file itself, or a folder or pattern of part files")
    ingest.add_argument("--by-content", action="store_true", help="compare the values of the stored rows too, not only their number")
    job("privacy", "remove the personal columns", "landed table", "privacy-safe table")
    clean = job("clean", "clean and extend the order lines", "privacy-safe table", "clean table")
    clean.add_argument("--relative-error", type=float, default=SALES_QUANTILE_ERROR, help="0 for exact thresholds")
    clean.add_argument("--rare-duplicates", action="store_true", help="few rows are repeated: shuffle row hashes first")
    gold = job("gold", "build the gold tables", "clean table", "folder of gold tables")
    gold.add_argument("--sum-type", default="double", help="type sums are taken in")
    gold.add_argument("--partitions", type=int, help="partitions of the order totals; by default Spark decides")
    gold.add_argument("--jdbc-url", help="database to publish to; user and password come from DB_USER, DB_PASSWORD")
    gold.add_argument("--jdbc-schema", default="dashboard")
    train = job("train", "fit and compare the classifiers", "clean table", "folder for model and figures")
    train.add_argument("--hash-split", action="store_true", help="split by hash threshold, with no pass over the data")
    return parser


def main(argv: list[str] | None = None) -> None:
    given = arguments().parse_args(argv)
    spark = SparkSession.builder.appName(f"lateline-{given.job}").getOrCreate()
    log = {"report_path": given.reports}
    if given.job == "ingest":
        report = jobs.ingest_job(spark, given.source, given.target, given.file, by_content=given.by_content, **log)
    elif given.job == "privacy":
        report = jobs.privacy_job(spark, given.source, given.target, **log)
    elif given.job == "clean":
        rare = {"rare_duplicates": given.rare_duplicates}
        report = jobs.clean_job(spark, given.source, given.target, given.relative_error, **rare, **log)
    elif given.job == "gold":
        publish = None
        if given.jdbc_url:
            login = {"user": os.environ["DB_USER"], "password": os.environ["DB_PASSWORD"]}
            publish = publisher(given.jdbc_url, given.jdbc_schema, login)
        report = jobs.gold_job(spark, given.source, given.target, given.sum_type, given.partitions, publish, **log)
    else:
        training = jobs.training_job(spark, given.source, given.target, exact=not given.hash_split, **log)
        report = {"job": "training", "best_model": training.best, "metrics_by_model": training.metrics}
    print(json.dumps(report, ensure_ascii=False, default=str))


if __name__ == "__main__":
    main()
