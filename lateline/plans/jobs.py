"""The batch jobs: ingest, privacy, clean, gold and training.

Each job reads a written table, writes its own, and returns a report. Counts in a report are
taken from what was written, with reads of no or few columns, or on the way of a write of one stage:
they are exact also when tasks had to run again, and cost no second run of the job.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lateline.ml import evaluation
from lateline.ml.scoring import preparation_of, save_model
from lateline.ml.split import FEATURES, SEED, TEST_SHARE, class_distribution, exact_split, hash_split, labelled
from lateline.ml.train import (
    DEFAULT_ESTIMATORS,
    Estimators,
    Evaluation,
    Training,
    feature_importance,
    train_and_compare,
)
from lateline.operators.cleaning import drop_personal
from lateline.operators.quality import null_counts
from lateline.plans.clean import clean_orders
from lateline.plans.gold import TABLES, gold_groups, gold_table_from_groups
from lateline.schema import FEATURE_COLUMNS, LEAKAGE_COLUMNS, SALES_QUANTILE_ERROR, TARGET
from lateline.sources.catalog import check_schema
from lateline.sources.files import (
    detect_encoding,
    find_csv,
    land,
    named_file,
    read_order_csv,
    read_table,
    write_counted,
    write_table,
)
from lateline.sources.staging import discard, noted, stage

REPORT_SCHEMA = (
    "job string, status string, input_path string, output_path string, rows_before bigint, rows_after bigint, "
    "column_count_before int, column_count_after int, details string, started_at timestamp, "
    "duration_seconds double"
)
BYTES_PER_MB = 1024 * 1024


class Report:
    """Collects one report row; times run from its creation."""

    def __init__(self, job: str, input_path: str, output_path: str):
        self.started = datetime.now(timezone.utc)
        self.values = {"job": job, "status": "success", "input_path": input_path, "output_path": output_path}
        self.details: dict = {}

    def sizes(self, before: DataFrame, after: DataFrame) -> None:
        self.values |= {
            "rows_before": before.count(),
            "rows_after": after.count(),
            "column_count_before": len(before.columns),
            "column_count_after": len(after.columns),
        }

    def finish(self, spark: SparkSession, report_path: str | None) -> dict:
        seconds = (datetime.now(timezone.utc) - self.started).total_seconds()
        self.values |= {"started_at": self.started, "duration_seconds": round(seconds, 2)}
        if report_path:
            row = {**self.values, "details": json.dumps(self.details, ensure_ascii=False)}
            names = [field.split()[0] for field in REPORT_SCHEMA.split(", ")]
            table = spark.createDataFrame([tuple(row.get(name) for name in names)], REPORT_SCHEMA)
            table.coalesce(1).write.mode("append").parquet(report_path)
        return {**self.values, **self.details}


def ingest_job(
    spark: SparkSession,
    folder: str,
    landing_path: str,
    file: str | None = None,
    report_path: str | None = None,
    by_content: bool = False,
) -> dict:
    """Find the raw file (or take the named one), profile it and land it unchanged, checked by rows or by content."""
    found = named_file(spark, file) if file else find_csv(spark, folder)
    report = Report("ingest", found.path, landing_path)
    encoding = detect_encoding(spark, found.path)
    raw = read_order_csv(spark, found.path, encoding=encoding)
    rows = land(raw, landing_path, by_content)
    report.values |= {
        "rows_before": rows,
        "rows_after": rows,
        "column_count_before": len(raw.columns),
        "column_count_after": len(raw.columns),
    }
    report.details = {
        "file_size_mb": round(found.size_bytes / BYTES_PER_MB, 2),
        "encoding": encoding,
        "columns": raw.columns,
    }
    return report.finish(spark, report_path)


def privacy_job(spark: SparkSession, landing_path: str, output_path: str, report_path: str | None = None) -> dict:
    """Remove the personal columns."""
    report = Report("privacy", landing_path, output_path)
    raw = read_table(spark, landing_path)
    result = drop_personal(raw)
    rows = write_counted(result.table, output_path)  # no row is dropped
    report.values |= {
        "rows_before": rows,
        "rows_after": read_table(spark, output_path).count(),
        "column_count_before": len(raw.columns),
        "column_count_after": len(result.table.columns),
    }
    report.details = {
        "dropped_columns": result.dropped,
        "missing_privacy_columns": result.missing,
        "remaining_columns": result.table.columns,
    }
    return report.finish(spark, report_path)


def clean_job(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    relative_error: float = SALES_QUANTILE_ERROR,
    files: int | None = None,
    report_path: str | None = None,
    rare_duplicates: bool = False,
) -> dict:
    """Clean, deduplicate and extend the order lines."""
    report = Report("clean", input_path, output_path)
    raw = read_table(spark, input_path)
    with noted() as staged:
        result = clean_orders(raw, relative_error, rare_duplicates=rare_duplicates)
    write_table(result.table, output_path, files)
    discard(spark, staged)
    clean = read_table(spark, output_path)
    report.sizes(raw, clean)
    nulls = {row["column_name"]: row["null_count"] for row in null_counts(clean).collect()}  # at most nine rows
    report.details = {
        "duplicates_removed": report.values["rows_before"] - report.values["rows_after"],
        "column_mapping": result.mapping,
        "created_features": [name for name in FEATURE_COLUMNS if name in clean.columns],
        "low_sales_threshold": result.low_sales,
        "high_sales_threshold": result.high_sales,
        "null_summary": nulls,
    }
    return report.finish(spark, report_path)


def gold_job(
    spark: SparkSession,
    clean_path: str,
    gold_path: str,
    sum_type: str = "double",
    partitions: int | None = None,
    publish: Callable[[DataFrame, str], None] | None = None,
    report_path: str | None = None,
) -> dict:
    """All gold tables from one pass over the clean table; ``partitions`` as in ``roll_up_sets``.

    ``publish(table, name)`` gets every written table, for a relational sink or a catalog.
    """
    report = Report("gold", clean_path, gold_path)
    clean = read_table(spark, clean_path)
    groups = stage(gold_groups(clean, sum_type, partitions), "gold-groups")
    row_counts = {}
    for name in TABLES:
        table = gold_table_from_groups(groups, name)
        check_schema(table, name)
        path = write_table(table, f"{gold_path}/{name}", files=1)
        written = read_table(spark, path)
        row_counts[name] = written.count()
        if publish is not None:
            publish(written, name)
    report.values |= {"rows_before": clean.count(), "rows_after": sum(row_counts.values())}
    report.details = {"row_counts": row_counts}
    return report.finish(spark, report_path)


def training_job(
    spark: SparkSession,
    clean_path: str,
    model_path: str,
    estimators: Estimators = DEFAULT_ESTIMATORS,
    exact: bool = True,
    share: float = TEST_SHARE,
    seed: int = SEED,
    report_path: str | None = None,
) -> Training:
    """Split, fit, compare, and store the best model with its figures as tables."""
    report = Report("training", clean_path, model_path)
    clean = read_table(spark, clean_path)
    data = stage(labelled(clean, seed=seed), "model-data")
    train, test = (exact_split if exact else hash_split)(data, share)
    training = train_and_compare(train, test, estimators)
    best = training.models[training.best]
    save_model(best, f"{model_path}/model")
    save_model(preparation_of(best), f"{model_path}/preparation")

    def of_all_models(figure: Callable[[Evaluation], DataFrame]) -> DataFrame:
        tables = [figure(e).select(F.lit(name).alias("model"), "*") for name, e in training.evaluations.items()]
        return reduce(DataFrame.unionByName, tables)

    small = {
        "model_metrics": evaluation.model_comparison(spark, training.metrics),
        "classification_report": of_all_models(lambda e: evaluation.classification_report(e.scored)),
        "confusion_matrix": of_all_models(lambda e: evaluation.confusion_matrix(e.scored)),
        "feature_importance": feature_importance(spark, best, training.names),
        "class_distribution": class_distribution(data),
    }
    for name, table in small.items():
        write_table(table, f"{model_path}/{name}", files=1)
    write_table(of_all_models(lambda e: evaluation.roc_curve(e.groups)), f"{model_path}/roc_curve")
    cells = evaluation.confusion_matrix(training.evaluations[training.best].scored).collect()  # four rows
    rows, test_rows = data.count(), sum(cell["rows"] for cell in cells)
    report.values |= {"rows_before": rows, "rows_after": test_rows}
    report.details = {
        "target": TARGET,
        "features": FEATURES,
        "excluded_leakage_columns": [name for name in LEAKAGE_COLUMNS if name in clean.columns],
        "train_rows": rows - test_rows,
        "test_rows": test_rows,
        "test_share": share,
        "seed": seed,
        "best_model": training.best,
        "metrics_by_model": training.metrics,
        "confusion_matrix": [cell.asDict() for cell in cells],
    }
    report.finish(spark, report_path)
    return training
