"""Every operator as a query over the given tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from functools import cache, reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fixtures.orders_wide import clean_lines, order_lines, read
from fixtures.raw_orders import raw_orders, raw_orders_twice, twice_delivered
from lateline.ml import evaluation, forest, prepare
from lateline.ml import split as S
from lateline.ml import train as M
from lateline.ml.scoring import advise, load_model, save_model, score
from lateline.operators import cleaning, features, quality
from lateline.plans import gold, jobs, views
from lateline.plans.clean import clean_orders, sales_thresholds
from lateline.schema import NULL_CHECKED_COLUMNS, NUMERIC_FEATURES, RAW_ENCODING, TARGET
from lateline.sources import catalog, files
from lateline.sources.files import read_table, write_table
from lateline.sources.staging import discard, shared_folder, stage

# Sums of values with at most four decimals are compared exactly. Means of margins are compared
# after rounding: their last digits depend on the order of addition in either engine.
MONEY = "decimal(18,4)"
ROUNDED = {"average_profit_margin": 4}


def rounded(table: DataFrame, places: dict[str, int] = ROUNDED) -> DataFrame:
    return table.withColumns({c: F.round(c, n) for c, n in places.items() if c in table.columns})


def _gold(name: str):
    return lambda spark, sf: rounded(gold.gold_table(clean_lines(spark, sf), name, MONEY))


def _view(name: str, view):
    return lambda spark, sf: rounded(view(gold.gold_table(clean_lines(spark, sf), name, MONEY)))


def all_gold_groups(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(gold.gold_groups(clean_lines(spark, sf), MONEY))


def clustered_gold_groups(spark: SparkSession, sf: str) -> DataFrame:
    """The same from stored lines, in another number of buckets."""
    lines = stage(clean_lines(spark, sf), "clean-lines")
    return rounded(gold.gold_groups(lines, MONEY, partitions=3))


def gold_key_violations(spark: SparkSession, sf: str) -> DataFrame:
    groups = stage(gold.gold_groups(clean_lines(spark, sf), MONEY), "gold-groups")
    checks = [
        quality.key_report(gold.gold_table_from_groups(groups, name), name, table.keys)
        for name, table in gold.TABLES.items()
    ]
    return reduce(DataFrame.unionByName, checks)


# --- sources and cleaning -------------------------------------------------------------------


def ingest_profile(spark: SparkSession, sf: str) -> DataFrame:
    names = ["lineitem", "orders", "customer", "part", "nation", "region"]
    stored = {name: read_table(spark, f"{sf}/{name}.parquet") for name in names}  # with the files' own schemas
    return reduce(DataFrame.unionByName, [quality.profile(table, name) for name, table in stored.items()])


def file_choices(spark: SparkSession, sf: str) -> DataFrame:
    """The file rule and the encoding test on folders with one UTF-8 file, two of the raw encoding, and none."""
    names = read(spark, sf, "customer").select(F.concat("c_name", F.lit("\u00e9")).alias("name"))
    root = _jobs_folder(spark)
    names.coalesce(1).write.options(header=True, encoding="UTF-8").csv(f"{root}/one")
    names.repartition(2).write.options(header=True, encoding=RAW_ENCODING).csv(f"{root}/two")
    names.write.parquet(f"{root}/none")

    def answer(folder: str, path: str | None) -> tuple:
        try:
            path = path or files.find_csv(spark, f"{root}/{folder}").path
            rule = "one" if folder == "one" else "named"
        except FileNotFoundError:
            return folder, "none", None, None, None
        except ValueError:
            return folder, "several", None, None, None
        encoding = files.detect_encoding(spark, path)
        lines = files.read_order_csv(spark, path, encoding=encoding)
        rows, right = lines.agg(F.count(F.lit(1)), F.count_if(F.col("name").endswith("\u00e9"))).first()
        return folder, rule, encoding, rows, right

    answers = [answer("one", None), answer("two", None), answer("two", f"{root}/two"), answer("none", None)]
    return spark.createDataFrame(answers, "folder string, rule string, encoding string, lines bigint, read_right bigint")


def ingest_digest(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and content of the stored table of a raw file without personal columns, which the job compared by content."""
    root = _jobs_folder(spark)
    blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    privacy_drop(spark, sf).write.options(header=True, compression="lz4", **blanks).csv(f"{root}/raw")
    jobs.ingest_job(spark, root, f"{root}/landed", file=f"{root}/raw", by_content=True)
    return quality.content_digest(read_table(spark, f"{root}/landed"))


def unique_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Columns of one name after cleaning; each keeps its values."""
    clashing = read(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_name", "c_mktsegment")
    return cleaning.rename(clashing.toDF("C Key", "c_key", "C-Key", "C Key 1"))[0]


def privacy_drop(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.drop_personal(raw_orders(spark, sf)).table


def rename_columns(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.rename(privacy_drop(spark, sf))[0]


def clean_categorical(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean_texts(rename_columns(spark, sf)).select(
        "order_id", "category_name", "customer_segment", "market", "type", "shipping_mode", "delivery_status"
    )


def clean_numeric(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean_numbers(rename_columns(spark, sf)).select(
        "order_id",
        "days_for_shipping_real",
        "late_delivery_risk",
        "order_item_discount",
        "order_item_discount_rate",
        "order_item_quantity",
        "order_profit_per_order",
        "product_price",
        "sales",
    )


def parse_timestamps(spark: SparkSession, sf: str) -> DataFrame:
    parsed = cleaning.parse_times(rename_columns(spark, sf))
    return parsed.select(
        "order_id",
        F.col("order_date").cast("timestamp_ntz").alias("order_date"),
        F.col("shipping_date").cast("timestamp_ntz").alias("shipping_date"),
    )


def dedup_rows(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.drop_duplicate_rows(twice_delivered(spark, sf))


def dedup_rows_by_hash(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.drop_rare_duplicates(stage(twice_delivered(spark, sf), "twice-delivered"))


def clean_report(spark: SparkSession, sf: str) -> DataFrame:
    lines, _ = cleaning.standardise(cleaning.drop_personal(raw_orders_twice(spark, sf)).table)
    return quality.duplicate_report(lines)


def null_summary(spark: SparkSession, sf: str) -> DataFrame:
    lines, _ = cleaning.standardise(raw_orders(spark, sf))
    return quality.null_counts(lines, NULL_CHECKED_COLUMNS)


def clean_orders_table(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(clean_orders(raw_orders_twice(spark, sf), relative_error=0).table)


def comparable(clean: DataFrame) -> DataFrame:
    dates = {name: F.col(name).cast("timestamp_ntz") for name in ["order_date", "shipping_date"]}
    return rounded(clean.withColumns(dates), {"profit_margin": 6})


# --- jobs ----------------------------------------------------------------------------------


def _jobs_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/jobs-{uuid4().hex}"


@cache
def _clean_jobs(application: str, sf: str) -> str:
    """The folder of the jobs from a raw file to the clean table, run once for each application and input."""
    spark = SparkSession.active()
    folder = _jobs_folder(spark)
    # A text that only the raw file's own encoding reads right; outer blanks are kept.
    raw = raw_orders_twice(spark, sf).withColumn("Order State", F.concat("Order State", F.lit("\u00e9")))
    blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    raw.write.options(header=True, encoding=RAW_ENCODING, compression="lz4", **blanks).csv(f"{folder}/raw")
    log = {"report_path": f"{folder}/reports"}
    jobs.ingest_job(spark, folder, f"{folder}/landed", file=f"{folder}/raw", **log)
    discard(spark, [f"{folder}/raw"])  # made for this job alone, which has landed it
    jobs.privacy_job(spark, f"{folder}/landed", f"{folder}/safe", **log)
    jobs.clean_job(spark, f"{folder}/safe", f"{folder}/clean", relative_error=0, **log)
    return folder


def job_clean_orders(spark: SparkSession, sf: str) -> DataFrame:
    """The clean table that the jobs store, from a raw file."""
    return comparable(read_table(spark, f"{_clean_jobs(spark.sparkContext.applicationId, sf)}/clean"))


def job_reports(spark: SparkSession, sf: str) -> DataFrame:
    reports = read_table(spark, f"{_clean_jobs(spark.sparkContext.applicationId, sf)}/reports")
    sizes = ["rows_before", "rows_after", "column_count_before", "column_count_after"]
    return reports.select("job", "status", *sizes, F.get_json_object("details", "$.encoding").alias("encoding"))


@cache
def _gold_job(application: str, sf: str) -> str:
    """The folder of the gold tables that the job stores, run once for each application and input."""
    spark = SparkSession.active()
    folder = _jobs_folder(spark)
    write_table(clean_lines(spark, sf), f"{folder}/clean")
    jobs.gold_job(spark, f"{folder}/clean", f"{folder}/gold", MONEY)
    return f"{folder}/gold"


def _stored_gold(name: str):
    return lambda spark, sf: rounded(read_table(spark, f"{_gold_job(spark.sparkContext.applicationId, sf)}/{name}"))


def gold_listing(spark: SparkSession, sf: str) -> DataFrame:
    """The gold tables of a database as its catalog lists them, with their rows and columns."""
    folder, database = _gold_job(spark.sparkContext.applicationId, sf), f"gold_{uuid4().hex}"
    spark.sql(f"create database {database} location '{_jobs_folder(spark)}'")
    for name in gold.TABLES:
        catalog.save_gold(read_table(spark, f"{folder}/{name}"), database, name)
    listed = [quality.profile(spark.table(f"{database}.{name}"), name) for name in catalog.list_tables(spark, database)]
    return reduce(DataFrame.unionByName, listed)


# --- features ------------------------------------------------------------------------------


def line_features(spark: SparkSession, sf: str) -> DataFrame:
    lines = features.add_line_features(order_lines(spark, sf)).select(
        "order_id",
        "order_profit_per_order",
        "shipping_delay_days",
        "profit_margin",
        "is_loss_order",
        "discount_level",
    )
    return rounded(lines, {"profit_margin": 6, "order_profit_per_order": 4})


def date_parts(spark: SparkSession, sf: str) -> DataFrame:
    return features.add_date_parts(order_lines(spark, sf)).select(
        "order_id", "order_year", "order_month", "order_day_of_week"
    )


def sales_threshold_table(spark: SparkSession, sf: str) -> DataFrame:
    low, high = sales_thresholds(order_lines(spark, sf), relative_error=0)
    return spark.createDataFrame([(low, high)], "low_sales_threshold double, high_sales_threshold double")


def sales_level(spark: SparkSession, sf: str) -> DataFrame:
    lines = order_lines(spark, sf)
    low, high = sales_thresholds(lines, relative_error=0)
    return features.add_sales_level(lines, low, high).select("order_id", "sales", "sales_level")


def prediction_options(spark: SparkSession, sf: str) -> DataFrame:
    lines = clean_lines(spark, sf)
    return views.prediction_options(views.gold_options({t: gold.gold_table(lines, t) for t in views.GOLD_OPTIONS.values()}))


# --- models --------------------------------------------------------------------------------


def model_data(spark: SparkSession, sf: str) -> DataFrame:
    """The labelled lines, staged: models and splits read them many times."""
    return stage(S.labelled(order_lines(spark, sf), ["order_id"]), "model-data")


def ml_class_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return S.class_distribution(S.labelled(order_lines(spark, sf)))


def ml_class_weights(spark: SparkSession, sf: str) -> DataFrame:
    return M.class_weights(S.labelled(order_lines(spark, sf)))


def ml_split_counts(spark: SparkSession, sf: str) -> DataFrame:
    data = model_data(spark, sf)
    parts = dict(zip(["train", "test"], S.exact_split(data)))
    counts = [S.class_distribution(part).select(F.lit(name).alias("part"), "*") for name, part in parts.items()]
    return reduce(DataFrame.unionByName, counts)


def ml_numeric_medians(spark: SparkSession, sf: str) -> DataFrame:
    medians = prepare.exact_medians(model_data(spark, sf), NUMERIC_FEATURES)
    return rounded(spark.createDataFrame(list(medians.items()), "feature string, median double"), {"median": 4})


def ml_scaled_stats(spark: SparkSession, sf: str) -> DataFrame:
    data = model_data(spark, sf)
    scales = prepare.learn_scales(data)
    learned = spark.createDataFrame(
        [(s.feature, s.median, s.mean, s.deviation) for s in scales],
        "feature string, median double, mean double, deviation double",
    )
    scaled = prepare.cleaning_stage(scales, []).transform(data)
    ends = scaled.agg(
        *[f(f"num__{s.feature}").alias(f"{k}__{s.feature}") for s in scales for k, f in (("min", F.min), ("max", F.max))]
    ).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(s.feature).alias("feature"),
                        F.col(f"min__{s.feature}").alias("smallest"),
                        F.col(f"max__{s.feature}").alias("largest"),
                    )
                    for s in scales
                ]
            )
        )
    )
    places = dict.fromkeys(["median", "mean", "deviation", "smallest", "largest"], 4)
    return rounded(learned.join(ends, "feature"), places)


def ml_imputed_levels(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of each level of a text that is missing in a third of them."""
    lines = order_lines(spark, sf).withColumn("type", F.nullif("type", F.lit("R")))
    imputed = prepare.cleaning_stage([], ["type"]).transform(lines)
    return imputed.groupBy(F.col("text__type").alias("level")).agg(F.count(F.lit(1)).alias("lines"))


def ml_onehot_levels(spark: SparkSession, sf: str) -> DataFrame:
    return prepare.onehot_levels(prepare.fit_preparation(model_data(spark, sf)), spark)


@cache
def _training(application: str, sf: str) -> tuple[M.Training, DataFrame]:
    """The default models on the exact split, fitted once for each application and input."""
    data = model_data(SparkSession.active(), sf)
    return M.train_and_compare(*S.exact_split(data)), data


def training(spark: SparkSession, sf: str) -> tuple[M.Training, DataFrame]:
    return _training(spark.sparkContext.applicationId, sf)


def ml_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.model_comparison(spark, training(spark, sf)[0].metrics)


def feature_importance(spark: SparkSession, sf: str) -> DataFrame:
    trained, _ = training(spark, sf)
    return M.feature_importance(spark, trained.models[trained.best], trained.names)


def late_risk_scores(spark: SparkSession, sf: str) -> DataFrame:
    trained, data = training(spark, sf)
    scored = advise(score(trained.models[trained.best], data))
    return scored.select("order_id", "prediction", "late_probability", "title", "level", "advice", "probability_text")


@cache
def _small_forest(application: str, sf: str) -> tuple[forest.ForestModel, DataFrame]:
    """Two trees of depth 4 over all slots and rows, with exact edges: SQL can grow the same. Fitted once, as above."""
    data = model_data(SparkSession.active(), sf)
    train = data.select(*S.FEATURES, TARGET)
    weights = {row[TARGET]: row[M.WEIGHT] for row in M.class_weights(train).collect()}
    settings = forest.ForestSettings(2, 4, slots=10**6, bins=8, bootstrap=False, large_rows=20_000, quantile_error=0)
    return forest.fit_forest(train, prepare.fit_preparation(train), weights, settings), data


def forest_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_small_forest(spark.sparkContext.applicationId, sf)[0].nodes, dict.fromkeys(["weight_0", "weight_1", "gain"], 4))


def forest_scores(spark: SparkSession, sf: str) -> DataFrame:
    model, data = _small_forest(spark.sparkContext.applicationId, sf)
    return rounded(score(model, data).select("order_id", "prediction", "late_probability"), {"late_probability": 8})


def forest_importances(spark: SparkSession, sf: str) -> DataFrame:
    model, _ = _small_forest(spark.sparkContext.applicationId, sf)
    shown = M.feature_importance(spark, model, model.slot_names, rows=10**6).where("importance > 0")
    return rounded(shown, {"importance": 8})


def ml_regression_gradient(spark: SparkSession, sf: str) -> DataFrame:
    """The fitted regression is at its optimum: every component of the gradient is zero."""
    train = model_data(spark, sf).select(*S.FEATURES, TARGET)
    models, _ = M.fit_models(train, {M.LOGISTIC_REGRESSION: M.DEFAULT_ESTIMATORS[M.LOGISTIC_REGRESSION]})
    weights = {row[TARGET]: row[M.WEIGHT] for row in M.class_weights(train).collect()}
    gradient = M.regression_gradient(models[M.LOGISTIC_REGRESSION], train, weights)
    return rounded(gradient.withColumn("gradient", F.abs("gradient")), {"gradient": 3})


def model_test_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Test rows of each model and class, and whether its accuracy is that of its stored scores."""
    trained, _ = training(spark, sf)

    def rows(name: str, found: M.Evaluation) -> DataFrame:
        right = found.scored.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
        agrees = abs(right - found.metrics["accuracy"]) < 1e-9
        counts = found.scored.groupBy("label").agg(F.count(F.lit(1)).alias("rows"))
        return counts.select(F.lit(name).alias("model"), "label", "rows", F.lit(agrees).alias("accuracy_agrees"))

    return reduce(DataFrame.unionByName, [rows(*item) for item in trained.evaluations.items()])


def model_reloaded(spark: SparkSession, sf: str) -> DataFrame:
    """Lines scored by the best model, and those that its stored copy scores otherwise."""
    trained, data = training(spark, sf)
    path = f"{_jobs_folder(spark)}/model"
    save_model(trained.models[trained.best], path)
    before = score(trained.models[trained.best], data)
    before = before.withColumnsRenamed({"prediction": "prediction_before", "late_probability": "probability_before"})
    after = score(load_model(path), before)
    same = F.col("prediction").eqNullSafe(F.col("prediction_before"))
    same &= F.col("late_probability").eqNullSafe(F.col("probability_before"))
    return after.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~same).alias("changed"))


def rule_scores(spark: SparkSession, sf: str) -> DataFrame:
    """A score both engines compute alike: tighter schedules and higher sales count as riskier."""
    value = (9 - F.col("days_for_shipment_scheduled")) / F.lit(10.0) + F.col("sales") / F.lit(10000000.0)
    return _scored_by(order_lines(spark, sf), value)


def _scored_by(lines: DataFrame, value: Column) -> DataFrame:
    scored = lines.select("order_id", F.col(TARGET).alias("label"), value.alias("score"))
    return scored.withColumn("prediction", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def score_advice(spark: SparkSession, sf: str) -> DataFrame:
    scored = rule_scores(spark, sf).withColumnRenamed("score", "late_probability")
    return advise(scored).select("order_id", "prediction", "title", "level", "advice", "probability_text")


def rule_comparison(spark: SparkSession, sf: str) -> DataFrame:
    """The metrics of two rules, compared like models, and which is the best."""
    rules = {
        "schedule": rule_scores(spark, sf),
        "quantity": _scored_by(order_lines(spark, sf), F.col("order_item_quantity") / F.lit(50.0)),
    }
    metrics = {}
    for name, scored in rules.items():
        scored = stage(scored, "rule-scores")
        metrics[name] = evaluation.evaluate(scored, stage(evaluation.score_groups(scored), "score-groups"))
    best = F.col("model") == evaluation.best_model(metrics)
    return evaluation.model_comparison(spark, metrics).withColumn("is_best", best)


def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.confusion_matrix(rule_scores(spark, sf))


def classification_report(spark: SparkSession, sf: str) -> DataFrame:
    report = evaluation.classification_report(rule_scores(spark, sf))
    return rounded(report, dict.fromkeys(["precision", "recall", "f1_score"], 6))


def score_groups(spark: SparkSession, sf: str) -> DataFrame:
    return stage(evaluation.score_groups(rule_scores(spark, sf)), "score-groups")


def roc_curve(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.roc_curve(score_groups(spark, sf))


def roc_auc(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.roc_auc(score_groups(spark, sf)), {"roc_auc": 10})


QUERIES = {
    "late_by_shipping_mode": _gold("late_by_shipping_mode"),
    "late_by_market": _gold("late_by_market"),
    "late_by_region": _gold("late_by_region"),
    "late_by_category": _gold("late_by_category"),
    "late_by_country": _gold("late_by_country"),
    "late_by_segment": lambda spark, sf: gold.late_by(clean_lines(spark, sf), "customer_segment", MONEY),
    "executive_kpis": _gold("executive_kpis"),
    "profit_impact": _gold("profit_impact"),
    "risky_products": _gold("risky_products"),
    "discount_profit_summary": _gold("discount_profit_summary"),
    "top_products_by_sales": _gold("top_products_by_sales"),
    "loss_by_market": _gold("loss_by_market"),
    "profit_margin_by_category": _gold("profit_margin_by_category"),
    "gold_groups": all_gold_groups,
    "gold_groups_clustered": clustered_gold_groups,
    "gold_key_violations": gold_key_violations,
    "most_risky_mode": _view("late_by_shipping_mode", views.most_risky_mode),
    "top_categories_by_sales": _view("late_by_category", views.top_categories_by_sales),
    "top12_categories_by_sales": _view("late_by_category", lambda t: views.top_categories_by_sales(t, views.TOP_ROWS)),
    "market_order_share": _view("late_by_market", views.market_order_share),
    "top_regions_by_risk": _view("late_by_region", lambda t: views.top_late(t, "order_region")),
    "top_countries_by_risk": _view("late_by_country", lambda t: views.top_late(t, "order_country")),
    "top_categories_by_risk": _view("late_by_category", lambda t: views.top_late(t, "category_name")),
    "top12_products_by_sales": _view("top_products_by_sales", views.top_products_by_sales),
    "top12_risky_products": _view("risky_products", views.top_risky_products),
    "shipping_mode_decisions": _view("late_by_shipping_mode", views.shipping_mode_decisions),
    "market_decisions": _view("late_by_market", views.market_decisions),
    "kpi_display": _view("executive_kpis", views.kpi_display),
    "prediction_options": prediction_options,
    "ingest_profile": ingest_profile,
    "ingest_digest": ingest_digest,
    "file_choices": file_choices,
    "unique_columns": unique_columns,
    "privacy_drop": privacy_drop,
    "rename_columns": rename_columns,
    "clean_categorical": clean_categorical,
    "clean_numeric": clean_numeric,
    "parse_timestamps": parse_timestamps,
    "dedup_rows": dedup_rows,
    "dedup_rows_by_hash": dedup_rows_by_hash,
    "clean_report": clean_report,
    "null_summary": null_summary,
    "clean_orders": clean_orders_table,
    "line_features": line_features,
    "date_parts": date_parts,
    "sales_thresholds": sales_threshold_table,
    "sales_level": sales_level,
    "ml_class_distribution": ml_class_distribution,
    "ml_class_weights": ml_class_weights,
    "ml_split_counts": ml_split_counts,
    "ml_numeric_medians": ml_numeric_medians,
    "ml_scaled_stats": ml_scaled_stats,
    "ml_imputed_levels": ml_imputed_levels,
    "ml_onehot_levels": ml_onehot_levels,
    "ml_metrics": ml_metrics,
    "feature_importance": feature_importance,
    "late_risk_scores": late_risk_scores,
    "forest_nodes": forest_nodes,
    "forest_scores": forest_scores,
    "forest_importances": forest_importances,
    "ml_regression_gradient": ml_regression_gradient,
    "model_test_rows": model_test_rows,
    "model_reloaded": model_reloaded,
    "score_advice": score_advice,
    "rule_comparison": rule_comparison,
    "job_clean_orders": job_clean_orders,
    "job_reports": job_reports,
    "gold_listing": gold_listing,
    **{f"job_{name}": _stored_gold(name) for name in gold.TABLES},
    "confusion_matrix": confusion_matrix,
    "classification_report": classification_report,
    "roc_curve": roc_curve,
    "roc_auc": roc_auc,
}
