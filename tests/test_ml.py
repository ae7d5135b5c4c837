import os
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from fixtures.contract import model_data
from lateline.ml import evaluation, forest, prepare, scoring, split, train
from lateline.plans import jobs
from lateline.schema import LEAKAGE_COLUMNS, NUMERIC_FEATURES, TARGET
from lateline.sources import files, staging

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def data(spark):
    return model_data(spark, SF)


@pytest.fixture(scope="module")
def fitted(data):
    return train.fit_models(data, {"lr": lambda rows: train.logistic_regression(rows, 20)})


def test_leakage_guard():
    split.check_features(split.FEATURES)
    for name in LEAKAGE_COLUMNS:
        with pytest.raises(ValueError, match=name):
            split.check_features([*split.FEATURES, name])


def test_unlabelled_lines_are_left_out(spark):
    columns = ", ".join(f"{name} string" for name in [*split.FEATURES, TARGET])
    rows = [("1",) * len(split.FEATURES) + (label,) for label in ("1", None)]
    table = split.labelled(spark.createDataFrame(rows, columns))
    assert [row[TARGET] for row in table.collect()] == [1]


@pytest.mark.parametrize(
    "counts, held_out",
    [
        ({0: 81542, 1: 98977}, {0: 16308, 1: 19796}),
        ({0: 5, 1: 5}, {0: 1, 1: 1}),
        ({0: 1, 1: 2}, {0: 0, 1: 1}),
        ({}, {}),
    ],
)
def test_held_out_counts(counts, held_out):
    assert split.held_out_counts(counts) == held_out


def test_exact_split(data):
    parts = split.exact_split(data)
    counts = {row[TARGET]: row["rows"] for row in split.class_distribution(data).collect()}
    held_out = {row[TARGET]: row["rows"] for row in split.class_distribution(parts[1]).collect()}
    assert held_out == split.held_out_counts(counts)
    assert parts[0].count() + parts[1].count() == data.count()
    assert parts[1].exceptAll(split.exact_split(data)[1]).isEmpty()
    other = split.labelled(data.drop(split.SPLIT_HASH), ["order_id"], seed=7)
    other_test = split.exact_split(other)[1].drop(split.SPLIT_HASH)
    assert other_test.count() == parts[1].count()
    assert not parts[1].drop(split.SPLIT_HASH).exceptAll(other_test).isEmpty()


def test_exact_split_of_one_class_or_none(data):
    late = data.where(F.col(TARGET) == 1)
    assert split.exact_split(late)[1].count() == -(-late.count() // 5)
    assert [part.count() for part in split.exact_split(data.limit(0))] == [0, 0]


def test_hash_split(data):
    parts = split.hash_split(data)
    rows = data.count()
    assert parts[0].count() + parts[1].count() == rows
    assert abs(parts[1].count() / rows - 0.2) < 0.03


def test_class_weights(spark):
    table = spark.createDataFrame([(1,)] * 3 + [(0,)], f"{TARGET} int")
    assert {row[TARGET]: row["class_weight"] for row in train.class_weights(table).collect()} == {0: 2.0, 1: 4 / 6}


@pytest.fixture(scope="module")
def small(spark):
    rows = [(1.0, "b"), (2.0, "a"), (3.0, None), (10.0, "c"), (None, "a")]
    return spark.createDataFrame(rows, "n double, t string")


def test_preparation(spark, small):
    preparation = prepare.fit_preparation(small, ["n"], ["t"])
    assert prepare.level_lists(preparation) == {"t": ["Unknown", "a", "b", "c"]}
    assert prepare.feature_names(preparation) == ["num__n", "cat__t_Unknown", "cat__t_a", "cat__t_b", "cat__t_c"]
    vectors = [row["features"].toArray().tolist() for row in preparation.transform(small).collect()]
    numbers = [vector[0] for vector in vectors]
    imputed = [1.0, 2.0, 3.0, 10.0, 2.5]  # the interpolated median of the known values
    mean = sum(imputed) / 5
    deviation = (sum((x - mean) ** 2 for x in imputed) / 5) ** 0.5
    assert numbers == pytest.approx([(x - mean) / deviation for x in imputed])
    assert vectors[2][1:] == [1, 0, 0, 0] and vectors[3][1:] == [0, 0, 0, 1]
    unseen = preparation.transform(spark.createDataFrame([(None, "new")], "n double, t string")).first()
    assert unseen["features"].toArray()[1:].tolist() == [0, 0, 0, 0]


def test_constant_feature(spark):
    scales = prepare.learn_scales(spark.createDataFrame([(4.0,), (4.0,)], "n double"), ["n"])
    assert (scales[0].median, scales[0].mean, scales[0].deviation) == (4.0, 4.0, 1.0)
    with pytest.raises(ValueError, match="n"):
        prepare.learn_scales(spark.createDataFrame([(None,)], "n double"), ["n"])


@pytest.fixture(scope="module")
def scored(spark):
    generator = random.Random(3)
    rows = [(generator.randint(0, 1), round(generator.random(), 2)) for _ in range(400)]
    return spark.createDataFrame([(label, int(s >= 0.5), s) for label, s in rows], "label int, prediction int, score double")


def test_area_equals_the_library_and_the_rank_formula(scored):
    area = evaluation.roc_auc(evaluation.score_groups(scored)).first()["roc_auc"]
    vectors = VectorAssembler(inputCols=["score"], outputCol="raw").transform(scored)
    one_column = vectors.select(F.col("label").cast("double").alias("label"), F.col("score").alias("rawPrediction"))
    assert area == pytest.approx(BinaryClassificationEvaluator(numBins=0).evaluate(one_column))
    rows = scored.collect()
    pairs = [(p["score"], n["score"]) for p in rows if p["label"] for n in rows if not n["label"]]
    assert area == pytest.approx(sum((p > n) + (p == n) / 2 for p, n in pairs) / len(pairs))


def test_roc_points(scored):
    points = evaluation.roc_curve(evaluation.score_groups(scored)).orderBy(F.desc_nulls_first("threshold")).collect()
    rows = scored.collect()
    positives = sum(row["label"] for row in rows)
    for point in points[1:]:
        above = [row["label"] for row in rows if row["score"] >= point["threshold"]]
        assert point["tpr"] == pytest.approx(sum(above) / positives)
        assert point["fpr"] == pytest.approx((len(above) - sum(above)) / (len(rows) - positives))
    assert tuple(points[0]) == (None, 0.0, 0.0) and tuple(points[-1])[1:] == (1.0, 1.0)


def test_confusion_and_report(scored):
    cells = {(r["actual"], r["predicted"]): r["rows"] for r in evaluation.confusion_matrix(scored).collect()}
    report = {row["class"]: row for row in evaluation.classification_report(scored).collect()}
    assert sum(cells.values()) == report["accuracy"]["support"] == 400
    assert report["1"]["support"] == cells[1, 0] + cells[1, 1]
    assert report["1"]["precision"] == pytest.approx(cells[1, 1] / (cells[1, 1] + cells[0, 1]))
    metrics = evaluation.evaluate(scored, evaluation.score_groups(scored))
    assert metrics["f1_score"] == pytest.approx(report["1"]["f1_score"])
    assert metrics["accuracy"] == pytest.approx(report["accuracy"]["f1_score"])


def test_one_class_only(spark):
    scored = spark.createDataFrame([(0, 0, 0.1), (0, 0, 0.2)], "label int, prediction int, score double")
    cells = [row["rows"] for row in evaluation.confusion_matrix(scored).orderBy("actual", "predicted").collect()]
    assert cells == [2, 0, 0, 0]
    metrics = evaluation.evaluate(scored, evaluation.score_groups(scored))
    assert (metrics["precision"], metrics["recall"], metrics["f1_score"], metrics["roc_auc"]) == (0.0, 0.0, 0.0, None)
    assert evaluation.roc_auc(evaluation.score_groups(scored.limit(0))).first()["roc_auc"] is None


def test_best_model_is_the_first_of_the_highest():
    assert evaluation.best_model({"a": {"f1_score": 0.5}, "b": {"f1_score": 0.7}, "c": {"f1_score": 0.7}}) == "b"


def test_scoring(spark, data, fitted, tmp_path):
    models, names = fitted
    model = models["lr"]
    assert len(names) == model.stages[-1].numFeatures
    path = str(tmp_path / "model")
    scoring.save_model(model, path)
    before = [row["late_probability"] for row in scoring.score(model, data).collect()]
    assert before == [row["late_probability"] for row in scoring.score(scoring.load_model(path), data).collect()]
    order = {name: None for name in split.FEATURES if name not in ("order_item_product_price", "product_price")}
    order |= {"market": "nowhere", "shipping_mode": "1-URGENT", "days_for_shipment_scheduled": 2.0}
    kinds = [f"{name} {'double' if name in NUMERIC_FEATURES else 'string'}" for name in order]
    orders = spark.createDataFrame([(*order.values(), 950.0)], ", ".join([*kinds, "item_price double"]))
    row = scoring.advise(scoring.score(model, orders)).first()
    assert row["order_item_product_price"] == row["product_price"] == 950.0
    assert 0 <= row["late_probability"] <= 1 and row["prediction"] == int(row["late_probability"] > 0.5)
    assert row["title"].startswith("High" if row["prediction"] else "Low")


def test_training_job(spark, data, tmp_path):
    clean = str(tmp_path / "clean")
    files.write_table(data, clean)
    estimators = {
        train.LOGISTIC_REGRESSION: lambda rows: train.logistic_regression(rows, 10),
        train.RANDOM_FOREST: lambda rows: train.ForestSettings(5, 4),
    }
    out = str(tmp_path / "model")
    result = jobs.training_job(spark, clean, out, estimators, report_path=str(tmp_path / "reports"))
    assert set(result.metrics) == set(estimators) and result.best in estimators
    table = {name: files.read_table(spark, f"{out}/{name}") for name in [
        "model_metrics", "classification_report", "confusion_matrix", "feature_importance", "roc_curve", "class_distribution",
    ]}
    assert table["model_metrics"].count() == 2 and table["confusion_matrix"].count() == 8
    assert table["feature_importance"].count() == 20
    held_out = files.read_table(spark, str(tmp_path / "reports")).first()["rows_after"]
    assert table["confusion_matrix"].groupBy("model").agg(F.sum("rows")).first()[1] == held_out
    assert scoring.score(scoring.load_model(f"{out}/model"), data).count() == data.count()


def test_missing_nan_and_infinite_numbers_are_imputed(spark):
    values = [1.0, 2.0, float("nan"), None, float("inf"), 3.0]
    table = spark.createDataFrame([(v,) for v in values], "x double")
    [scale] = prepare.learn_scales(table, ["x"])
    scaled = [r[0] for r in prepare.cleaning_stage([scale], []).transform(table).select("num__x").collect()]
    assert all(abs(v) < 10 for v in scaled) and abs(sum(scaled)) < 1e-9


def test_training_rows_are_staged_and_not_cached_beside_the_blocks_of_the_regression(spark, data):
    """While a model is fitted no table is cached; the staged rows, and those of a forest, are deleted afterwards."""
    cached, seen = spark._jsparkSession.sharedState().cacheManager(), []
    folder = staging.shared_folder(spark).removeprefix("file:")
    staged = lambda: {name for name in os.listdir(folder) if name.startswith("staged-")}
    before = staged()

    def regression(rows):
        seen.append((cached.isEmpty(), [name[:17] for name in staged() - before]))
        return train.logistic_regression(rows, 2)

    small = forest.ForestSettings(trees=2, depth=3)
    train.fit_models(data, {"lr": regression, "forest": lambda rows: small})
    assert seen == [(True, ["staged-train-rows"])]
    assert [name[:19] for name in staged() - before] == ["staged-forest-nodes"]
