"""Balanced logistic regression and random forest on prepared features.

The forest is this library's own (see ``forest``); ``random_forest`` gives Spark's, which any caller may pass instead.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lateline.ml.evaluation import best_model, evaluate, score_groups
from lateline.ml.forest import ForestModel, ForestSettings, fit_forest, importances
from lateline.ml.prepare import FEATURE_VECTOR, feature_names, fit_preparation, level_lists
from lateline.ml.scoring import Model, score
from lateline.ml.split import FEATURES, SEED, class_distribution
from lateline.schema import TARGET
from lateline.sources.staging import discard, noted, stage

# ---------------------------------------------------------------------------
# Model settings.
# ---------------------------------------------------------------------------

MAX_ITERATIONS = 1000
INVERSE_PENALTY = 1.0
TREES = 120
DEPTH = 18

LOGISTIC_REGRESSION = "Logistic Regression"
RANDOM_FOREST = "Random Forest"

# ---------------------------------------------------------------------------

WEIGHT = "class_weight"


def class_weights(data: DataFrame) -> DataFrame:
    """``rows / (classes * rows of the class)`` per class."""
    counts = class_distribution(data)
    whole = counts.agg(F.sum("rows").alias("all_rows"), F.count(F.lit(1)).alias("classes")).first()
    weight = F.lit(whole["all_rows"]) / (F.lit(whole["classes"]) * F.col("rows"))
    return counts.select(TARGET, "rows", weight.alias(WEIGHT))


def weight_column(weights: dict[int, float]) -> Column:
    """The class weight of a row as literals of the label, with no join."""
    result = F.lit(None).cast("double")
    for label, weight in weights.items():
        result = F.when(F.col(TARGET) == label, F.lit(weight)).otherwise(result)
    return result


def logistic_regression(rows: int, max_iterations: int = MAX_ITERATIONS) -> Estimator:
    """Ridge penalty of strength 1 on the sum of losses; balanced weights add up to ``rows``."""
    return LogisticRegression(
        featuresCol=FEATURE_VECTOR,
        labelCol=TARGET,
        weightCol=WEIGHT,
        regParam=1.0 / (INVERSE_PENALTY * rows),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=max_iterations,
    )


def random_forest(
    trees: int = TREES, depth: int = DEPTH, seed: int = SEED, memory_mb: int = 1024
) -> Estimator:
    """``memory_mb`` bounds the split statistics of one pass: more memory, fewer passes over the data."""
    return RandomForestClassifier(
        featuresCol=FEATURE_VECTOR,
        labelCol=TARGET,
        weightCol=WEIGHT,
        numTrees=trees,
        maxDepth=depth,
        featureSubsetStrategy="sqrt",
        impurity="gini",
        seed=seed,
        maxMemoryInMB=memory_mb,
        cacheNodeIds=True,
    )


#: From the number of training rows to what is fitted.
Estimators = dict[str, Callable[[int], Estimator | ForestSettings]]

DEFAULT_ESTIMATORS: Estimators = {
    LOGISTIC_REGRESSION: lambda rows: logistic_regression(rows),
    RANDOM_FOREST: lambda rows: ForestSettings(TREES, DEPTH, seed=SEED),
}


@dataclass(frozen=True)
class Evaluation:
    scored: DataFrame
    groups: DataFrame
    metrics: dict


@dataclass(frozen=True)
class Training:
    models: dict[str, Model]
    evaluations: dict[str, Evaluation]
    names: list[str]

    @property
    def metrics(self) -> dict[str, dict]:
        return {name: evaluation.metrics for name, evaluation in self.evaluations.items()}

    @property
    def best(self) -> str:
        return best_model(self.metrics)


def fit_models(train: DataFrame, estimators: Estimators = DEFAULT_ESTIMATORS) -> tuple[dict[str, Model], list[str]]:
    """Fit all models on one shared preparation.

    The rows are staged once in even partitions, as fitting passes over them many times. They are not cached: the regression
    caches its own blocks of them, and both together would leave the memory for the disk.
    """
    spark = train.sparkSession
    with noted() as staged:
        train = stage(train.select(*FEATURES, TARGET).hint("rebalance"), "train-rows")
    try:
        preparation = fit_preparation(train)
        weights = {row[TARGET]: row[WEIGHT] for row in class_weights(train).collect()}  # one row per class
        prepared = (
            preparation.transform(train)
            .withColumn(WEIGHT, weight_column(weights))
            .select(FEATURE_VECTOR, TARGET, WEIGHT)
        )
        rows = train.count()

        def fitted(estimator: Estimator | ForestSettings) -> Model:
            if isinstance(estimator, ForestSettings):
                return fit_forest(train, preparation, weights, estimator)
            return PipelineModel([*preparation.stages, estimator.fit(prepared)])

        models = {name: fitted(make(rows)) for name, make in estimators.items()}
    finally:
        discard(spark, staged)
    return models, feature_names(preparation)


def measure(model: Model, test: DataFrame) -> Evaluation:
    """Score the test rows once, and take all figures from the staged scores."""
    scored = score(model, test).select(
        F.col(TARGET).alias("label"), "prediction", F.col("late_probability").alias("score")
    )
    scored = stage(scored, "scored")
    groups = stage(score_groups(scored), "score-groups")
    return Evaluation(scored, groups, evaluate(scored, groups))


def train_and_compare(train: DataFrame, test: DataFrame, estimators: Estimators = DEFAULT_ESTIMATORS) -> Training:
    """Fit all models and measure them on the test rows."""
    models, names = fit_models(train, estimators)
    return Training(models, {name: measure(model, test) for name, model in models.items()}, names)


def feature_importance(session, model: Model, names: list[str], rows: int = 20) -> DataFrame:
    """The ``rows`` most important feature slots: tree importances, or absolute coefficients."""
    if isinstance(model, ForestModel):
        slots = session.createDataFrame(list(enumerate(names)), "slot int, feature string")
        table = slots.join(importances(model), "slot", "left").select("feature", F.coalesce("importance", F.lit(0.0)).alias("importance"))
        return table.orderBy(F.desc("importance"), "feature").limit(rows)
    classifier = model.stages[-1]
    if hasattr(classifier, "featureImportances"):
        values = classifier.featureImportances.toArray()
    else:
        values = abs(classifier.coefficients.toArray())
    table = session.createDataFrame(
        [(name, float(value)) for name, value in zip(names, values)], "feature string, importance double"
    )
    return table.orderBy(F.desc("importance"), "feature").limit(rows)


def regression_gradient(model: PipelineModel, train: DataFrame, weights: dict[int, float]) -> DataFrame:
    """``(feature, gradient)`` of the penalised loss at the fitted coefficients, and of the intercept: all zero at the optimum.

    The loss is the weighted mean over the rows, plus half the penalty times the squared coefficients. One aggregation
    over one number for each feature of a row, summed in the tasks before the shuffle.
    """
    classifier, preparation = model.stages[-1], PipelineModel(model.stages[:-1])
    numbers = [name for name in preparation.stages[3].getInputCols() if name.startswith("num__")]
    texts = list(preparation.stages[1].getOutputCols())
    levels = list(level_lists(preparation).values())
    scored = model.transform(train).withColumn(WEIGHT, weight_column(weights))
    residual = F.col(WEIGHT) * (vector_to_array("probability")[1] - F.col(TARGET))
    first_slots = [len(numbers) + sum(len(x) for x in levels[:i]) for i in range(len(levels))]

    def part(slot: Column, value: Column) -> Column:
        return F.struct(slot.cast("int").alias("slot"), value.alias("value"))

    intercept, whole = len(numbers) + sum(len(x) for x in levels), -1
    parts = [part(F.lit(i), residual * F.col(name)) for i, name in enumerate(numbers)]
    for name, first, level in zip(texts, first_slots, levels):  # a level unseen in training has no slot
        parts.append(F.when(F.col(name) < len(level), part(F.lit(first) + F.col(name), residual)))
    parts += [part(F.lit(intercept), residual), part(F.lit(whole), F.col(WEIGHT))]
    sums = scored.select(F.inline(F.array_compact(F.array(*parts)))).groupBy("slot").agg(F.sum("value").alias("value"))
    found = {row["slot"]: row["value"] for row in sums.collect()}  # a number for each coefficient
    pull = [float(c) * classifier.getRegParam() for c in classifier.coefficients.toArray()] + [0.0]
    rows = [
        (name, found.get(slot, 0.0) / found[whole] + pull[slot])
        for slot, name in enumerate([*feature_names(preparation), "intercept"])
    ]
    return train.sparkSession.createDataFrame(rows, "feature string, gradient double")
