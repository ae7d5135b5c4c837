"""Evaluation of a 0/1 prediction and its score, from counts only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lateline.operators.running import RANGES, running_totals

CLASSES = [0, 1]
METRICS = ["accuracy", "precision", "recall", "f1_score", "roc_auc"]


def _cell(actual: int, predicted: int) -> str:
    return f"n{actual}{predicted}"


def _cells(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    """The four counts in one row, zeros included."""
    return scored.agg(
        *[
            F.count_if((F.col(label) == actual) & (F.col(prediction) == predicted)).alias(_cell(actual, predicted))
            for actual in CLASSES
            for predicted in CLASSES
        ]
    )


def confusion_matrix(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(actual, predicted, rows)`` for all four pairs."""
    grid = [
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(_cell(a, p)).alias("rows"))
        for a in CLASSES
        for p in CLASSES
    ]
    return _cells(scored, label, prediction).select(F.inline(F.array(*grid)))


def _ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, 0 for an empty whole."""
    return F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0))


def _class_figures(label: int) -> tuple[Column, Column, Column, Column]:
    """Precision, recall, F1 and support of one class."""
    other = 1 - label
    hit, support = F.col(_cell(label, label)), F.col(_cell(label, label)) + F.col(_cell(label, other))
    predicted = hit + F.col(_cell(other, label))
    return _ratio(hit, predicted), _ratio(hit, support), _ratio(2 * hit, predicted + support), support


def _accuracy() -> Column:
    right = F.col(_cell(0, 0)) + F.col(_cell(1, 1))
    return _ratio(right, right + F.col(_cell(0, 1)) + F.col(_cell(1, 0)))


def classification_report(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per-class figures, accuracy, and their macro and support-weighted means."""
    figures = {name: _class_figures(name) for name in CLASSES}
    support = figures[0][3] + figures[1][3]

    def row(name: str, precision, recall, f1, rows) -> Column:
        values = {"class": F.lit(name), "precision": precision, "recall": recall, "f1_score": f1, "support": rows}
        return F.struct(*[value.alias(key) for key, value in values.items()])

    none = F.lit(None).cast("double")
    macro = [(figures[0][i] + figures[1][i]) / 2 for i in range(3)]
    weighted = [_ratio(figures[0][i] * figures[0][3] + figures[1][i] * figures[1][3], support) for i in range(3)]
    rows = [
        *[row(str(name), *figures[name]) for name in CLASSES],
        row("accuracy", none, none, _accuracy(), support),
        row("macro avg", *macro, support),
        row("weighted avg", *weighted, support),
    ]
    return _cells(scored, label, prediction).select(F.inline(F.array(*rows)))


def score_groups(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Positives and negatives per distinct score; combined map-side. Stage it: it is read more than once."""
    return scored.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("positives"), F.count_if(F.col(label) == 0).alias("negatives")
    )


def roc_curve(groups: DataFrame, ranges: int = RANGES) -> DataFrame:
    """``(threshold, fpr, tpr)`` at every distinct score, and the origin (no threshold).

    Built from ``score_groups``, which it reads more than once. A class without rows has no
    rate, so its column is null then. A range of scores is one task's: give more ``ranges`` for very
    many distinct scores.
    """
    totals = groups.agg(F.sum("positives").alias("all_positives"), F.sum("negatives").alias("all_negatives")).first()
    # Two numbers; nullif leaves a rate of an absent class null.
    positives = F.nullif(F.lit(totals["all_positives"]), F.lit(0))
    negatives = F.nullif(F.lit(totals["all_negatives"]), F.lit(0))
    points = running_totals(groups, "threshold", ["positives", "negatives"], ranges).select(
        "threshold",
        ((F.col("negatives_before") + F.col("negatives")) / negatives).alias("fpr"),
        ((F.col("positives_before") + F.col("positives")) / positives).alias("tpr"),
    )
    origin = groups.sparkSession.createDataFrame([(None, 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return points.unionByName(origin)


def roc_auc(groups: DataFrame, ranges: int = RANGES) -> DataFrame:
    """Area under the ROC curve in one row: the share of pairs ranked right, ties half; null without both classes."""
    ranked = running_totals(groups, "threshold", ["positives"], ranges)
    right = F.col("negatives") * (F.col("positives_before") + F.col("positives") / 2)
    pairs = F.sum("positives").cast("double") * F.sum("negatives").cast("double")
    return ranked.agg(F.try_divide(F.sum(right), pairs).alias("roc_auc"))


def evaluate(scored: DataFrame, groups: DataFrame, label: str = "label", prediction: str = "prediction") -> dict:
    """The five metrics of class 1 as plain numbers, from scored rows and their ``score_groups``."""
    precision, recall, f1, _ = _class_figures(1)
    counted = _cells(scored, label, prediction).select(
        _accuracy().alias("accuracy"), precision.alias("precision"), recall.alias("recall"), f1.alias("f1_score")
    )
    return {**counted.first().asDict(), **roc_auc(groups).first().asDict()}


def model_comparison(session, metrics: dict[str, dict]) -> DataFrame:
    """One row of rounded metrics per model, in training order."""
    rows = [
        (place, name, *[None if values[m] is None else round(float(values[m]), 4) for m in METRICS])
        for place, (name, values) in enumerate(metrics.items())
    ]
    columns = ", ".join(f"{name} double" for name in METRICS)
    return session.createDataFrame(rows, f"place int, model string, {columns}")


def best_model(metrics: dict[str, dict]) -> str:
    """The model with the highest unrounded F1; the first of equal ones."""
    return max(metrics, key=lambda name: metrics[name]["f1_score"])
