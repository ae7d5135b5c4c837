"""Batch scoring of orders with a fitted model, and model storage."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lateline.functions import display as D
from lateline.ml.forest import ForestModel, probabilities

Model = PipelineModel | ForestModel


def with_item_price(orders: DataFrame) -> DataFrame:
    """Orders priced once: the one price stands for both price features."""
    if "item_price" not in orders.columns:
        return orders
    return orders.withColumns(
        {"order_item_product_price": F.col("item_price"), "product_price": F.col("item_price")}
    )


def score(model: Model, orders: DataFrame) -> DataFrame:
    """The orders with predicted class and probability of lateness; the input columns stay."""
    priced = with_item_price(orders)
    if isinstance(model, ForestModel):
        scored = probabilities(model, priced, "late_probability")
        likely = (F.col("late_probability") > 0.5).cast("int")
        return scored.select(*priced.columns, likely.alias("prediction"), "late_probability")
    return model.transform(priced).select(
        *priced.columns,
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias("late_probability"),
    )


def advise(scored: DataFrame) -> DataFrame:
    """Add title, level, advice and probability text to scored orders."""
    prediction = F.col("prediction")
    return scored.withColumns(
        {
            "title": D.risk_title(prediction),
            "level": F.when(prediction == 1, "danger").otherwise("success"),
            "advice": D.risk_advice(prediction),
            "probability_text": D.probability_text(F.col("late_probability")),
        }
    )


def preparation_of(model: Model) -> PipelineModel:
    """The stages before the classifier."""
    return model.preparation if isinstance(model, ForestModel) else PipelineModel(model.stages[:-1])


def save_model(model: Model, path: str) -> None:
    """Store a model with a word on its kind; a forest is stored as a table of nodes."""
    if isinstance(model, ForestModel):
        kind, spark = "forest", model.nodes.sparkSession
        model.save(f"{path}/model")
    else:
        kind, spark = "pipeline", SparkSession.active()
        model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(kind,)], "kind string").coalesce(1).write.mode("overwrite").text(f"{path}/kind")


def load_model(path: str) -> Model:
    spark = SparkSession.active()
    if spark.read.text(f"{path}/kind").first()[0] == "forest":
        return ForestModel.load(spark, f"{path}/model")
    return PipelineModel.load(f"{path}/model")
