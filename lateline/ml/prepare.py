"""Feature preparation: impute, scale, one-hot encode and assemble, as persistable stages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateline.operators.ranks import exact_medians
from lateline.schema import CATEGORICAL_FEATURES, NUMERIC_FEATURES, UNKNOWN

FEATURE_VECTOR = "features"


@dataclass(frozen=True)
class NumberScale:
    """What is learned of a numeric feature: its median, and mean and deviation once imputed."""

    feature: str
    median: float
    mean: float
    deviation: float


def learn_scales(train: DataFrame, features: list[str] = NUMERIC_FEATURES) -> list[NumberScale]:
    """Exact medians, then means and population deviations of the imputed features."""
    medians = exact_medians(train, features)
    if empty := [name for name, median in medians.items() if median is None]:
        raise ValueError(f"no values to learn from: {', '.join(empty)}")
    imputed = {name: F.expr(_imputed_sql(name, medians[name])) for name in features}
    row = train.agg(
        *[F.avg(value).alias(f"{name}_mean") for name, value in imputed.items()],
        *[F.stddev_pop(value).alias(f"{name}_sd") for name, value in imputed.items()],
    ).first()
    return [NumberScale(name, medians[name], row[f"{name}_mean"], row[f"{name}_sd"] or 1.0) for name in features]


def _double_sql(value: float) -> str:
    """A literal that can hold every double."""
    return f"cast('{value!r}' as double)"


def _imputed_sql(feature: str, median: float) -> str:
    """The number, or the median where it is missing, NaN or infinite; learned from and applied alike."""
    value = f"cast(`{feature}` as double)"
    return f"if(abs({value}) < double('Infinity'), {value}, {_double_sql(median)})"


def _number_sql(scale: NumberScale) -> str:
    imputed = _imputed_sql(scale.feature, scale.median)
    return f"({imputed} - {_double_sql(scale.mean)}) / {_double_sql(scale.deviation)} as `num__{scale.feature}`"


def _text_sql(feature: str) -> str:
    return f"coalesce(cast(`{feature}` as string), '{UNKNOWN}') as `text__{feature}`"


def cleaning_stage(scales: list[NumberScale], texts: list[str]) -> SQLTransformer:
    """Imputed and standardised numbers, imputed texts; the learned values are part of the stage."""
    added = [_number_sql(scale) for scale in scales] + [_text_sql(name) for name in texts]
    return SQLTransformer(statement=f"select *, {', '.join(added)} from __THIS__")


def fit_preparation(
    train: DataFrame,
    numbers: list[str] = NUMERIC_FEATURES,
    texts: list[str] = CATEGORICAL_FEATURES,
) -> PipelineModel:
    """Learn the preparation. A level not seen in training becomes all zeros in its one-hot block."""
    scales = learn_scales(train, numbers)
    indexer = StringIndexer(
        inputCols=[f"text__{name}" for name in texts],
        outputCols=[f"index__{name}" for name in texts],
        handleInvalid="keep",
        stringOrderType="alphabetAsc",
    )
    # The indexer's extra last index stands for unseen levels, and is the one dropped here.
    encoder = OneHotEncoder(
        inputCols=[f"index__{name}" for name in texts],
        outputCols=[f"cat__{name}" for name in texts],
        dropLast=True,
    )
    assembler = VectorAssembler(
        inputCols=[f"num__{name}" for name in numbers] + [f"cat__{name}" for name in texts],
        outputCol=FEATURE_VECTOR,
    )
    return Pipeline(stages=[cleaning_stage(scales, texts), indexer, encoder, assembler]).fit(train)


def level_lists(preparation: PipelineModel) -> dict[str, list[str]]:
    """Levels of every categorical feature in slot order."""
    indexer = preparation.stages[1]
    names = [name.removeprefix("text__") for name in indexer.getInputCols()]
    return {name: list(levels) for name, levels in zip(names, indexer.labelsArray)}


def feature_names(preparation: PipelineModel) -> list[str]:
    """Name of every slot of the feature vector."""
    numbers = [name for name in preparation.stages[3].getInputCols() if name.startswith("num__")]
    slots = [f"cat__{name}_{level}" for name, levels in level_lists(preparation).items() for level in levels]
    return numbers + slots


def onehot_levels(preparation: PipelineModel, session) -> DataFrame:
    """``(feature, level, slot)`` of all one-hot levels."""
    rows = [
        (name, level, slot)
        for name, levels in level_lists(preparation).items()
        for slot, level in enumerate(levels)
    ]
    return session.createDataFrame(rows, "feature string, level string, slot int")
