"""Predictions: a constant, a linear formula, or a stored ML pipeline; and fitting such a pipeline."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filefeatures.operators.select import quoted


def score_constant(df: DataFrame, value: str = "predicted", out: str = "prediction") -> DataFrame:
    return df.withColumn(out, F.lit(value))


def score_linear(df: DataFrame, weights: Mapping[str, float], intercept: float, out: str = "prediction"):
    """intercept + weight * column + ..., added from left to right; NULL when a column is NULL."""
    terms = [F.col(quoted(name)).cast("double") * F.lit(float(weight)) for name, weight in weights.items()]
    return df.withColumn(out, reduce(lambda left, right: left + right, terms, F.lit(float(intercept))))


def as_numbers(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Add columns as doubles under the names a model takes; text that is no number becomes NULL."""
    return df.withColumns({number(name): F.col(quoted(name)).try_cast("double") for name in names})


def number(name: str) -> str:
    return f"_number:{name}"


def train_linear(
    df: DataFrame,
    target: str,
    numeric: Sequence[str],
    *,
    reg_param: float = 0.0,
) -> PipelineModel:
    """Fit a linear model on the rows that have the target and all numbers. With a category, see `operators.effects`."""
    known = as_numbers(df, [target, *numeric]).dropna(subset=[number(name) for name in (target, *numeric)])
    inputs = [number(name) for name in numeric]
    stages = [
        VectorAssembler(inputCols=inputs, outputCol="_features", handleInvalid="keep"),
        LinearRegression(featuresCol="_features", labelCol=number(target), regParam=reg_param),
    ]
    return Pipeline(stages=stages).fit(known)


def score_model(df: DataFrame, model: PipelineModel | str, numeric: Sequence[str]) -> DataFrame:
    """Add the `prediction` of a fitted pipeline, or of one stored at a path; all other columns stay as they are.

    Every row stays; one that lacks a number has no prediction.
    """
    fitted = PipelineModel.load(model) if isinstance(model, str) else model
    numbers = [F.col(quoted(number(name))) for name in numeric]
    complete = reduce(lambda left, right: left & right, [n.isNotNull() for n in numbers], F.lit(True))
    scored = fitted.transform(as_numbers(df, numeric)).withColumn("prediction", F.when(complete, F.col("prediction")))
    return scored.drop("_features", *[number(name) for name in numeric])
