"""A linear model of numbers and one constant per category, for any number of categories.

The constants are absorbed: what is left of a number and of the target after taking off their category's means gives the
slopes, from normal equations as small as the list of numbers; a category's constant then is what its mean still needs.
That is the least-squares fit of a model with one indicator per category, without ever making the indicators. Means and
co-moments come from one aggregation by category and one over the categories; the constants stay a table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filefeatures.operators.labels import BROADCAST_LABELS, LabelModel, with_label_index
from filefeatures.operators.lookup import HOT_MIN_ROWS, HOT_SHARE, hot_keys, hot_part, key_part, lookup
from filefeatures.operators.scoring import as_numbers, number
from filefeatures.operators.select import quoted
from filefeatures.session import stage

OWN = "_category"  # NULL for the category that stands for NULL and unknown ones


@dataclass(frozen=True)
class EffectsModel:
    """Slopes by number, `constants` (category, constant, rows), and the constant of NULL and of unknown categories."""

    category: str
    slopes: dict[str, float]
    constants: DataFrame
    categories: int
    other: float

    def save(self, folder: str) -> EffectsModel:
        spark = self.constants.sparkSession
        self.constants.write.mode("overwrite").parquet(f"{folder}/constants")
        facts = [(self.category, list(self.slopes), list(self.slopes.values()), self.categories, self.other)]
        schema = "category string, numbers array<string>, slopes array<double>, categories long, other double"
        spark.createDataFrame(facts, schema).coalesce(1).write.mode("overwrite").parquet(f"{folder}/slopes")
        return load_effects(spark, folder)


def load_effects(spark: SparkSession, folder: str) -> EffectsModel:
    facts = spark.read.parquet(f"{folder}/slopes").first()
    slopes = dict(zip(facts.numbers, facts.slopes, strict=True))
    return EffectsModel(facts.category, slopes, spark.read.parquet(f"{folder}/constants"), facts.categories, facts.other)


def _moments(columns: Sequence[str]) -> list[Column]:
    """Of one category: rows, means, and the sums of products of what deviates from the means."""
    rows = F.count(F.lit(1))
    means = [F.avg(quoted(name)).alias(f"mean{i}") for i, name in enumerate(columns)]
    products = [
        (F.covar_pop(quoted(columns[i]), quoted(columns[j])) * rows).alias(f"product{i}_{j}") for i, j in _pairs(len(columns))
    ]
    return [rows.alias("rows"), *means, *products]


def _pairs(size: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(size) for j in range(i, size)]


def train_effects(
    df: DataFrame,
    target: str,
    numeric: Sequence[str],
    category: str,
    *,
    labels: LabelModel | None = None,
    reg_param: float = 0.0,
) -> EffectsModel:
    """Fit on the rows that have the target and all numbers.

    NULL is a category of its own, and with `labels`, labels that these do not have belong to it; a row whose category has
    no constant gets its constant. Where no training row is of that kind, it gets the mean constant of all training rows.
    A number that does not vary within any category has a slope of zero, and of numbers that go together in all of them the
    fit has the smallest slopes. `reg_param` draws slopes towards zero, each measured by its number's standard deviation
    inside the categories. Text that is no number becomes NULL. No row to train on is a ValueError. The driver gets one row
    of sums, whatever the number of categories.
    """
    inputs = [number(name) for name in (*numeric, target)]
    known = as_numbers(df, [*numeric, target]).dropna(subset=inputs)
    label = F.col(quoted(category)).cast("string")
    if labels is not None:
        known = with_label_index(known, labels, category)
        label = F.when(F.col("_idx").isNotNull(), label)
    cells = stage(known.groupBy(label.alias(OWN)).agg(*_moments(inputs)), "category-moments")

    size, pairs = len(numeric), _pairs(len(inputs))
    sums = cells.agg(
        F.sum("rows").alias("rows"),
        F.count(OWN).alias("categories"),
        *[F.sum(F.col("rows") * F.col(f"mean{i}")).alias(f"total{i}") for i in range(size + 1)],
        *[F.sum(f"product{i}_{j}").alias(f"product{i}_{j}") for i, j in pairs],
    ).first()
    if not sums["rows"]:
        raise ValueError(f"no row has {target} and all of {list(numeric)}")
    inside = np.zeros((size + 1, size + 1))
    for i, j in pairs:
        inside[i, j] = inside[j, i] = sums[f"product{i}_{j}"]
    slopes = _solved(inside[:size, :size], inside[:size, size], reg_param)

    constant = F.col(f"mean{size}")
    for i, slope in enumerate(slopes):
        constant = constant - F.lit(float(slope)) * F.col(f"mean{i}")
    constants = cells.select(F.col(OWN).alias("category"), constant.alias("constant"), "rows")
    other = constants.where("category IS NULL").select("constant").first()
    overall = (sums[f"total{size}"] - sum(float(s) * sums[f"total{i}"] for i, s in enumerate(slopes))) / sums["rows"]
    constants = constants.where("category IS NOT NULL")
    named = dict(zip(numeric, map(float, slopes), strict=True))
    return EffectsModel(category, named, constants, sums["categories"], other[0] if other else overall)


def _solved(products: np.ndarray, with_target: np.ndarray, reg_param: float) -> np.ndarray:
    """Slopes from the sums of products inside the categories, in units of the numbers' own spread."""
    spread = np.sqrt(np.diag(products))
    unit = np.divide(1.0, spread, out=np.zeros_like(spread), where=spread > 0)
    scaled = products * np.outer(unit, unit) + reg_param * np.diag((spread > 0).astype(float))
    return np.linalg.lstsq(scaled, with_target * unit, rcond=1e-10)[0] * unit


def score_effects(
    df: DataFrame,
    model: EffectsModel,
    out: str = "prediction",
    *,
    broadcast_labels: int = BROADCAST_LABELS,
    hot_share: float = HOT_SHARE,
    hot_min_rows: int = HOT_MIN_ROWS,
) -> DataFrame:
    """Add the prediction; every row and column stays, and a row that lacks a number has no prediction.

    A table of constants of bounded size is broadcast; a larger one is joined so that no category's rows meet in one task.
    """
    names = list(model.slopes)
    fact = as_numbers(df, names).withColumn("_key", key_part(F.col(quoted(model.category))))
    dim = model.constants.select(key_part(F.col("category")).alias("_key"), F.col("constant").alias("_constant"))
    if model.categories <= broadcast_labels:
        joined = fact.join(F.broadcast(dim), "_key", "left")
    else:
        hot = hot_keys(fact, ["_key"], min_rows=hot_min_rows, share=hot_share)
        joined = lookup(fact, dim, ["_key"], hot_part(dim, hot, ["_key"]) if hot is not None else None)
    terms = [F.coalesce("_constant", F.lit(model.other))]
    terms += [F.lit(slope) * F.col(quoted(number(name))) for name, slope in model.slopes.items()]
    prediction = reduce(lambda left, right: left + right, terms)
    return joined.withColumn(out, prediction).drop("_key", "_constant", *[number(name) for name in names])
