"""Bring predictions back to their features, and compare what came in with what went out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filefeatures.operators.select import quoted


def join_predictions(features: DataFrame, predictions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Features with their prediction, NULL when there is none. Keys that occur twice among the predictions are an
    error, found by one count per key; a row of features without a key has no prediction."""
    require_unique(predictions, keys)
    return features.join(predictions, list(keys), "left")


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise when rows share a key; the error names some of them."""
    names = [F.col(quoted(key)) for key in keys]
    repeated = df.groupBy(*names).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").limit(5).collect()
    repeated = [tuple(row)[:-1] for row in repeated if None not in tuple(row)]
    if repeated:
        raise ValueError(f"more than one row for {list(keys)} = {repeated}")


def reconcile(incoming: DataFrame, outgoing: DataFrame, name: str = "file_name") -> DataFrame:
    """One row per file name: DONE (in and out), MISSING (no output yet) or STRAY (output without input).

    Counting a union instead of joining combines repeated names before the shuffle.
    """
    seen = incoming.select(name, F.lit(1).alias("i"), F.lit(0).alias("o")).unionAll(
        outgoing.select(name, F.lit(0).alias("i"), F.lit(1).alias("o"))
    )
    state = F.when(F.col("i") + F.col("o") == 2, "DONE").when(F.col("i") == 1, "MISSING").otherwise("STRAY")
    return seen.groupBy(name).agg(F.max("i").alias("i"), F.max("o").alias("o")).select(name, state.alias("state"))
