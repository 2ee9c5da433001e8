"""Types of text columns that lose nothing: a column has a type only if every text of it prints back to itself.

The types form a lattice: whole numbers of 32 and 64 bits, decimals of one scale, doubles, booleans, dates and timestamps,
with text above all. What is measured of a column is a handful of flags and extremes, which are combined before the
shuffle, and measurements of files or batches merge by the same aggregation.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filefeatures.operators.select import quoted

MEASURES = {
    "texts": F.sum,
    "whole": F.bool_and,
    "low": F.min,
    "high": F.max,
    "fixed": F.bool_and,
    "least_scale": F.min,
    "most_scale": F.max,
    "most_digits": F.max,
    "real": F.bool_and,
    "truth": F.bool_and,
    "day": F.bool_and,
    "moment": F.bool_and,
}
INT_RANGE = (-(1 << 31), (1 << 31) - 1)
FIXED = r"^-?(?:0|[1-9][0-9]*)\.[0-9]+\z"


def _prints_back(text: Column, kind: str) -> Column:
    return F.coalesce(text.try_cast(kind).cast("string") == text, F.lit(False))


def _measured(text: Column) -> dict[str, Column]:
    """What one text says; NULL says nothing."""
    known = text.isNotNull()
    # What a text begins with rules most types out, which is cheaper than a cast that fails.
    first = F.substring(text, 1, 1)
    digit = first.isin("-", *"0123456789")
    number = F.when(digit, text.try_cast("bigint"))
    whole = digit & _prints_back(text, "bigint")
    fixed = digit & text.rlike(FIXED)
    point = F.locate(".", text)
    return {
        "texts": F.when(known, 1).otherwise(0).cast("long"),
        "whole": F.when(known, whole),
        "low": F.when(whole, number),
        "high": F.when(whole, number),
        # -0.00 is a decimal that would come back as 0.00
        "fixed": F.when(known, fixed & ~text.rlike(r"^-[0.]+\z")),
        "least_scale": F.when(fixed, F.length(text) - point),
        "most_scale": F.when(fixed, F.length(text) - point),
        "most_digits": F.when(fixed, F.length(F.regexp_replace(text, "[-.]", ""))),
        "real": F.when(known, (digit | text.isin("NaN", "Infinity")) & _prints_back(text, "double")),
        "truth": F.when(known, text.isin("true", "false")),
        "day": F.when(known, digit & _prints_back(text, "date")),
        "moment": F.when(known, digit & _prints_back(text, "timestamp_ntz")),
    }


def measure_types(df: DataFrame, columns: Sequence[str] | None = None, *, by: Sequence[str] = ()) -> DataFrame:
    """One row per text column (and group of `by`): what its texts have in common. The rows are read once.

    A column without any text has a row too, if the table has rows.
    """
    names = [name for name in (df.columns if columns is None else columns) if name not in by]
    pairs = F.array(*[F.struct(F.lit(name).alias("column"), F.col(quoted(name)).cast("string").alias("text")) for name in names])
    texts = df.select(*[F.col(quoted(name)) for name in by], F.explode(pairs).alias("pair")).select(*by, "pair.*")
    measured = texts.select(*by, "column", *[value.alias(name) for name, value in _measured(F.col("text")).items()])
    return merge_types(measured, by=by)


def merge_types(measured: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """Measurements of parts of a table (files, batches), put together; without `by`, of the whole."""
    return measured.groupBy(*by, "column").agg(*[combine(name).alias(name) for name, combine in MEASURES.items()])


def chosen_type(measured) -> str:
    """The narrowest type that a measurement allows."""
    if not measured["texts"]:
        return "string"
    if measured["whole"]:
        return "int" if INT_RANGE[0] <= measured["low"] and measured["high"] <= INT_RANGE[1] else "bigint"
    if measured["real"]:
        return "double"
    if measured["fixed"] and measured["least_scale"] == measured["most_scale"] and measured["most_digits"] <= 38:
        return f"decimal({measured['most_digits']},{measured['most_scale']})"
    for flag, kind in (("truth", "boolean"), ("day", "date"), ("moment", "timestamp_ntz")):
        if measured[flag]:
            return kind
    return "string"


def typed(df: DataFrame, *, keep_text: Iterable[str] = (), measured: DataFrame | None = None) -> DataFrame:
    """A table of texts with each column in the type that it has; `measured` may come from `merge_types`.

    One row per column comes to the driver.
    """
    text = {name.lower() for name in keep_text}
    rows = (measure_types(df) if measured is None else measured).collect()
    kinds = {row["column"]: chosen_type(row) for row in rows if row["column"].lower() not in text}
    return df.select(*[F.col(quoted(name)).cast(kinds.get(name, "string")).alias(name) for name in df.columns])
