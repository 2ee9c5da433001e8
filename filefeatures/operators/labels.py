"""Category labels ranked by frequency, and the compact one-hot text `n|idx|1.0` built from them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from filefeatures.operators.lookup import HOT_MIN_ROWS, HOT_SHARE, hot_keys, hot_part, key_part, lookup
from filefeatures.operators.select import quoted
from filefeatures.session import stage

# Distinct labels up to this number are ranked by one window; more are ranked range by range.
ONE_WINDOW_LABELS = 1_000_000
# Label tables up to this number of rows are broadcast whole. Join keys have a bounded width
# (key_part), so this is also a bound in bytes (about 25 MB with two key parts).
BROADCAST_LABELS = 100_000


@dataclass(frozen=True)
class LabelModel:
    """Ranked labels: group columns, `label`, `idx` (0 = most frequent, NULL for NULL), `n`, `rows`."""

    table: DataFrame
    groups: tuple[str, ...]
    table_rows: int
    labels: int
    fact_rows: int

    def save(self, folder: str) -> LabelModel:
        """Write the labels as parquet and go on with the written copy."""
        self.table.write.mode("overwrite").parquet(folder)
        return load_labels(self.table.sparkSession, folder, groups=self.groups)


def load_labels(spark: SparkSession, folder: str, *, groups: Sequence[str] = ()) -> LabelModel:
    return _measured(spark.read.parquet(folder), groups)


def _measured(table: DataFrame, groups: Sequence[str]) -> LabelModel:
    size = table.agg(
        F.count(F.lit(1)).alias("table_rows"), F.count("label").alias("labels"), F.sum("rows").alias("rows")
    ).first()
    return LabelModel(table, tuple(groups), size.table_rows, size.labels, size.rows or 0)


def fit_labels(
    df: DataFrame,
    column: str,
    *,
    groups: Sequence[str] = (),
    one_window_labels: int = ONE_WINDOW_LABELS,
) -> LabelModel:
    """Rank the column's labels by falling frequency, ties by label, within each group.

    The input is read once: its label counts (pre-aggregated before the shuffle) are written to the
    shared scratch folder, and everything after that works on one row per distinct label.
    """
    label = F.col(quoted(column)).cast("string").alias("label")
    group_columns = [F.col(quoted(name)) for name in groups]
    if {"label", "rows", "idx", "n", "part"} & {name.lower() for name in groups}:
        raise ValueError(f"rename the group columns {list(groups)}: label, rows, idx, n and part are columns of the result")
    counts = df.groupBy(*group_columns, label).agg(F.count(F.lit(1)).alias("rows"))
    size = _measured(stage(counts, "labels"), groups)
    table = rank_counts(size.table, groups, size.table_rows, one_window_labels=one_window_labels)
    return LabelModel(table, size.groups, size.table_rows, size.labels, size.fact_rows)


def rank_counts(
    counts: DataFrame, groups: Sequence[str], table_rows: int, *, one_window_labels: int = ONE_WINDOW_LABELS
) -> DataFrame:
    """Label counts with `idx` and `n`: few labels are ranked in one window, more in ranges."""
    if table_rows <= one_window_labels:
        return _rank_in_one_window(counts, groups)
    return _rank_by_ranges(counts, groups, -(-table_rows // one_window_labels))


def _falling_frequency() -> list[Column]:
    return [F.col("label").isNull(), F.col("rows").desc(), F.col("label")]


def _rank_in_one_window(counts: DataFrame, groups: Sequence[str]) -> DataFrame:
    groups = [F.col(quoted(name)) for name in groups]
    group = Window.partitionBy(*groups)
    position = F.row_number().over(group.orderBy(*_falling_frequency())) - 1
    return counts.select(
        *groups,
        "label",
        F.when(F.col("label").isNotNull(), position).alias("idx"),
        F.count("label").over(group).alias("n"),
        "rows",
    )


def _rank_by_ranges(counts: DataFrame, groups: Sequence[str], ranges: int) -> DataFrame:
    """Sort into ranges of labels, rank inside each range, add what the ranges before hold.

    The ranges are written with their number before it is used: range bounds come from a sample and
    could differ if they were computed twice.
    """
    columns = [F.col(quoted(name)) for name in groups]
    order = [*columns, *_falling_frequency()]
    ranged = stage(
        counts.repartitionByRange(ranges, *order).withColumn("part", F.spark_partition_id()), "label-ranges"
    )
    group_keys = [f"_g{i}" for i in range(len(groups))]
    ranged = ranged.withColumns({key: key_part(column) for key, column in zip(group_keys, columns)})

    # One row per (group, range): ranges are contiguous, so there are at most groups + ranges of them,
    # and a single group has at most one per range.
    spans = ranged.groupBy(*group_keys, "part").agg(F.count("label").alias("_labels"))
    group = Window.partitionBy(*group_keys)
    before = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        *group_keys,
        "part",
        F.coalesce(F.sum("_labels").over(before), F.lit(0)).alias("_before"),
        F.sum("_labels").over(group).alias("n"),
    )
    inside = Window.partitionBy(*group_keys, "part").orderBy(*_falling_frequency())
    position = F.col("_before") + F.col("_position") - 1
    ranked = ranged.withColumn("_position", F.row_number().over(inside)).join(spans, [*group_keys, "part"])
    index = F.when(F.col("label").isNotNull(), position.cast("int")).alias("idx")
    return stage(ranked.select(*columns, "label", index, "n", "rows"), "ranked-labels")


def one_hot_text(n: Column, idx: Column) -> Column:
    """`n|idx|1.0`, or `n|null|null` when there is no index."""
    return F.concat_ws(
        "|",
        n.cast("string"),
        F.coalesce(idx.cast("string"), F.lit("null")),
        F.when(idx.isNotNull(), "1.0").otherwise("null"),
    )


def register_one_hot_text(spark: SparkSession, name: str = "one_hot_text") -> None:
    """Make the text form callable by name, in SQL and with `call_function`; it is inlined into the plan."""
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION {quoted(name)}(n BIGINT, idx INT) RETURNS STRING
        RETURN concat_ws('|', CAST(n AS STRING), coalesce(CAST(idx AS STRING), 'null'),
                         CASE WHEN idx IS NOT NULL THEN '1.0' ELSE 'null' END)"""
    )


def with_label_index(
    df: DataFrame,
    model: LabelModel,
    column: str,
    *,
    index: str = "_idx",
    size: str = "_n",
    fitted_here: bool = False,
    broadcast_labels: int = BROADCAST_LABELS,
    hot_share: float = HOT_SHARE,
    hot_min_rows: int = HOT_MIN_ROWS,
) -> DataFrame:
    """Add each row's label index (NULL for a NULL or unseen label) and the number of labels.

    A label table of bounded size is broadcast, so the rows are not shuffled. With a larger one only the
    rows of rare labels are shuffled. `fitted_here` says that the model was fitted on these rows, so its
    counts tell the hot labels; other rows are counted first, as their hot label may be an unseen one.
    A model with groups belongs to the rows it was fitted on.
    """
    sources = [*model.groups, column]
    keys = [f"_k{i}" for i in range(len(sources))]
    fact = df.withColumns({key: key_part(F.col(quoted(name))) for key, name in zip(keys, sources)})
    dim = model.table.select(
        *[key_part(F.col(quoted(name))).alias(key) for key, name in zip(keys, [*model.groups, "label"])],
        F.col("idx").alias(index),
        *([F.col("n").alias(size)] if model.groups else []),
        F.col("rows").alias("_rows"),
    )
    if model.table_rows <= broadcast_labels:
        joined = fact.join(F.broadcast(dim.drop("_rows")), keys, "left")
    else:
        if fitted_here:
            hot = dim.where(F.col("_rows") >= model.fact_rows * hot_share)
        else:
            keyed = hot_keys(fact, keys, min_rows=hot_min_rows, share=hot_share)
            hot = hot_part(dim, keyed, keys) if keyed is not None else None
        joined = lookup(fact, dim.drop("_rows"), keys, hot)
    joined = joined.drop(*keys)
    if not model.groups:
        joined = joined.withColumn(size, F.lit(model.labels).cast("bigint"))
    return joined


def encode(df: DataFrame, model: LabelModel, column: str, out: str, **limits: object) -> DataFrame:
    """Add the one-hot text of a category column."""
    indexed = with_label_index(df, model, column, **limits)
    return indexed.withColumn(out, one_hot_text(F.col("_n"), F.col("_idx"))).drop("_idx", "_n")


def fit_and_encode(
    df: DataFrame,
    column: str,
    out: str,
    *,
    groups: Sequence[str] = (),
    one_window_labels: int = ONE_WINDOW_LABELS,
    **limits: object,
):
    """Fit on these rows and encode the same rows; with `groups`, each group has labels of its own."""
    model = fit_labels(df, column, groups=groups, one_window_labels=one_window_labels)
    return encode(df, model, column, out, fitted_here=True, **limits)
