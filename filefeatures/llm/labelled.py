"""The labelled rows that a model is fitted on: a bounded, documented sample, the same in every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_LABELLED = 20_000
FOLDS, HELD_OUT_FOLD = 4, 2


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text leaves 2 modulo 4; rows without an id are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT_FOLD, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, limit: int = MAX_LABELLED) -> DataFrame:
    """(label, text) of up to `limit` labelled documents outside the held-out fold: those with the smallest hash of their id.

    An id gives one text, however many rows repeat it: the one with the smallest hash. Labels that are NULL or contradict each other in equal numbers do not count. The sample of ids is at most `limit`
    rows of two numbers, so it may be broadcast whatever the size of the tables.
    """
    doc_id = F.col("doc_id").cast("long")
    mean = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy(doc_id.alias("id")).agg(F.avg(label).alias("mean"))
    chosen = mean.where((F.col("mean") != 0.5) & ~held_out(F.col("id"))).orderBy(F.xxhash64("id"), "id").limit(limit)
    chosen = chosen.select(F.col("id").alias("doc_id"), (F.col("mean") > 0.5).cast("int").alias("label"))
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    of_ids = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label")
    return of_ids.agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")).select("label", "text")
