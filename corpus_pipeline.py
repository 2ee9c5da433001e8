"""A training-corpus pipeline: quality, toxicity, exact copies, near copies, packing. Each stage calls one operator.

Every stage works on all that the one before it kept, written as Parquet and read again; all but the last return the
columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from filefeatures.llm import quality, toxicity
from filefeatures.llm.arrow import bound_batches
from filefeatures.llm.exact_dedup import keep_first
from filefeatures.llm.near_dedup import keep_one
from filefeatures.llm.packing import pack
from filefeatures.session import stage


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below its threshold go. It is fitted on labelled documents of the whole table.

    NULL and empty texts are scored as empty; rows that repeat an id, or have none, are each judged by their text. Without
    both labels, and for an empty table, nothing goes.
    """
    bound_batches(spark)
    return quality.keep_good(docs, quality.train(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are likelier toxic than not go. NULL and empty texts have no words and stay; repeated rows and ids are
    each judged by their text. Without both labels, and for an empty table, nothing goes."""
    bound_batches(spark)
    return toxicity.keep_clean(docs, toxicity.train(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id stays, of rows that repeat it the first. All NULL and empty texts are
    one group; a NULL doc_id is smaller than any other. An empty table stays one."""
    bound_batches(spark)
    return keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five words a shingle, similarity 0.8) the one with the smallest doc_id stays, of rows
    that repeat it the first, and a NULL doc_id only where there is no other. Texts without words are near no other and stay.
    An empty table stays one."""
    bound_batches(spark)
    return keep_one(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of at most 2048 tokens, one row a piece. A NULL or empty text is its end token
    alone; repeated rows and ids are packed each by itself. An empty table gives no rows."""
    bound_batches(spark)
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", drop_low_quality),
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("packing", pack_sequences),
]
# Trained models and a tokenizer decide, which SQL cannot express; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


def queries():
    return {"pipeline": run}


def oracle_sql():
    return {}
