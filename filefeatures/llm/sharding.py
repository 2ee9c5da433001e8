"""Shards of bounded size by extendible hashing, in DataFrame operations alone.

The directory is indexed by the leading bits of a document's hash. A bucket that is over the byte limit is split on its
next bit, and only such a bucket, until each one fits. What decides is the sum of bytes below every prefix, so the
directory follows from sums by prefix: a bucket is a shard if it fits and the bucket one bit shorter does not.

The sums are taken over cells, the prefixes some bits finer than an even distribution needs. Cells that are still too
large, as one with a very large document in it can be, are divided again in the same way, from their documents alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filefeatures.llm.arrow import text_or_empty, unused
from filefeatures.session import stage

LIMIT_BYTES = 64 << 20
HASH_BITS = 60
SPARE_BITS = 4


def document_hash(doc_id: Column, text: Column) -> Column:
    """60 bits of the id; rows without one are told apart by their text."""
    key = F.coalesce(doc_id.cast("string"), F.concat(F.lit("text:"), text))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def _prefix(depth: int) -> Column:
    return F.shiftright("hash", HASH_BITS - depth)


def _leaves(sized: DataFrame, done: int, depth: int, limit: int) -> DataFrame:
    """The shards at done..depth bits: (cell, shard_depth, shard_prefix, shard_bytes, shard_documents), one row per cell."""
    cells = sized.groupBy(_prefix(depth).alias("cell")).agg(
        F.sum("bytes").alias("bytes"), F.count("*").alias("documents"), F.min("hash").alias("low"), F.max("hash").alias("high")
    )
    levels = cells.withColumn("shard_depth", F.explode(F.sequence(F.lit(done), F.lit(depth)))).withColumn(
        "shard_prefix", F.expr(f"shiftright(cell, {depth} - shard_depth)")
    )
    buckets = levels.groupBy("shard_depth", "shard_prefix").agg(
        F.sum("bytes").alias("bytes"), F.sum("documents").alias("documents"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    # A bucket whose rows all have one hash cannot be split and is a shard whatever its size.
    buckets = buckets.withColumn("fits", (F.col("bytes") <= limit) | (F.col("low") == F.col("high")))
    kids = F.collect_list(F.struct("shard_depth", "shard_prefix", "bytes", "documents", "fits"))  # two at most
    parents = buckets.groupBy((F.col("shard_depth") - 1).alias("up"), F.expr(f"if(shard_depth = {done}, shard_prefix, shiftright(shard_prefix, 1))").alias("parent")).agg(
        kids.alias("kids"), F.sum("bytes").alias("both"), (F.min("low") == F.max("high")).alias("single")
    )
    split = (F.col("up") < done) | ((F.col("both") > limit) & ~F.col("single"))
    shards = parents.where(split).select(F.explode("kids").alias("kid")).select("kid.*").where("fits").drop("fits")
    shards = shards.withColumnsRenamed({"bytes": "shard_bytes", "documents": "shard_documents"})
    cells_of = F.sequence(
        F.expr(f"shiftleft(shard_prefix, {depth} - shard_depth)"), F.expr(f"shiftleft(shard_prefix + 1, {depth} - shard_depth) - 1")
    )
    return shards.withColumn("cell", F.explode(cells_of))


def _placed(docs: DataFrame, limit: int) -> DataFrame:
    text = text_or_empty(docs)
    doc_id = docs["doc_id"].cast("long")
    sized = docs.select(
        doc_id.alias("doc_id"), document_hash(doc_id, text).alias("hash"), F.octet_length(text).cast("long").alias("bytes")
    )
    sized = stage(sized, "sized")
    total, done, parts = sized.agg(F.sum("bytes")).first()[0] or 0, 0, []
    depth = min(HASH_BITS, max(0, math.ceil(math.log2(max(1.0, total / limit)))) + SPARE_BITS)
    while True:
        leaves = stage(_leaves(sized, done, depth, limit), "shards")
        placed = sized.withColumn("cell", _prefix(depth)).join(leaves, "cell", "left").drop("cell")
        parts.append(placed.where("shard_depth IS NOT NULL"))
        missing = placed.where("shard_depth IS NULL").select("doc_id", "hash", "bytes")
        if depth == HASH_BITS or missing.isEmpty():
            break
        sized, done, depth = stage(missing, "oversized"), depth + 1, min(HASH_BITS, depth + 8)
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    bits = F.when(F.col("shard_depth") == 0, F.lit("")).otherwise(F.expr("lpad(bin(shard_prefix), shard_depth, '0')"))
    return result.withColumns({"shard": bits, "depth": F.col("shard_depth").cast("int")})


def shard(docs: DataFrame, *, limit: int = LIMIT_BYTES) -> DataFrame:
    """Per row: doc_id, shard (its bits as text, empty for a single shard), depth, shard_bytes, shard_documents.

    A document has the bytes of its text in UTF-8; NULL text has none. Rows with the same doc_id go to the same shard; a
    NULL doc_id is replaced by the text. A single document over the limit, or rows that share one doc_id and together are
    over it, make a shard of their own, recognised by shard_bytes > limit. An empty table gives no rows. Other columns
    than doc_id and text are not read.
    """
    return _placed(docs, limit).select("doc_id", "shard", "depth", "shard_bytes", "shard_documents")


def write_shards(docs: DataFrame, folder: str, *, limit: int = LIMIT_BYTES) -> None:
    """The documents with all their columns, one folder __shard=<bits> per shard; a shard is written by one task. Where the
    documents have a column of that name, the folders' name is longer by an underscore."""
    name, own = unused(docs, "__shard"), unused(docs, "__hash")
    shard_of = _placed(docs, limit).select(F.col("hash").alias(own), F.concat(F.lit("b"), "shard").alias(name)).distinct()
    key = document_hash(docs["doc_id"].cast("long"), text_or_empty(docs))
    rows = docs.withColumn(own, key).join(shard_of, own).drop(own)
    rows.repartition(name).sortWithinPartitions(name).write.partitionBy(name).parquet(folder)
