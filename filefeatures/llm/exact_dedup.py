"""Exact duplicates by deterministic block naming.

A text is cut into blocks of a fixed size. Equal blocks get the same integer name and different ones different names:
blocks are sorted, and names are handed out along the sorted order. Then neighbouring names are paired and the pairs are
named in the same way, until one name is left of each text. Names are compared by content at every level, never by a
hash, so two texts end with the same name on the same level exactly if they are equal.

Block content is shuffled once. Each task first brings its equal blocks together, so a block that a third of all texts
hold reaches the sorting task once per input task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filefeatures.llm.arrow import ROW, as_bytes, ascii_lower, numbered, slices, text_or_empty, unused
from filefeatures.operators.select import quoted
from filefeatures.session import stage

BLOCK_BYTES = 4096

USE = T.StructType(
    [
        T.StructField("row", T.LongType()),
        T.StructField("position", T.IntegerType()),
        T.StructField("blocks", T.IntegerType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("text_sha256", T.StringType()),
    ]
)
BLOCK_SCHEMA = T.StructType([T.StructField("block", T.BinaryType()), T.StructField("uses", T.ArrayType(USE))])
NAME_SCHEMA = T.StructType([T.StructField("name", T.LongType()), *USE.fields])
ARROW_USE = pa.struct([("row", pa.int64()), ("position", pa.int32()), ("blocks", pa.int32()), ("doc_id", pa.int64()), ("text_sha256", pa.string())])


def _blocks(size: int):
    def run(batches):
        for part in slices(batches, max_bytes=16 << 20):
            uses: dict[bytes, list] = {}
            columns = (part.column("row").to_pylist(), part.column("doc_id").to_pylist(), as_bytes(part.column("text")))
            for row, doc_id, text in zip(*columns, strict=True):
                text = ascii_lower(text)
                digest, count = hashlib.sha256(text).hexdigest(), max(1, -(-len(text) // size))
                for i in range(count):
                    block = text[i * size : (i + 1) * size]
                    uses.setdefault(block, []).append((row, i, count, doc_id, None if i else digest))
            ends = np.cumsum([0, *map(len, uses.values())], dtype=np.int32)
            fields = zip(*(use for group in uses.values() for use in group), strict=True)
            flat = pa.StructArray.from_arrays([pa.array(f, t.type) for f, t in zip(fields, ARROW_USE, strict=True)], fields=list(ARROW_USE))
            yield pa.RecordBatch.from_arrays([pa.array(uses, pa.binary()), pa.ListArray.from_arrays(ends, flat)], names=["block", "uses"])

    return run


def _name_sorted(batches):
    """Names along sorted blocks: the partition in the upper bits, below it one more wherever the block changes."""
    name, before = TaskContext.get().partitionId() << 36, None
    for batch in batches:
        if not batch.num_rows:
            continue
        blocks, uses = batch.column("block"), batch.column("uses")
        new = np.ones(batch.num_rows, np.int64)
        if batch.num_rows > 1:
            new[1:] = pc.not_equal(blocks[1:], blocks[:-1]).to_numpy(zero_copy_only=False)
        new[0] = before is None or blocks[0].as_py() != before
        names = name + np.cumsum(new)
        name, before = int(names[-1]), blocks[-1].as_py()
        flat = uses.flatten()
        repeated = np.repeat(names, pc.list_value_length(uses).to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(repeated), *flat.flatten()], names=NAME_SCHEMA.names)


def identities(docs: DataFrame, *, block_bytes: int = BLOCK_BYTES, row: Column | None = None) -> DataFrame:
    """Per row of docs: row, doc_id, text_sha256, and (level, name), equal exactly for equal normalised texts.

    row is the given number, else the monotonically increasing id of the input's rows, which are read once.
    """
    row = F.monotonically_increasing_id() if row is None else row
    rows = docs.select(row.alias("row"), docs["doc_id"].cast("long"), text_or_empty(docs).alias("text"))
    blocks = rows.mapInArrow(_blocks(block_bytes), BLOCK_SCHEMA)
    named = stage(blocks.repartition("block").sortWithinPartitions("block").mapInArrow(_name_sorted, NAME_SCHEMA), "blocks")
    heads = named.where("position = 0").select("row", "doc_id", "text_sha256", "blocks", "name")
    finished = [heads.where("blocks = 1").select("row", F.lit(0).alias("level"), "name")]
    longest = named.agg(F.max("blocks")).first()[0] or 1
    open_ = named.where("blocks > 1").select("row", "position", "blocks", "name")
    for level in range(1, (longest - 1).bit_length() + 1):
        pairs = open_.groupBy("row", "blocks", F.shiftright("position", 1).alias("pair")).agg(
            F.max(F.when(F.col("position") % 2 == 0, F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(F.col("position") % 2 == 1, F.col("name"))), F.lit(-1)).alias("right"),
        )
        names = stage(
            pairs.select("left", "right").distinct().sortWithinPartitions("left", "right").withColumn("name", F.monotonically_increasing_id()),
            "pair-names",
        )
        joined = pairs.join(names, ["left", "right"]).select(
            "row", F.col("pair").cast("int").alias("position"), F.expr("int((blocks + 1) / 2)").alias("blocks"), "name"
        )
        joined = stage(joined, "pairs")
        finished.append(joined.where("blocks = 1").select("row", F.lit(level).alias("level"), "name"))
        open_ = joined.where("blocks > 1")
    whole = finished[0]
    for more in finished[1:]:
        whole = whole.unionByName(more)
    return whole.join(heads.select("row", "doc_id", "text_sha256"), "row")


def dedup(docs: DataFrame, *, block_bytes: int = BLOCK_BYTES, row: Column | None = None) -> DataFrame:
    """Per row: row, doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are so after lower-casing A-Z; NULL counts as empty, and all empty texts are one group. Of
    a group the largest doc_id stays; NULL is smaller than any other. Where that doc_id occurs more than once in the
    group, the first of its rows stays. An empty table gives no rows. Other columns than doc_id and text are not read.
    """
    named = stage(identities(docs, block_bytes=block_bytes, row=row), "identities")
    groups = named.groupBy("level", "name").agg(
        F.max(F.struct("doc_id", (-F.col("row")).alias("minus_row"))).alias("best"), F.count("*").alias("group_size")
    )
    groups = stage(groups, "groups")  # one row a group: the join has nothing but shuffles below it and splits a hot one
    return named.join(groups, ["level", "name"]).select(
        "row",
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == -F.col("best.minus_row")).alias("kept"),
        "text_sha256",
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all their columns; which these are is told by `dedup`: of equal texts one row, also
    of NULL and empty ones. An empty table gives no rows, and a column may have any name."""
    number = unused(docs, ROW)
    whole = numbered(docs, number)
    kept = dedup(whole, row=whole[number]).where("kept").select(F.col("row").alias(number))
    return whole.join(kept, number, "left_semi").select(*[quoted(c) for c in docs.columns])
