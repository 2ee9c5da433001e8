"""Near duplicates: SuperMinHash signatures, banding, exact verification, union-find grouping.

1. Every text becomes the set of its word shingles. Equal sets become one node, before anything else: copies of a text,
   however many, cost one row each from here on.
2. Nodes that agree in all slots of a band share a bucket. The sets of all nodes with company are made once.
3. Every member of a bucket is compared with the bucket's first member: as many pairs as there are members.
4. Members that buckets connect are a group, in which every text that may be linked to another lies with it. Groups that
   still hold several components are compared in blocks: signatures first, then the whole sets of the pairs that the
   signatures leave possible and that lie in different components, the likeliest first. A task joins components as it
   finds links, and gives back only the links that joined some: fewer than it has members, however many pairs are alike.
   A link is missed only if neither bands nor chains of buckets bring its texts together, or if the estimate is off by
   more than six standard deviations.

Every pair counts as linked only after its whole sets were compared.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filefeatures.llm.arrow import ROW, as_bytes, numbered, slices, text_or_empty, unused
from filefeatures.llm.components import components
from filefeatures.llm.superminhash import bands, set_id, shingle_sets, signatures
from filefeatures.operators.select import quoted
from filefeatures.session import stage

SHINGLE_WORDS = 5
MIN_PERCENT = 80
SLOTS = 160
BANDS = 32
BLOCK_ROWS = 512
SKETCH_BYTES = 1 << 19  # text at a time: a signature takes 160 two-byte places for each shingle of a short text
AT_ONCE = 64  # candidates whose sets are compared together

SKETCH = T.StructType(
    [
        T.StructField("row", T.LongType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("set_id", T.BinaryType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
    ]
)
SETS = T.StructType(
    [
        T.StructField("node", T.LongType()),
        T.StructField("size", T.LongType()),
        T.StructField("slots", T.BinaryType()),
        T.StructField("shingles", T.ArrayType(T.LongType())),
    ]
)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    flat = np.concatenate(rows) if rows else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(ends, pa.array(flat.view(np.int64)))


def _sketch(width: int, slots: int, count: int):
    def run(batches):
        for part in slices(batches, max_bytes=SKETCH_BYTES):
            sets = shingle_sets(as_bytes(part.column("text")), width)
            keys = bands(signatures(sets, slots), count)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("row"),
                    part.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_id(s) for s in sets], pa.binary()),
                    _lists(list(keys)),
                ],
                names=SKETCH.names,
            )

    return run


def _sets(width: int, slots: int):
    def run(batches):
        for part in slices(batches, max_bytes=SKETCH_BYTES):
            sets = shingle_sets(as_bytes(part.column("text")), width)
            low = (signatures(sets, slots) & np.uint64(0xFFFF)).astype(np.uint16)
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), pa.array([len(s) for s in sets], pa.int64()), pa.array([x.tobytes() for x in low], pa.binary()), _lists(sets)],
                names=SETS.names,
            )

    return run


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are alike enough; sizes that rule it out are told before the sets are fetched."""
    sizes = sets.select("node", "size")
    near = (
        pairs.join(sizes.toDF("a", "size_a"), "a")
        .join(sizes.toDF("b", "size_b"), "b")
        .where(100 * F.least("size_a", "size_b") >= percent * F.greatest("size_a", "size_b"))
    )
    own = sets.select("node", "shingles")
    both = near.join(own.toDF("a", "set_a"), "a").join(own.toDF("b", "set_b"), "b")
    common = F.size(F.array_intersect("set_a", "set_b")).cast("long")
    return both.where(100 * common >= percent * (F.col("size_a") + F.col("size_b") - common)).select("a", "b")


def _with_component(members: DataFrame, links: DataFrame) -> DataFrame:
    found = components(links)
    return members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _blocks(slots: int, percent: int):
    """Compares the members of one block of a group, or of two: rows sorted by (group, i, j), in any number of batches.
    Gives links that join components; a link inside what is joined already is not looked for."""
    least = percent / 100 - 6 * math.sqrt(percent / 100 * (1 - percent / 100) / slots)

    def compare(rows: list[pa.RecordBatch]):
        table = pa.Table.from_batches(rows)
        node, size, part, chunk = (table.column(c).to_numpy() for c in ("node", "size", "component", "chunk"))
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        part = part.copy()
        slot = np.frombuffer(b"".join(table.column("slots").to_pylist()), np.uint16).reshape(len(node), slots)
        lists = table.column("shingles").combine_chunks()
        flat, ends = lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy()
        found = []
        for x in np.flatnonzero(chunk == i):
            facing = chunk == j if i != j else np.arange(len(node)) > x
            others = np.flatnonzero(facing & (part != part[x]))
            small, large = np.minimum(size[others], size[x]), np.maximum(size[others], size[x])
            others = others[100 * small >= percent * large]
            if not len(others):
                continue
            alike = (slot[others] == slot[x]).mean(axis=1)
            others = others[np.argsort(-alike, kind="stable")][: int((alike >= least).sum())]
            own = flat[ends[x] : ends[x + 1]]
            while len(others):
                now, others = others[:AT_ONCE], others[AT_ONCE:]
                hashes = np.concatenate([flat[ends[y] : ends[y + 1]] for y in now])
                place = np.minimum(np.searchsorted(own, hashes), len(own) - 1)
                common = np.bincount(np.repeat(np.arange(len(now)), size[now]), weights=own[place] == hashes, minlength=len(now))
                for y in now[100 * common >= percent * (size[now] + size[x] - common)]:
                    if part[y] != part[x]:
                        found.append((node[x], node[y]))
                        part[part == part[y]] = part[x]
                others = others[part[others] != part[x]]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["a", "b"])

    def run(batches):
        open_, key = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in ("group", "i", "j")], axis=1)
            starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
            for begin, end in zip(starts, [*starts[1:], len(keys)], strict=True):
                now = tuple(keys[begin])
                if now != key and open_:
                    yield from compare(open_)
                    open_ = []
                key = now
                open_.append(batch.slice(begin, end - begin))
        if open_:
            yield from compare(open_)

    return run


def _links_across(members: DataFrame, sets: DataFrame, slots: int, percent: int, block_rows: int) -> DataFrame:
    """Links between components, from rows (group, node, component): blocks of each group that holds several."""
    groups = members.groupBy("group").agg(F.count("*").alias("rows"), F.min("component").alias("low"), F.max("component").alias("high"))
    groups = groups.where("low <> high").select("group", F.ceil(F.col("rows") / block_rows).cast("int").alias("chunks"))
    rows = members.join(groups, "group").withColumn("chunk", F.expr("int(pmod(xxhash64(node, 7), chunks))"))
    blocks_of = F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1),
        lambda other: F.struct(F.least("chunk", other).alias("i"), F.greatest("chunk", other).alias("j")),
    )
    rows = rows.join(sets, "node").withColumn("pair", F.explode(blocks_of)).select("*", "pair.i", "pair.j").drop("pair", "chunks")
    dealt = rows.repartition("group", "i", "j").sortWithinPartitions("group", "i", "j")
    return dealt.mapInArrow(_blocks(slots, percent), "a long, b long")


def near_dedup(
    docs: DataFrame,
    *,
    shingle_words: int = SHINGLE_WORDS,
    min_percent: int = MIN_PERCENT,
    slots: int = SLOTS,
    band_count: int = BANDS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Per row: row, doc_id, n_shingles, component, component_id, kept.

    Texts are linked if their sets of shingles share min_percent of their union at least; component is a row number that
    exactly the rows whose texts are linked have in common, component_id the smallest doc_id that links lead to. NULL,
    empty and blank texts have no shingles and are linked with nothing, so each one stays. A text with fewer words than a
    shingle is one shingle. NULL doc_ids are passed over for component_id unless a group has no other; kept compares doc_id and component_id as equal values, NULL with NULL too. Rows that repeat a
    doc_id are one group if their texts are, and all carry the same flag. An empty table gives no rows. Other columns
    than doc_id and text are not read.
    """
    docs = numbered(docs.select("doc_id", "text"))
    return _near_dedup(docs, ROW, shingle_words, min_percent, slots, band_count, block_rows)


def _near_dedup(docs: DataFrame, number: str, shingle_words: int, min_percent: int, slots: int, band_count: int, block_rows: int) -> DataFrame:
    rows = docs.select(docs[number].alias("row"), docs["doc_id"].cast("long"), text_or_empty(docs).alias("text"))
    sketches = stage(rows.mapInArrow(_sketch(shingle_words, slots, band_count), SKETCH), "sketches")
    some = sketches.where("n_shingles > 0")
    classes = stage(some.groupBy("set_id").agg(F.min("row").alias("node"), F.min("doc_id").alias("lowest")), "classes")
    keys = some.join(classes.select("node"), F.col("row") == F.col("node")).select("node", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.min("node").alias("first"), F.count("*").alias("rows")).where("rows > 1").drop("rows")
    members = stage(keys.join(shared, "key"), "members")
    company = members.select("node").distinct()
    sets = stage(rows.join(company, F.col("row") == F.col("node"), "left_semi").mapInArrow(_sets(shingle_words, slots), SETS), "sets")

    pairs = stage(members.where("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b")).distinct(), "pairs")
    links = stage(_linked(pairs, sets, min_percent), "links")
    grouped = components(pairs).withColumnRenamed("component", "group")
    grouped = stage(_with_component(grouped, links), "grouped")
    links = links.unionByName(stage(_links_across(grouped, sets, slots, min_percent, block_rows), "links"))

    found = classes.join(components(links), "node", "left").withColumn("component", F.coalesce("component", "node"))
    found = stage(found, "found")
    named = found.groupBy("component").agg(F.min("lowest").alias("component_id"))
    of_set = found.join(named, "component").select("set_id", "component", "component_id")
    linked = some.join(of_set, "set_id").select("row", "doc_id", "n_shingles", "component", "component_id")
    alone = sketches.where("n_shingles = 0").select(
        "row", "doc_id", "n_shingles", F.col("row").alias("component"), F.col("doc_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, one of each component, with all their columns.

    Of a component the smallest doc_id stays, NULL only where there is no other; of rows that repeat it, the first. Texts
    without words are components of their own, so all of them stay. An empty table gives no rows, and a column may have any
    name.
    """
    number = unused(docs, ROW)
    whole = numbered(docs, number)
    found = _near_dedup(whole, number, SHINGLE_WORDS, MIN_PERCENT, SLOTS, BANDS, BLOCK_ROWS)
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")
    kept = found.groupBy("component").agg(F.min(order).alias("best")).select(F.col("best.row").alias(number))
    return whole.join(kept, number, "left_semi").select(*[quoted(c) for c in docs.columns])
