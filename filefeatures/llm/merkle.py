"""A Merkle manifest of a dataset: one tree per group, one tree over their roots, a proof for every row.

All digests are SHA-256 in lower-case hexadecimal, and a parent is the digest of its children's digests, concatenated.

Concatenated-level strings: an aligned block of `arity ** levels` nodes keeps each of its levels as one string of 64
places a node. The substrings of 64 * arity places are the parents' inputs; a node's siblings are what flanks it inside
its own substring. A block needs nothing from beside it, so the tree is climbed by blocks: the blocks' roots are the nodes
of the next climb, which has `arity ** levels` times fewer, until one node is left. Then the flanks come down again, and
a row's proof is its segments put together.

Positions come from a range sort that is written once: a row's position is that inside its range and what the ranges
before hold. No group, however large, meets in one task. Everything is DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filefeatures.llm.arrow import ROW
from filefeatures.session import stage

ARITY = 2
LEVELS = 8  # of a block: 256 rows
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
HEX = 64
INSIDE = (1 << 33) - 1  # monotonically_increasing_id: partition number above, position in it below
FLANKS = "array<struct<left:string,right:string>>"


def leaf(values: Sequence[Column]) -> Column:
    """Digest of the values in order, each as `-` if NULL, else its number of UTF-8 bytes, `:` and itself."""
    texts = [value.cast("string") for value in values]
    parts = [F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")) for text in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def folded(digest: Column, path: Column) -> Column:
    """The root that a leaf's digest leads to by the flanks of its path."""
    return F.aggregate(path, digest, lambda at, beside: F.sha2(F.concat(beside["left"], at, beside["right"]), 256))


def proof_text(path: Column) -> Column:
    """A path's digests in one string: level by level, left to right."""
    return F.array_join(F.transform(path, lambda beside: F.concat(beside["left"], beside["right"])), "")


def _placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """rows with `pos`, their position by `order` among the rows of their `tree`, and `size`, how many that tree has.

    Rows that are equal in all of `order` may come in any order, but it is the same in all later jobs.
    """
    keys = ["tree", *order, ROW]
    ranged = rows.withColumn(ROW, F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranged = stage(ranged.drop(ROW).withColumn("at", F.monotonically_increasing_id()), "sorted")
    ranged = ranged.withColumns({"range": F.shiftright("at", 33), "at": F.col("at").bitwiseAND(F.lit(INSIDE))})
    # Ranges are contiguous: there are no more spans than ranges and trees together, and no more of a tree than ranges.
    spans = ranged.groupBy("tree", "range").agg(F.count("*").alias("rows"), F.min("at").alias("first"))
    own = Window.partitionBy("tree")
    before = F.coalesce(F.sum("rows").over(own.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = stage(spans.select("tree", "range", (before - F.col("first")).alias("shift"), F.sum("rows").over(own).alias("size")), "spans")
    return ranged.join(spans, ["tree", "range"]).withColumn("pos", F.col("at") + F.col("shift")).drop("at", "range", "shift")


def _cut(level: str, first: str, nodes: str) -> str:
    """The digests of some nodes of a level. Levels are binary, so a substring is found by its offset."""
    return f"substring({level}, int(({first}) * {HEX} + 1), int(({nodes}) * {HEX}))"


def _blocks(nodes: DataFrame, width: int) -> DataFrame:
    """Nodes (tree, pos, size, digest, node) as rows of a block: its members in order."""
    member = F.struct((F.col("pos") % width).alias("at"), "digest", "node")
    rows = nodes.withColumn("block", F.floor(F.col("pos") / width))
    return rows.groupBy("tree", "block").agg(F.first("size").alias("size"), F.sort_array(F.collect_list(member)).alias("members"))


def _with_levels(blocks: DataFrame, arity: int, levels: int) -> DataFrame:
    """Every level of a block as one string; a tree that is down to one node stays as it is."""
    blocks = blocks.withColumn("level0", F.expr("binary(array_join(members.digest, ''))"))
    for depth in range(levels):
        here = f"level{depth}"
        runs = f"sequence(0, int(ceil(octet_length({here}) / {HEX * arity})) - 1)"
        parents = f"transform({runs}, run -> sha2({_cut(here, f'run * {arity}', str(arity))}, 256))"
        blocks = blocks.withColumn(f"level{depth + 1}", F.expr(f"if(size > {arity**depth}, binary(array_join({parents}, '')), {here})"))
    return blocks


def _up(nodes: DataFrame, arity: int, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of every climb, and (tree, digest) of the roots."""
    width = arity**levels
    left = nodes.agg(F.max("size")).first()[0] or 0
    climbs = []
    while True:
        climbs.append(stage(_blocks(nodes, width), "blocks"))
        tops = _with_levels(climbs[-1], arity, levels)
        size = F.ceil(F.col("size") / width).cast("long").alias("size")
        digest = F.col(f"level{levels}").cast("string").alias("digest")
        nodes = stage(tops.select("tree", F.col("block").alias("pos"), size, digest, F.lit(None).cast("string").alias("node")), "tops")
        left = -(-left // width)
        if left <= 1:
            return climbs, nodes.select("tree", "digest")


def _down(climbs: list[DataFrame], above: DataFrame, arity: int, levels: int) -> DataFrame:
    """(node, digest, path, facts) of the lowest nodes, from (tree, path, facts) above the trees: a node's path is its flanks
    inside its block and then the path of the block's root."""
    width = arity**levels

    def flanks(depth: int) -> str:
        level, node = f"level{depth}", f"(m.at div {arity**depth})"
        left = _cut(level, f"{node} - {node} % {arity}", f"{node} % {arity}")
        right = _cut(level, f"{node} + 1", f"{arity - 1} - {node} % {arity}")
        return f"if(size > {arity**depth}, named_struct('left', string({left}), 'right', string({right})), NULL)"

    own = f"filter(array({', '.join(flanks(depth) for depth in range(levels))}), x -> x IS NOT NULL)"
    members = F.expr(f"transform(members, m -> struct(m.at, m.digest, m.node, {own} AS own))")
    above = above.withColumn("block", F.lit(0).cast("long"))
    for number, blocks in reversed(list(enumerate(climbs))):
        blocks = _with_levels(blocks.join(above, ["tree", "block"]), arity, levels)
        rows = blocks.select("tree", "block", "path", "facts", F.explode(members).alias("m"))
        path = F.concat("m.own", "path").alias("path")
        if number:
            above = rows.select("tree", (F.col("block") * width + F.col("m.at")).alias("block"), path, "facts")
        else:
            return rows.select("m.node", "m.digest", path, "facts")


def manifest(
    docs: DataFrame,
    *,
    columns: Sequence[str] = LEAF_COLUMNS,
    group: str = "lang",
    order: str = "doc_id",
    carry: Mapping[str, Column] | None = None,
    arity: int = ARITY,
    levels: int = LEVELS,
) -> DataFrame:
    """Per row: the `order` column, the columns of `carry`, leaf, subroot, root, path (array of the digests left and right
    of the row's line, from its own level up).

    A leaf is the digest of `columns`. Per group, leaves ascend by `order` (NULL first, equal ones by their digest); while
    more than one node is left, every `arity` consecutive ones become their digest, the last run being shorter where they do
    not come out even, and one node alone too. The group's roots, ordered by group (NULL first, then by UTF-8 bytes), make
    the root likewise. A tree of one node is its own root. Rows that repeat each have their leaf. NULL and empty text are
    different leaves. An empty table gives no rows. Columns not named here are not read.
    """
    if arity < 2 or levels < 1:
        raise ValueError("a tree needs an arity of two and blocks of one level at least")
    carried = {order: docs[order], **(carry or {})}
    named = F.coalesce(F.concat(F.lit("="), docs[group].cast("string")), F.lit("-"))  # '-' sorts before '='
    made = docs.select(
        named.alias("tree"),
        docs[order].alias("place"),
        leaf([docs[name] for name in columns]).alias("digest"),
        F.struct(*[column.alias(name) for name, column in carried.items()]).alias("node"),
    )
    climbs, subroots = _up(_placed(stage(made, "leaves"), ["place", "digest"]).drop("place"), arity, levels)
    groups = subroots.select(F.lit("").alias("tree"), F.struct(F.col("tree").alias("group"), "digest").alias("node"), "digest")
    upper, root = _up(_placed(groups, ["node"]), arity, levels)
    no_path = F.array().cast(FLANKS).alias("path")
    above = _down(upper, root.select("tree", no_path, F.struct(F.col("digest").alias("root")).alias("facts")), arity, levels)
    facts = F.struct(F.col("digest").alias("subroot"), F.col("facts.root").alias("root")).alias("facts")
    above = stage(above.select(F.col("node.group").alias("tree"), "path", facts), "above")
    rows = _down(climbs, above, arity, levels)
    return rows.select("node.*", F.col("digest").alias("leaf"), "facts.subroot", "facts.root", "path")
