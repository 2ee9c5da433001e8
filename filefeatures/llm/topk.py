"""Exact top-k inner products by columnar branch and bound.

Vectors are whole numbers, stored dimension by dimension: a block of rows is a matrix with one row per dimension. For a
query, products are added up one block of dimensions after another. What a row can still gain is bounded by the mass
that is left of both: |sum over the rest| <= |query rest| * |row rest| (Cauchy-Schwarz). Rows whose bound is below the
k-th best score that is already certain are dropped and the survivors are moved together, so later dimensions touch few
rows. A row is dropped only when its bound is strictly below, so ties reach the end and go to the smaller id.

Where float64 cannot hold the products of large components exactly, bounds are widened by what rounding may have cost, and
the survivors' products are worked out again in 64-bit integers.

Queries go to the tasks in blocks of a fixed number, once for each partition of the table; every partition answers with
its k best for each query, and a ranking merges these.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filefeatures.session import stage

K = 5
SCALE = 256
QUERY_BLOCK = 2048
PART_ROWS = 1 << 14
ROW_BLOCK = 4096
DIMENSIONS_AT_ONCE = 16

FOUND = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("score", T.LongType()), T.StructField("vec_id", T.LongType())])


def whole_vectors(table: DataFrame, vector: str = "embedding", key: str = "vec_id", scale: int = SCALE) -> DataFrame:
    """vec_id and the vector as floor(scale * x); vectors that are NULL, or hold NULL or a component without a finite value,
    are left out, and so are rows without an id."""
    x = F.col(vector).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(x, lambda c: F.floor(c * scale).cast("long"))
    return table.where(F.col(vector).isNotNull() & F.col(key).isNotNull()).where(finite).select(F.col(key).cast("long").alias("vec_id"), whole.alias("vector"))


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Dimension by row, as whole numbers."""
    return np.ascontiguousarray(pc.list_flatten(vectors).to_numpy(zero_copy_only=False).reshape(-1, width).T)


def _rest(matrix: np.ndarray, step: int) -> np.ndarray:
    """Per block of dimensions, the length of each column's part from that block on."""
    squares = np.array([(matrix[d : d + step] ** 2).sum(axis=0) for d in range(0, len(matrix), step)])
    return np.sqrt(squares[::-1].cumsum(axis=0)[::-1])


class Best:
    """The k best (score, -id) of every query in a block, over the rows seen so far."""

    def __init__(self, ids: np.ndarray, whole: np.ndarray, k: int, step: int, exact: bool):
        """exact: float64 holds all products and their sums."""
        self.ids, self.whole, self.k, self.step, self.exact = ids, whole, k, step, exact
        self.matrix = whole.astype(np.float64)
        self.rest = _rest(self.matrix, step)
        self.scores: list[np.ndarray] = [np.empty(0, np.int64)] * len(ids)
        self.found: list[np.ndarray] = [np.empty(0, np.int64)] * len(ids)

    def offer(self, row_ids: np.ndarray, whole: np.ndarray) -> None:
        step, width, rows = self.step, len(whole), whole.astype(np.float64)
        rest = _rest(rows, step)
        # Every rounding is at most eps of the largest sum on the way, which is at most the product of the lengths.
        cost = 4 * width * np.finfo(float).eps * rest[0] if not self.exact and width else 0.0
        head = self.matrix[:step].T @ rows[:step]  # the first dimensions of all queries at once
        for q in range(len(self.ids)):
            other = row_ids != self.ids[q]  # rows of the query's own id are no answers, so they may not raise the bar
            scores, alive = (head[q], None) if other.all() else (head[q][other], np.flatnonzero(other))
            slack = cost * self.rest[0, q] if width else 0.0
            for block, d in enumerate(range(step, width, step), start=1):
                reach = self.rest[block, q] * rest[block] + slack
                reach = reach if alive is None else reach[alive]
                kept = self._kept(q, scores, reach)
                if not kept.all():
                    alive = np.flatnonzero(kept) if alive is None else alive[kept]
                    scores = scores[kept]
                if not len(scores):
                    break
                part = rows[d : d + step] if alive is None else rows[d : d + step, alive]
                scores = scores + self.matrix[d : d + step, q] @ part
            self._merge(q, self._products(q, scores, whole, alive), row_ids if alive is None else row_ids[alive])

    def _products(self, q: int, scores: np.ndarray, whole: np.ndarray, alive: np.ndarray | None) -> np.ndarray:
        if self.exact:
            return scores.astype(np.int64)
        if len(scores) and np.abs(scores).max() >= 2.0**62:
            raise ValueError("an inner product does not fit into 64 bits")
        # Sums that wrap around on the way are right in the end.
        return self.whole[:, q] @ (whole if alive is None else whole[:, alive])

    def _kept(self, q: int, scores: np.ndarray, reach: np.ndarray) -> np.ndarray:
        """Rows that may still be among the best: at least k are certain to reach the bar."""
        bar = float(self.scores[q][-1]) if len(self.scores[q]) == self.k else -np.inf
        if len(scores) > self.k:
            low = scores - reach
            bar = max(bar, np.partition(low, len(low) - self.k)[len(low) - self.k])
        # Roots are rounded; half a unit is more than their error, and scores are whole numbers.
        return scores + reach >= bar - 0.5 - (0.0 if self.exact else 2 * np.finfo(float).eps * abs(bar))

    def _merge(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores[q], scores]), np.concatenate([self.found[q], ids])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores[q], self.found[q] = scores[order], ids[order]

    def rows(self) -> pa.RecordBatch:
        counts = [len(x) for x in self.found]
        arrays = [np.repeat(self.ids, counts), np.concatenate(self.scores), np.concatenate(self.found)]
        return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=FOUND.names)


def _search(k: int, row_block: int, step: int, exact: bool):
    """Rows of one (width, query block, part): queries first, then the part's rows."""

    def run(batches):
        best, ids, vectors = None, [], []

        def offer(count: int = 1) -> None:
            nonlocal ids, vectors
            if best is not None and sum(map(len, ids)) >= count:
                best.offer(np.concatenate(ids), _matrix(pa.concat_arrays(vectors), int(now[0])))
                ids, vectors = [], []

        now, queries = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in ("width", "block", "part")], axis=1)
            starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
            for begin, end in zip(starts, [*starts[1:], len(keys)], strict=True):
                if tuple(keys[begin]) != now:
                    offer()
                    if best is not None:
                        yield best.rows()
                    now, best, queries, ids, vectors = tuple(keys[begin]), None, [], [], []
                own = batch.slice(int(begin), int(end - begin))
                asked = int(pc.sum(own.column("is_query")).as_py() or 0)  # they sort before the rows
                if asked:
                    queries.append(own.slice(0, asked))
                if asked < own.num_rows and (queries or best):  # a small block may have got no query
                    if best is None:
                        both = pa.Table.from_batches(queries)
                        matrix = _matrix(both.column("vector").combine_chunks(), int(now[0]))
                        best = Best(both.column("vec_id").to_numpy(), matrix, k, step, exact)
                    for at in range(asked, own.num_rows, row_block):
                        piece = own.slice(at, min(row_block, own.num_rows - at))
                        ids.append(piece.column("vec_id").to_numpy())
                        vectors.append(piece.column("vector"))
                        offer(row_block)
        offer()
        if best is not None:
            yield best.rows()

    return run


def top_k(
    vectors: DataFrame,
    is_query: Column,
    *,
    k: int = K,
    query_block: int = QUERY_BLOCK,
    part_rows: int = PART_ROWS,
    row_block: int = ROW_BLOCK,
    dimensions_at_once: int = DIMENSIONS_AT_ONCE,
) -> DataFrame:
    """Per query its k highest inner products with the other rows: query_id, rank (from 1), vec_id, score.

    vectors has vec_id and vector (see whole_vectors). A row never answers a query of the same id, so rows that repeat
    an id do not find each other; repeated answers are kept. Ties go to the smaller vec_id. Fewer than k rows give all of
    them, an empty table none. Vectors of another length have no product with a query: it is answered by those of its own
    length. A product or a component that does not fit into 64 bits is an error.

    Each block of query_block queries meets each part of about part_rows rows in one task; queries and rows travel as
    often as the other side has blocks. No side is broadcast.
    """
    vectors = stage(vectors, "vectors")
    stats = vectors.agg(
        F.max(F.size("vector")), F.max(F.array_max(F.transform("vector", lambda c: F.abs(c)))), F.count("*"), F.count_if(is_query)
    ).first()
    width, largest, rows, queries = (int(x or 0) for x in stats)
    exact = width * largest * largest < 1 << 52
    blocks, parts = max(1, -(-queries // query_block)), max(1, -(-rows // part_rows))
    vectors = vectors.withColumn("width", F.size("vector")).where("width > 0")
    number = F.xxhash64("vec_id")
    every_part, every_block = F.sequence(F.lit(0), F.lit(parts - 1)), F.sequence(F.lit(0), F.lit(blocks - 1))
    asked = vectors.where(is_query).select(
        "width", F.pmod(number, F.lit(blocks)).cast("int").alias("block"), F.explode(every_part).alias("part"), F.lit(1).alias("is_query"), "vec_id", "vector"
    )
    offered = vectors.select(
        "width", F.explode(every_block).alias("block"), F.pmod(number, F.lit(parts)).cast("int").alias("part"), F.lit(0).alias("is_query"), "vec_id", "vector"
    )
    dealt = asked.unionByName(offered).repartition("width", "block", "part").sortWithinPartitions("width", "block", "part", F.desc("is_query"))
    found = dealt.mapInArrow(_search(k, row_block, dimensions_at_once, exact), FOUND)
    # k rows per query and part; Spark cuts each task's rows to k per query before it shuffles them.
    best_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
