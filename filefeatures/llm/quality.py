"""A quality classifier: histogram gradient-boosted trees over statistics of the whole text.

Fitting: features are cut into at most 64 bins by their quantiles; every tree grows level by level on sums of gradient
and curvature per node, feature and bin, and takes Newton steps for the logistic loss. The trees end as flat arrays, and
all rows of a batch walk through all trees at once by indexing.
"""

from __future__ import annotations

from collections import Counter
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filefeatures.llm.arrow import as_bytes, slices, text_or_empty
from filefeatures.llm.labelled import FOLDS, HELD_OUT_FOLD, MAX_LABELLED, held_out, training_sample

THRESHOLD = 0.7
BINS, TREES, DEPTH, RATE, RIDGE, LEAST_WEIGHT = 64, 80, 4, 0.15, 2.0, 5.0

_CLASS = np.zeros(256, np.int64)  # of a byte
for _code, _chars in enumerate(
    (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b".", b",", b"!?", b"|", b"#$%&*@^~_+=", b"<>{}[]()/\\", b":;'\"-"), start=1
):
    _CLASS[list(_chars)] = _code
_CLASS[128:192], _CLASS[192:] = 13, 14  # inside and at the start of a longer character
_CLASSES = 15


def features(text: bytes) -> np.ndarray:
    """Statistics of a text; all are 0 for an empty one."""
    out = np.zeros(_CLASSES + 15)
    if not text:
        return out
    by_byte = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    size = len(text)
    out[:_CLASSES] = np.bincount(_CLASS, weights=by_byte, minlength=_CLASSES) / size
    present = by_byte[by_byte > 0] / size
    out[_CLASSES] = np.log1p(size)
    out[_CLASSES + 1] = -(present * np.log2(present)).sum()
    words, lines = text.split(), text.split(b"\n")
    out[_CLASSES + 2] = np.log1p(len(lines))
    out[_CLASSES + 3] = 1 - len(set(lines)) / len(lines)
    out[_CLASSES + 4] = np.log1p(max(map(len, lines)))
    if words:
        counts = Counter(words)
        count, most = len(words), counts.most_common(2)
        out[_CLASSES + 5] = np.log1p(count)
        out[_CLASSES + 6] = (size - count) / count
        out[_CLASSES + 7] = len(counts) / count
        out[_CLASSES + 8] = most[0][1] / count
        out[_CLASSES + 9] = most[-1][1] / count
        out[_CLASSES + 10] = sum(map(eq, words, words[1:])) / count
        out[_CLASSES + 11] = np.log1p(max(map(len, counts)))
        out[_CLASSES + 12] = count / len(lines)
        out[_CLASSES + 13] = sum(n for w, n in counts.items() if len(w) == 1) / count
        out[_CLASSES + 14] = sum(n for w, n in counts.items() if len(w) > 12) / count
    return out


def _probability(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -40, 40)))


class Trees:
    """Flat arrays over all nodes of all trees; a leaf points to itself. Trees that were not fitted on both labels decide
    nothing: they have a score, but reject no text."""

    def __init__(self, start: float, decides: bool = True):
        self.start, self.roots, self.decides = start, [], decides
        self.feature, self.threshold, self.left, self.right, self.value = [], [], [], [], []

    def add_node(self) -> int:
        node = len(self.feature)
        for column, x in ((self.feature, 0), (self.threshold, np.inf), (self.left, node), (self.right, node), (self.value, 0.0)):
            column.append(x)
        return node

    def freeze(self) -> Trees:
        self.feature, self.left, self.right = (np.array(x, np.int64) for x in (self.feature, self.left, self.right))
        self.threshold, self.value = np.array(self.threshold), np.array(self.value)
        return self

    def margins(self, x: np.ndarray) -> np.ndarray:
        at = np.repeat(np.array(self.roots, np.int64)[None, :], len(x), axis=0)
        rows = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return self.start + self.value[at].sum(axis=1)


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Trees for labels 0 and 1. Without rows, or with one label only, the result is a constant."""
    share = (y.sum() + 1) / (len(y) + 2)
    trees = Trees(float(np.log(share / (1 - share))), bool(len(y) and y.min() != y.max()))
    if not trees.decides:
        return trees.freeze()
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T]
    binned = np.stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, x.T, strict=True)], axis=1)
    count, width = x.shape
    cell = np.arange(width) * BINS + binned
    margin = np.full(count, trees.start)
    for _ in range(TREES):
        p = _probability(margin)
        gradient, curvature = p - y, np.maximum(p * (1 - p), 1e-6)
        root = trees.add_node()
        trees.roots.append(root)
        node_of, open_ = np.zeros(count, np.int64), [root]
        place = np.full(count, root)
        for level in range(DEPTH + 1):
            size = len(open_) * width * BINS
            live = node_of >= 0
            at = (node_of[live, None] * width * BINS + cell[live]).ravel()
            g, h = (
                np.bincount(at, weights=np.repeat(v[live], width), minlength=size).reshape(len(open_), width, BINS).cumsum(axis=2)
                for v in (gradient, curvature)
            )
            total_g, total_h = g[:, 0, -1], h[:, 0, -1]
            for i, node in enumerate(open_):
                trees.value[node] = -RATE * total_g[i] / (total_h[i] + RIDGE)
            if level == DEPTH:
                break
            rest_g, rest_h = total_g[:, None, None] - g, total_h[:, None, None] - h
            gain = g**2 / (h + RIDGE) + rest_g**2 / (rest_h + RIDGE) - (total_g**2 / (total_h + RIDGE))[:, None, None]
            gain[(h < LEAST_WEIGHT) | (rest_h < LEAST_WEIGHT)] = -np.inf
            new, next_of = [], np.full(count, -1)
            for i, node in enumerate(open_):
                f, b = np.unravel_index(np.argmax(gain[i]), gain[i].shape)
                if gain[i, f, b] <= 1e-3 or b >= len(edges[f]):
                    continue
                trees.feature[node], trees.threshold[node] = f, edges[f][b]
                own = np.flatnonzero(node_of == i)
                below = binned[own, f] <= b
                for side, rows in ((trees.left, own[below]), (trees.right, own[~below])):
                    child = side[node] = trees.add_node()
                    next_of[rows] = len(new)
                    place[rows] = child
                    new.append(child)
            if not new:
                break
            node_of, open_ = next_of, new
        margin = margin + np.array(trees.value)[place]
    return trees.freeze()


def train(docs: DataFrame, labels: DataFrame, *, limit: int = MAX_LABELLED) -> Trees:
    """Fitted on the statistics of a bounded sample of labelled documents outside the held-out fold."""

    def run(batches):
        for part in slices(batches):
            x = [features(text) for text in as_bytes(part.column("text"))]
            yield pa.RecordBatch.from_arrays([part.column("label"), pa.array(x, pa.list_(pa.float64()))], names=["label", "x"])

    rows = training_sample(docs, labels, "quality", limit).mapInArrow(run, "label int, x array<double>").toArrow()
    if not rows.num_rows:
        return fit(np.empty((0, _CLASSES + 15)), np.empty(0))
    x = rows.column("x").combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1)
    y = rows.column("label").to_numpy().astype(np.float64)
    order = np.lexsort((y, *x.T))  # rows come in any order; the model must not depend on it
    return fit(x[order], y[order])


def probabilities(trees: Trees, texts: list[bytes]) -> np.ndarray:
    return _probability(trees.margins(np.array([features(text) for text in texts]).reshape(len(texts), -1)))


SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("score", T.DoubleType())])


def score(docs: DataFrame, trees: Trees, *, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted. NULL text counts as empty and is scored as such; doc_id may be NULL
    (then the row is not held out) or repeated. Only the text decides. Other columns are not read."""

    def run(batches):
        for part in slices(batches):
            found = probabilities(trees, as_bytes(part.column("text")))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found)], names=SCHEMA.names)

    found = docs.select(docs["doc_id"].cast("long"), text_or_empty(docs).alias("text")).mapInArrow(run, SCHEMA)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, trees: Trees, *, threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose text reaches the threshold, with all their columns; all rows if the trees do not decide. NULL counts
    as empty and is judged like any text; repeated rows are each judged by theirs. An empty table gives no rows."""
    if not trees.decides:
        return docs

    def run(batches):
        for part in slices(batches):
            texts = [text or b"" for text in as_bytes(part.column("text"))]
            yield part.filter(pa.array(probabilities(trees, texts) >= threshold))

    return docs.mapInArrow(run, docs.schema)


__all__ = ["FOLDS", "HELD_OUT_FOLD", "Trees", "features", "fit", "keep_good", "score", "train"]
