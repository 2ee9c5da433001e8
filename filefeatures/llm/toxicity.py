"""Severity of toxicity by cumulative-link ordinal regression over sparse word features.

With grades 0 < 1 < .. < K, P(grade > k) = logistic(w . x - threshold k): one weight per word, shared by all thresholds,
and thresholds in order. x is sparse: a 1 for each chosen word that the text has, and for each word or stem that is a
certain share of the text. They are chosen by how much more of the toxic than of the other training documents have them,
measured in standard deviations: those that come up to a bar, which falls with what few documents can reach. The expected severity is the sum over k of P(grade > k).

Labels say only toxic or not. The grade of a toxic training document is one more than the thirds it lies above when toxic
documents are ordered by how many of the chosen features they have.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filefeatures.llm.arrow import as_bytes, ascii_lower, slices, text_or_empty
from filefeatures.llm.labelled import MAX_LABELLED, held_out, training_sample
from filefeatures.llm.superminhash import shingle_sets, word_hashes
from filefeatures.session import stage

GRADES = 3
WORDS, LEAST_DOCUMENTS, LEAST_DEVIATIONS = 500, 4, 6.0
OF_STRONGEST = 0.75  # where the strongest feature is weak, others count from this share of its deviations on
STEM_BYTES = (5, 7)
SHARES = (0.005, 0.01)
COPY_WORDS = 5
THRESHOLD = 0.5
RIDGE, STEPS, RATE = 0.3, 600, 0.1

# Everything in ASCII but letters and digits parts words.
_PART = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))

SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("p_toxic", T.DoubleType()), T.StructField("expected_severity", T.DoubleType()), T.StructField("grade", T.IntegerType())]
)


def features(texts: list[bytes]) -> list[np.ndarray]:
    """64-bit hashes of what each text has: its different words, lower-cased; and each word or stem (the first bytes of longer
    words) that makes up a share of its words, once for each of the shares that it reaches."""
    found, ends = [], []
    for text in texts:
        words = ascii_lower(text).translate(_PART).split()
        counts = Counter(words)
        found += counts
        for length in STEM_BYTES:
            stems: dict[bytes, int] = {}
            for word, count in counts.items():
                if len(word) > length:
                    stem = word[:length] + b"-"
                    stems[stem] = stems.get(stem, 0) + count
            counts |= stems
        for share in SHARES:
            least = share * len(words)
            found += [b"%d %s" % (share * 1000, word) for word, count in counts.items() if count >= least]
        ends.append(len(found))
    return np.split(word_hashes(found).view(np.int64), ends)[:-1]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Severity:
    """Weights by word hash (sorted) and rising thresholds. A model that was not fitted on both labels, or
    knows no word, decides nothing: it has chances, the same for all texts, but calls none toxic."""

    def __init__(self, words: np.ndarray, weights: np.ndarray, thresholds: np.ndarray, decides: bool = True):
        self.words, self.weights, self.thresholds, self.decides = words, weights, thresholds, decides

    def above(self, texts: list[bytes]) -> np.ndarray:
        """P(grade > k) by text and k."""
        total = np.zeros(len(texts))
        if len(self.words):
            for i, hashes in enumerate(features(texts)):
                at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
                total[i] = self.weights[at][self.words[at] == hashes].sum()
        return _sigmoid(total[:, None] - self.thresholds)


def fit(rows: list[np.ndarray], grades: np.ndarray, words: np.ndarray) -> Severity:
    """rows: numbers of the words that each text has. Gradient ascent (Adam) on the ordinal likelihood with a ridge."""
    top = GRADES
    thresholds = np.array([np.log(((grades <= k).sum() + 1) / ((grades > k).sum() + 1)) for k in range(top)])
    decides = bool(len(words) and (grades == 0).any() and (grades > 0).any())
    if not len(words) or not len(grades):
        return Severity(words, np.zeros(len(words)), thresholds, decides)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    column = np.concatenate(rows) if len(owner) else np.empty(0, np.int64)
    # Thresholds as a first one and logarithms of the gaps keep their order.
    state = np.concatenate([np.zeros(len(words)), thresholds[:1], np.log(np.maximum(np.diff(thresholds), 0.05))])
    mean, square = np.zeros_like(state), np.zeros_like(state)

    def cuts(state: np.ndarray) -> np.ndarray:
        return state[len(words)] + np.concatenate([[0.0], np.cumsum(np.exp(state[len(words) + 1 :]))])

    for step in range(1, STEPS + 1):
        weights, theta = state[: len(words)], cuts(state)
        total = np.bincount(owner, weights=weights[column], minlength=len(rows))
        above = np.concatenate([np.ones((len(rows), 1)), _sigmoid(total[:, None] - theta), np.zeros((len(rows), 1))], axis=1)
        here = np.arange(len(rows))
        high, low = above[here, grades], above[here, grades + 1]
        chance = np.maximum(high - low, 1e-9)
        d_high, d_low = high * (1 - high) / chance, low * (1 - low) / chance
        d_total = d_high - d_low
        gradient = np.zeros_like(state)
        gradient[: len(words)] = np.bincount(column, weights=d_total[owner], minlength=len(words)) - RIDGE * weights
        d_theta = np.bincount(grades, weights=d_low, minlength=top + 1)[:top] - np.bincount(grades, weights=d_high, minlength=top + 1)[1 : top + 1]
        gradient[len(words)] = d_theta.sum()
        gaps = np.exp(state[len(words) + 1 :])
        gradient[len(words) + 1 :] = d_theta[::-1].cumsum()[::-1][1:] * gaps
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        state = state + RATE * mean / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return Severity(words, state[: len(words)], cuts(state), decides)


def train(docs: DataFrame, labels: DataFrame, *, limit: int = MAX_LABELLED) -> Severity:
    """Fitted on a bounded sample of labelled documents outside the held-out fold. Their words are counted by Spark; the
    driver gets at most WORDS words, and for each sampled document the numbers of those that it has."""

    def hashed(batches):
        for part in slices(batches):
            texts = as_bytes(part.column("text"))
            found = features(texts)
            least = [int(s[0].view(np.int64)) if len(s) else 0 for s in shingle_sets(texts, COPY_WORDS)]
            yield pa.RecordBatch.from_arrays([part.column("label"), pa.array(least, pa.int64()), pa.array(found, pa.list_(pa.int64()))], names=["label", "least", "words"])

    sample = training_sample(docs, labels, "toxic", limit).mapInArrow(hashed, "label int, least long, words array<long>")
    # Copies of one text say nothing more about its words: near copies mostly share their least shingle, others do not.
    one = F.row_number().over(Window.partitionBy("label", "least").orderBy("words"))
    sample = stage(sample.withColumn("copy", one).where("copy = 1").select("label", "words"), "toxicity-sample")
    sizes = {row["label"]: row["count"] for row in sample.groupBy("label").count().collect()}
    toxic, other = sizes.get(1, 0), sizes.get(0, 0)
    none = np.zeros(0, np.int64)
    if not toxic or not other:
        return fit([], np.repeat([0, 1], [other, toxic]), none)
    share = F.col("with") / (toxic + other)
    deviations = (F.col("toxic") / toxic - F.col("other") / other) / F.sqrt(share * (1 - share) * (1 / toxic + 1 / other))
    counts = sample.select("label", F.explode("words").alias("word")).groupBy("word").agg(
        F.count("*").alias("with"), F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("other")
    )
    least = min(LEAST_DOCUMENTS, -(-toxic // 2))
    strongest = counts.where((F.col("toxic") >= least) & (F.col("with") < toxic + other)).withColumn("deviations", deviations)
    found = strongest.where("deviations > 0").orderBy(F.desc("deviations"), "word").limit(WORDS).collect()
    bar = min(LEAST_DEVIATIONS, OF_STRONGEST * found[0]["deviations"]) if found else 0.0
    words = np.sort(np.array([row["word"] for row in found if row["deviations"] >= bar], np.int64))
    if not len(words):
        return fit([], np.repeat([0, 1], [other, toxic]), none)
    known = F.array_sort(F.array_intersect("words", F.array(*[F.lit(int(w)) for w in words])))
    # The sample comes in any order; the model must not depend on it.
    rows = sorted(sample.select("label", known.alias("known")).collect(), key=lambda row: (row["label"], row["known"]))
    numbers = [np.searchsorted(words, np.array(row["known"], np.int64)) for row in rows]
    is_toxic = np.array([row["label"] for row in rows]) == 1
    variety = np.array([len(n) for n in numbers])
    thirds = np.quantile(variety[is_toxic], np.arange(1, GRADES) / GRADES)
    grades = np.where(is_toxic, 1 + (variety[:, None] > thirds).sum(axis=1), 0)
    return fit(numbers, grades, words)


def score(docs: DataFrame, model: Severity, *, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, held_out, p_toxic (grade 1 or more), expected_severity (0 to 3), grade (the likeliest), toxic.

    NULL text counts as empty; a text without any chosen word gets the chances that the thresholds alone give. doc_id may
    be NULL (then the row is not held out) or repeated. A model that does not decide calls no text toxic. Other
    columns are not read.
    """

    def run(batches):
        for part in slices(batches):
            above = model.above(as_bytes(part.column("text")))
            steps = np.concatenate([np.ones((len(above), 1)), above, np.zeros((len(above), 1))], axis=1)
            arrays = [part.column("doc_id"), pa.array(above[:, 0]), pa.array(above.sum(axis=1)), pa.array((-np.diff(steps, axis=1)).argmax(axis=1), pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, names=SCHEMA.names)

    found = docs.select(docs["doc_id"].cast("long"), text_or_empty(docs).alias("text")).mapInArrow(run, SCHEMA)
    toxic = ((F.col("p_toxic") >= threshold) & F.lit(model.decides)).alias("toxic")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "p_toxic", "expected_severity", "grade", toxic)


def keep_clean(docs: DataFrame, model: Severity, *, threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose text is less likely toxic than the threshold, with all their columns; all rows if the model does not
    decide. NULL and empty texts have no word and stay with the chances of the thresholds alone; repeated rows are each
    judged by their text. An empty table gives no rows."""
    if not model.decides:
        return docs

    def run(batches):
        for part in slices(batches):
            texts = [text or b"" for text in as_bytes(part.column("text"))]
            yield part.filter(pa.array(model.above(texts)[:, 0] < threshold))

    return docs.mapInArrow(run, docs.schema)
