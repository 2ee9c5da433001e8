"""Embedding whitening by polarisation covariance.

Every entry c becomes an integer, so sums are exact. With n vectors and sums S, y = n * x - S is an integer too, and n
times as far from zero as x is from its mean. Spark adds up y_i ** 2 for every dimension and (y_i + y_j) ** 2 for every
pair of dimensions; as a variance of a sum is the two variances and twice the covariance, their differences give all
covariances, still exact. Only then come floating-point numbers: the matrix, as wide as a vector is long, goes to eigh on
the driver, and a row is centred, projected and scaled by itself.

Tasks add up their own rows and give one row per dimension or pair; Spark adds these as decimals. What reaches the driver
follows the length of a vector, never the number of rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filefeatures.session import stage

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
LIMB = 31
LOW = (1 << LIMB) - 1
ROWS_AT_ONCE = 4096

SUMS = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("j", T.IntegerType()), T.StructField("total", T.DecimalType(38, 0))])
WHITE = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("deviation", T.LongType()),
        T.StructField("whitened", T.ArrayType(T.DoubleType())),
    ]
)


@dataclass(frozen=True)
class Whitening:
    """n vectors, the exact sums of their dimensions, and the leading components by falling eigenvalue."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray


def whole_vectors(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, embedding as doubles) of the rows whose vector is not NULL and holds neither NULL nor non-finite entries."""
    entries = vectors[vector].cast("array<double>")
    bad = F.exists(entries, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(entries.isNotNull() & ~bad).select(vectors[key].cast("long").alias("vec_id"), entries.alias("embedding"))


def _integers(batch: pa.RecordBatch) -> np.ndarray:
    """The batch's vectors as rows of exact integers."""
    column = batch.column("embedding")
    flat = np.floor(SCALE * column.flatten().to_numpy())
    if len(flat) and np.abs(flat).max() >= 2.0**62:
        raise ValueError(f"an entry of {np.abs(flat).max() / SCALE:g} is too large for a 64-bit integer at scale {SCALE}")
    return flat.astype(np.int64).reshape(batch.num_rows, -1) + SHIFT


def _parts(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def _total(values: np.ndarray) -> list[int]:
    """Exact column sums of integers under 2 ** 62 in size: two limbs, each added up in 64 bits."""
    high, low = (values >> LIMB).sum(axis=0), (values & LOW).sum(axis=0)
    return [(int(h) << LIMB) + int(k) for h, k in zip(high, low, strict=True)]


def _squares(values: np.ndarray) -> list[int]:
    """Exact column sums of the squares of such integers."""
    if len(values) and int(np.abs(values).max()) <= LOW:
        return _total(values * values)
    high, low = values >> LIMB, values & LOW
    parts = zip(_total(high * high), _total(high * low), _total(low * low), strict=True)
    return [(a << (2 * LIMB)) + (b << (LIMB + 1)) + c for a, b, c in parts]


def _table(totals: dict[tuple[int, int], int]) -> pa.RecordBatch:
    i, j = zip(*totals, strict=True)
    values = pa.array([Decimal(v) for v in totals.values()], pa.decimal128(38, 0))
    return pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), values], names=SUMS.names)


def _dimension_sums(batches):
    """Of each task's vectors: (dimension, -1, sum), and (-1, -1, number)."""
    totals = {}
    for part in _parts(batches):
        totals[-1, -1] = totals.get((-1, -1), 0) + part.num_rows
        for i, total in enumerate(_total(_integers(part))):
            totals[i, -1] = totals.get((i, -1), 0) + total
    if totals:
        yield _table(totals)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S, checked to stay where sums of two of them can be split into limbs."""
    if len(x) and n * float(np.abs(x).max()) >= 2.0**61:
        raise ValueError(f"{n} vectors with entries up to {np.abs(x).max()} are too many for exact 64-bit deviations")
    return n * x - sums


def _pair_sums(n: int, sums: np.ndarray):
    """Of each task's vectors: the sum of y_i ** 2 for i = j, and of (y_i + y_j) ** 2 for i < j."""

    def run(batches):
        totals = {}
        for part in _parts(batches):
            y = centred(_integers(part), n, sums)
            for i in range(y.shape[1]):
                own = y[:, i:].copy()
                own[:, 1:] += y[:, i : i + 1]
                for j, total in enumerate(_squares(own), i):
                    totals[i, j] = totals.get((i, j), 0) + total
        if totals:
            yield _table(totals)

    return run


def _summed(parts: DataFrame) -> dict[tuple[int, int], int]:
    """One row per dimension or pair of dimensions."""
    return {(row.i, row.j): int(row.total) for row in parts.groupBy("i", "j").agg(F.sum("total").alias("total")).collect()}


def _length(rows: DataFrame) -> int:
    """The length that all vectors have."""
    low, high = rows.agg(F.min(F.size("embedding")), F.max(F.size("embedding"))).first()
    if low != high:
        raise ValueError(f"vectors of {low} and of {high} entries have no common covariance")
    return low or 0


def fit(vectors: DataFrame, *, components: int = COMPONENTS) -> Whitening:
    """The whitening of all vectors of a table: three passes, each adding up before anything is shuffled.

    Vectors that are NULL or hold NULL or non-finite entries are left out; repeated rows count as often as they occur.
    Vectors of different lengths, and entries beyond 2 ** 52, are a ValueError. No vectors give no components; a
    direction without variance has an eigenvalue of zero.
    """
    rows = whole_vectors(vectors)
    length = _length(rows)
    if not length:
        return Whitening(0, (), np.empty((0, 0)), np.empty(0), np.empty(0))
    found = _summed(rows.mapInArrow(_dimension_sums, SUMS))
    n, sums = found[-1, -1], tuple(found[i, -1] for i in range(length))
    squares = _summed(rows.mapInArrow(_pair_sums(n, np.array(sums, np.int64)), SUMS))
    covariance = np.empty((length, length))
    for (i, j), total in squares.items():
        twice = 2 * total if i == j else total - squares[i, i] - squares[j, j]
        covariance[i, j] = covariance[j, i] = twice / (2 * n**3)
    values, directions = np.linalg.eigh(covariance)
    values, directions = values[::-1], directions[:, ::-1]
    trace = float(np.trace(covariance))
    least = abs(values).max() * length * np.finfo(float).eps if length else 0
    values = np.where(values > least, values, 0.0)[:components]
    explained = values / trace if trace else np.zeros(len(values))
    return Whitening(n, sums, directions.T[: len(values)].copy(), values, explained)


def _whiten(model: Whitening):
    sums = np.array(model.sums, np.int64)
    with np.errstate(divide="ignore"):
        scale = np.where(model.eigenvalues > 0, 1 / np.sqrt(model.eigenvalues), np.nan)

    def run(batches):
        for part in _parts(batches):
            y = centred(_integers(part), model.n, sums)
            if (np.square(y.astype(float)).sum(axis=1) >= 2.0**63).any():
                raise ValueError(f"a deviation of {model.n} vectors does not fit a 64-bit integer")
            white = (y / model.n) @ model.components.T * scale
            ends = np.arange(len(y) + 1, dtype=np.int32) * white.shape[1]
            flat = pa.array(white.reshape(-1), from_pandas=True)  # without variance: NULL
            arrays = [part.column("vec_id"), pa.array((y * y).sum(axis=1)), pa.ListArray.from_arrays(ends, flat)]
            yield pa.RecordBatch.from_arrays(arrays, names=WHITE.names)

    return run


def _moments(batches):
    """Sums of the whitened components and of the products of two, task by task."""
    total = None
    for batch in batches:
        if batch.num_rows:
            white = np.nan_to_num(batch.column("whitened").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, -1))
            ones = np.c_[np.ones(len(white)), white]
            total = ones.T @ ones + (0 if total is None else total)
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.reshape(-1).tolist()], pa.list_(pa.float64()))], names=["moments"])


def identity_error(white: DataFrame, varying: np.ndarray) -> float | None:
    """The largest difference between the covariance of the whitened components that vary and the identity."""
    size = len(varying) + 1
    parts = white.select("whitened").mapInArrow(_moments, "moments array<double>").select(F.posexplode("moments"))
    found = dict(map(tuple, parts.groupBy("pos").agg(F.sum("col")).collect()))  # (components + 1) ** 2 rows
    if not found or not varying.any():
        return None
    moments = np.array([found[i] for i in range(size * size)]).reshape(size, size)
    mean = moments[0, 1:] / moments[0, 0]
    covariance = (moments[1:, 1:] / moments[0, 0] - np.outer(mean, mean))[np.ix_(varying, varying)]
    return float(np.abs(covariance - np.eye(len(covariance))).max())


def whiten(vectors: DataFrame, model: Whitening) -> DataFrame:
    """Per vector and component (from 1): vec_id, component, n, deviation, whitened, explained, identity_error.

    deviation is the exact sum over the dimensions of (n * x - S) ** 2; one that does not fit 64 bits is a ValueError.
    Vectors that fit() leaves out give no rows; repeated rows and NULL ids give rows like any other. A component without
    variance has NULL for whitened, and identity_error is that of the others, NULL if there are none. Other columns than
    vec_id and embedding are not read.
    """
    if len(model.eigenvalues):
        white = stage(whole_vectors(vectors).mapInArrow(_whiten(model), WHITE), "whitened")
        error = identity_error(white, model.eigenvalues > 0)
    else:
        none = whole_vectors(vectors).where(F.lit(False))
        white, error = none.select("vec_id", F.lit(0).cast("long").alias("deviation"), F.col("embedding").alias("whitened")), None
    rows = white.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    explained = F.array(*[F.lit(float(x)) for x in model.explained]).cast("array<double>")
    return rows.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
