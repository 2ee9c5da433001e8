"""What the Arrow-batched operators share: numbered rows, bounded slices of a batch, and normalised bytes of a text."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable, Iterator
from typing import TypeVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filefeatures.session import stage

ROW = "__row"
Kept = TypeVar("Kept")
_kept: dict[Hashable, object] = {}
UPPER = bytes(range(ord("A"), ord("Z") + 1))
TO_LOWER = bytes.maketrans(UPPER, UPPER.lower())
SLICE_BYTES = 4 << 20
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20


def ascii_lower(text: bytes) -> bytes:
    """Lower-case A-Z only; every other byte stays."""
    return text.translate(TO_LOWER)


def kept_in_worker(key: Hashable, make: Callable[[], Kept]) -> Kept:
    """What an operator has learnt, for the later tasks of a Python worker. A worker keeps one thing at a time, so that the
    stages of a pipeline don't add up in its memory."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def bound_batches(spark: SparkSession) -> None:
    """Let Spark hand texts to Python in batches of some megabytes, unless the session says otherwise: the default of 64 MB
    is held several times, on both sides, for each task of an executor."""
    if spark.conf.get(BATCH_SETTING) == "67108864b":
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def text_or_empty(docs: DataFrame, text: str = "text") -> Column:
    return F.coalesce(docs[text].cast("string"), F.lit(""))


def unused(docs: DataFrame, name: str) -> str:
    """The name, or a longer one where docs has a column of that name."""
    taken = {column.lower() for column in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(docs: DataFrame, name: str = ROW) -> DataFrame:
    """docs with the number of each row, written once: every later job reads the number with its row, however files are
    split by then (that follows the executors that are alive)."""
    return stage(docs.withColumn(name, F.monotonically_increasing_id()), "numbered")


def as_bytes(column: pa.Array) -> list[bytes]:
    return pc.cast(column, pa.binary()).to_pylist()


def slices(batches: Iterable[pa.RecordBatch], text: str = "text", max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of about max_bytes of text, so that a task's memory does not follow the batch size.

    A single text is never cut; a slice has one row at least.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        share = (np.cumsum(sizes, dtype=np.int64) - sizes) // max_bytes
        starts = np.flatnonzero(np.diff(share, prepend=-1))
        for start, end in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            yield batch.slice(int(start), int(end - start))


def splitmix(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit words (the finaliser of SplitMix64)."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
