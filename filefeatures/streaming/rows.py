"""Row streams: CSV files of one promised schema, appended with a prediction or looked-up columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from filefeatures.contracts import CSV_OPTIONS, SOURCE_FILE
from filefeatures.functions.paths import source_file_name
from filefeatures.operators.asof import asof_join
from filefeatures.operators.delivery import require_unique
from filefeatures.operators.lookup import HOT_MIN_ROWS, hot_keys, hot_part, lookup
from filefeatures.operators.select import quoted
from filefeatures.session import scratch_scope
from filefeatures.sources.csv import CHECK_OPTIONS, marked_schema, split_checked

# Files per micro-batch, so that a first run does not take a whole backlog at once.
FILES_PER_BATCH = 1_000
POLL = {"processingTime": "5 seconds"}


def read_csv_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | str,
    *,
    header: bool = True,
    multiline: bool = True,
    glob: str = "*.csv",
    max_files: int = FILES_PER_BATCH,
    **options: str,
) -> DataFrame:
    """New files of a folder as a stream; the schema is part of the contract, nothing is inferred."""
    reader = spark.readStream.schema(schema).options(
        **CSV_OPTIONS, header=header, multiLine=multiline, **options
    )
    if header:
        reader = reader.option("enforceSchema", False)
    reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.option("pathGlobFilter", glob).csv(folder)


def append_csv(
    df: DataFrame, path: str, checkpoint: str, *, header: bool = False, trigger: dict | None = None
) -> StreamingQuery:
    """Append to a CSV folder; with the checkpoint, every row is written exactly once."""
    return (
        df.writeStream.outputMode("append")
        .format("csv")
        .options(**CSV_OPTIONS, header=header)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or POLL))
        .start()
    )


def for_each_batch(
    df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, *, trigger: dict | None = None
) -> StreamingQuery:
    return (
        df.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or POLL))
        .start()
    )


@contextmanager
def _kept(batch: DataFrame) -> Iterator[DataFrame]:
    """The batch, parsed once for several jobs; what an executor loses is read again."""
    kept = batch.persist()
    try:
        yield kept
    finally:
        kept.unpersist()


def _write_batch(df: DataFrame, batch_id: int, path: str) -> None:
    """Write a batch into a folder of its own, so a repeated batch replaces itself."""
    (
        df.withColumn("batch_id", F.lit(batch_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


def append_checked(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    path: str,
    quarantine: str,
    checkpoint: str,
    *,
    trigger: dict | None = None,
    **source: object,
) -> StreamingQuery:
    """Stream CSV rows that follow the schema to `path` and the raw text of the others to `quarantine`."""
    rows = read_csv_stream(spark, folder, marked_schema(schema), **CHECK_OPTIONS, **source)

    def handle(batch: DataFrame, batch_id: int) -> None:
        with _kept(batch) as parsed:
            good, bad = split_checked(parsed)
            _write_batch(good, batch_id, path)
            _write_batch(bad, batch_id, quarantine)

    named = rows.select("*", source_file_name().alias(SOURCE_FILE))
    return for_each_batch(named, handle, checkpoint, trigger=trigger)


def append_lookup(
    stream: DataFrame,
    static: DataFrame,
    keys: Sequence[str],
    path: str,
    checkpoint: str,
    *,
    trigger: dict | None = None,
    hot_min_rows: int = HOT_MIN_ROWS,
) -> StreamingQuery:
    """Left-join each micro-batch to a static table with unique keys and write it as parquet.

    Keys that occur twice in the static table are an error. Hot keys are found per batch and answered from a small
    broadcast; for the rest Spark decides by the size of the static table. A batch owns the folder `batch_id=N`, so a repeated batch replaces itself.
    Rows whose key is NULL stay, spread over the tasks, without looked-up columns.
    """

    require_unique(static, keys)
    keyless = " OR ".join(f"{quoted(key)} IS NULL" for key in keys)

    def handle(batch: DataFrame, batch_id: int) -> None:
        with _kept(batch) as rows, scratch_scope(batch.sparkSession):
            keyed = rows.where(f"NOT ({keyless})")
            hot = hot_keys(keyed, keys, min_rows=hot_min_rows)
            hot = hot_part(static, hot, keys) if hot is not None else None
            joined = lookup(keyed, static, keys, hot)
            _write_batch(joined.unionByName(rows.where(keyless), allowMissingColumns=True), batch_id, path)

    return for_each_batch(stream, handle, checkpoint, trigger=trigger)


def append_asof(
    stream: DataFrame,
    versions: Callable[[], DataFrame],
    keys: Sequence[str],
    path: str,
    checkpoint: str,
    *,
    time: str,
    valid_from: str,
    valid_to: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Join each micro-batch to the versions of a table that changes (see `asof_join`) and write it as parquet.

    `versions` is called for every batch, so versions that were added meanwhile are seen. A row's answer depends on its own
    time, not on when it arrives: only a version that is added after a row was written comes too late for it. A batch owns
    the folder `batch_id=N`, so a repeated batch replaces itself.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(batch.sparkSession):
            joined = asof_join(batch, versions(), keys, time=time, valid_from=valid_from, valid_to=valid_to)
            _write_batch(joined, batch_id, path)

    return for_each_batch(stream, handle, checkpoint, trigger=trigger)
