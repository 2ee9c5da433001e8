"""File-arrival streams: each new file is an event, and a handler gets the ready files of a batch."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from filefeatures.contracts import IN_PATTERN, OUT_PATTERN
from filefeatures.functions.paths import without_scheme
from filefeatures.problems import FileProblem, is_at_fault, is_file_problem, is_read_problem
from filefeatures.session import scratch_scope
from filefeatures.sinks.csv import write_by_source
from filefeatures.sources.csv import file_headers, glob_literal, header_names, read_checked
from filefeatures.sources.listing import LISTING_SCHEMA, describe_files, route_files
from filefeatures.streaming.rows import FILES_PER_BATCH, for_each_batch

log = logging.getLogger(__name__)

Handler = Callable[[Sequence[str], int], None]


def file_arrivals(
    spark: SparkSession, folder: str, *, glob: str = "*", max_files: int = FILES_PER_BATCH, **options: str
) -> DataFrame:
    """New files below a folder as a stream of (path, file_name, modified, bytes); contents are not read.

    `options` go to the file source, such as `cleanSource` to move handled files out of a growing folder.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema(LISTING_SCHEMA)
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files)
        .options(**options)
        .load(folder)
    )
    return describe_files(files)


def watch_files(
    spark: SparkSession,
    folder: str,
    checkpoint: str,
    *,
    on_in: Handler,
    on_out: Handler | None = None,
    quarantine: str | None = None,
    root: str = "",
    in_pattern: str = IN_PATTERN,
    out_pattern: str = OUT_PATTERN,
    max_files: int = FILES_PER_BATCH,
    trigger: dict | None = None,
    **options: str,
) -> StreamingQuery:
    """Hand every new file to the handler of its route, once; files of no route are skipped and logged.

    When a batch fails by the fault of a file, it is halved until the files at fault are found: about twice the
    logarithm of the batch in runs per file. These are written to the `quarantine` folder with the error, and
    the watch goes on. A file that Spark cannot read is at fault if the store gives its bytes, or another file's. Any
    other error, such as a store that is down, stops the watch and leaves the checkpoint, so a restart takes the batch
    again; without a quarantine folder every error does.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = route_files(batch, root, in_pattern=in_pattern, out_pattern=out_pattern).collect()
        for row in rows:
            if row.route == "SKIP":
                log.warning("skipped %s (%s): the name follows no pattern", row.path, row.modified)
        for route, handler in (("IN", on_in), ("OUT", on_out)):
            paths = sorted(row.path for row in rows if row.route == route)
            if paths and handler:
                _handle_files(spark, handler, paths, (batch_id, route), quarantine)

    arrivals = file_arrivals(spark, folder, max_files=max_files, **options)
    return for_each_batch(arrivals, handle, checkpoint, trigger=trigger)


def append_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    out: str,
    quarantine: str,
    checkpoint: str,
    *,
    derive: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    header: bool = True,
    multiline: bool | None = None,
    trigger: dict | None = None,
    max_files: int = FILES_PER_BATCH,
) -> StreamingQuery:
    """Rows of arriving CSV files of one schema, to `out`, a folder per file.

    Rows that do not follow the schema go to `quarantine/rows` with their raw text. A file whose header is another
    goes to `quarantine/files`, and the stream goes on.
    """
    root = without_scheme(folder)

    def handle(paths: Sequence[str], batch_id: int) -> None:
        files = [glob_literal(path) for path in paths]
        found = file_headers(spark, files, None).select("header", "spans").collect()
        wrong = sorted({row.header for row in found if header and header_names(row.header) != schema.names})
        if wrong:
            raise FileProblem(f"columns {wrong} instead of {schema.names}")
        with scratch_scope(spark):
            whole = any(row.spans for row in found) if multiline is None else multiline
            good, bad = read_checked(spark, files, schema, header=header, multiline=whole, glob=None, root=root)
            write_by_source(derive(good), out)
            write_by_source(bad, f"{quarantine}/rows", quote_all=True)

    return watch_files(
        spark,
        folder,
        checkpoint,
        on_in=handle,
        quarantine=f"{quarantine}/files",
        in_pattern=r".*\.csv",
        out_pattern=r"(?!)",
        max_files=max_files,
        trigger=trigger,
    )


def _handle_files(
    spark: SparkSession, handler: Handler, paths: list[str], batch: tuple[int, str], quarantine: str | None
) -> None:
    batch_id, route = batch

    def failures(part: list[str]) -> list[tuple[str, str, int, str]]:
        try:
            handler(part, batch_id)
            return []
        except Exception as error:
            if not quarantine or not (is_file_problem(error) or is_read_problem(error)):
                raise
            if len(part) == 1:
                if not is_at_fault(spark, error, part[0], [path for path in paths if path != part[0]]):
                    raise
                log.exception("put %s into quarantine", part[0])
                return [(part[0], str(error), batch_id, route)]
        log.warning("batch %s failed, trying its %s files by halves", batch_id, len(part))
        middle = len(part) // 2
        return failures(part[:middle]) + failures(part[middle:])

    failed = failures(paths)
    if failed:
        (
            spark.createDataFrame(failed, "path string, error string, batch_id bigint, route string")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id", "route")
            .json(quarantine)
        )
