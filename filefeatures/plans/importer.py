"""One-shot import: inferred types, required columns, a constant, one CSV folder out."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filefeatures.contracts import IMPORT_COLUMNS, SOURCE_FILE
from filefeatures.functions.paths import without_scheme
from filefeatures.operators.select import add_constant, match_columns, quoted, select_strict
from filefeatures.operators.types import typed
from filefeatures.session import scratch_scope, stage
from filefeatures.sinks.csv import write_by_source, write_csv
from filefeatures.sources.csv import CORRUPT, read_by_header, read_csv, split_checked


def import_rows(df: DataFrame, columns: Iterable[str] = IMPORT_COLUMNS) -> DataFrame:
    return add_constant(select_strict(df, columns), "PurchaseComplete", 1)


def run_import(
    spark: SparkSession,
    folder: str,
    out: str,
    columns: Iterable[str] = IMPORT_COLUMNS,
    *,
    multiline: bool | None = None,
) -> DataFrame:
    """Import all the CSV files of a folder; gives the rows as written.

    Values go by the name of their column, whatever its place in a file; a file that lacks one of `columns` is an error, and
    nothing is written then. A column's type is one that all its texts print back from. Rows with more or fewer values than
    their header go to `<out>-bad-rows` with their raw text. The text is parsed once.
    """
    columns = list(columns)
    with scratch_scope(spark):
        rows = read_by_header(spark, folder, multiline=multiline, root=without_scheme(folder), marked=True, required=columns)
        wanted = [F.col(quoted(have)).alias(name) for name, have in match_columns(rows.columns, columns).items()]
        good, bad = split_checked(stage(rows.select(*wanted, SOURCE_FILE, CORRUPT)))
        rows = import_rows(typed(good.drop(SOURCE_FILE)), columns)
        write_csv(rows, out)
        write_by_source(bad, f"{out.rstrip('/')}-bad-rows", quote_all=True)
    return read_csv(spark, out, schema=rows.schema)
