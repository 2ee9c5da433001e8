"""Writing CSV folders. Output is parallel: one part file per task, each with its own header if asked."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filefeatures.contracts import CSV_OPTIONS, SOURCE_FILE
from filefeatures.session import scratch_scope, stage


def write_csv(df: DataFrame, path: str, *, header: bool = True, quote_all: bool = False, mode: str = "error"):
    df.write.options(**CSV_OPTIONS, header=header, quoteAll=quote_all).mode(mode).csv(path)


def write_single_csv(df: DataFrame, path: str, *, quote_all: bool = False, mode: str = "error") -> None:
    """One part file, with one header. One task writes it, so it is for results that one machine's disk holds; the rows
    are computed in parallel and staged before."""
    with scratch_scope(df.sparkSession):
        write_csv(stage(df).coalesce(1), path, quote_all=quote_all, mode=mode)


def write_by_source(
    df: DataFrame,
    path: str,
    *,
    by: str = SOURCE_FILE,
    header: bool = False,
    quote_all: bool = False,
    clustered: bool = False,
) -> None:
    """One folder per source, named after it; a rerun replaces the folders of the sources it holds.

    Rows that are not yet clustered by source are rebalanced: adaptive execution packs small sources
    together and splits a large one over many tasks. `clustered` says that this was done before.
    """
    rows = df if clustered else df.hint("rebalance", F.col(by))
    (
        rows.write.options(**CSV_OPTIONS, header=header, quoteAll=quote_all)
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .partitionBy(by)
        .csv(path)
    )


def escaped(value: str) -> str:
    """A value as Spark writes it into a folder's name."""
    return re.sub(r"[\x00-\x1f\"#%'*/:=?\\\x7f{\[\]^]", lambda found: f"%{ord(found[0]):02X}", value)


def dump_features(df: DataFrame, path: str, **how: object) -> None:
    """Features for a human eye: header, every value quoted, one folder per source file."""
    write_by_source(df, path, header=True, quote_all=True, **how)


def write_model_input(df: DataFrame, path: str, **how: object) -> None:
    """Features for a model: no header, one folder per source file."""
    write_by_source(df, path, header=False, **how)
