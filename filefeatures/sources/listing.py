"""Listings of files, without reading what is in them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filefeatures.functions.paths import file_route, plain_path
from filefeatures.functions.text import last_path_segment

# The fixed schema of the binary file source; `content` is never selected, so it is never read.
LISTING_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def list_files(spark: SparkSession, folder: str | list[str], glob: str = "*", *, recursive: bool = True) -> DataFrame:
    """One row per non-empty file: path, file_name, modified, bytes."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", str(recursive).lower())
        .load(folder)
    )
    return describe_files(files)


def describe_files(files: DataFrame) -> DataFrame:
    return files.select(
        "path",
        last_path_segment(F.col("path")).alias("file_name"),
        F.col("modificationTime").alias("modified"),
        F.col("length").alias("bytes"),
    )


def route_files(files: DataFrame, root: str = "", **patterns: str) -> DataFrame:
    """Add `route` (IN, OUT or SKIP) to a listing; patterns match the path below `root`."""
    return files.withColumn("route", file_route(plain_path(F.col("path"), root), **patterns))
