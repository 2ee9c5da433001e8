"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. Sizes (executors, memory, shuffle partitions) belong to spark-submit.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder path below the shared checkpoint folder; nothing is created yet.

    Every executor must see what is written there, so a machine-local folder is only used in local mode.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.gettempdir()
    folder = f"{root.rstrip('/')}/filefeatures-{purpose}-{uuid.uuid4()}"
    made = _folders_in_scope.get()
    if made is not None:
        made.append(folder)
    return folder


_folders_in_scope: ContextVar[list[str] | None] = ContextVar("folders_in_scope", default=None)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch folders made inside when it ends; DataFrames that read them end with it."""
    made: list[str] = []
    token = _folders_in_scope.set(made)
    try:
        yield
    finally:
        _folders_in_scope.reset(token)
        for folder in made:
            delete_folder(spark, folder)


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder in whatever store it is; PySpark has no call for that but Hadoop's own."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its scheme and from the root, as Spark names the files that it reads."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return store.makeQualified(folder).toString()


def is_file(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(store.exists(place) and not store.getFileStatus(place).isDirectory())


def stage(df: DataFrame, purpose: str = "staged") -> DataFrame:
    """Write the rows once to the shared scratch folder and go on from there.

    For a plan that several later jobs need: they read the narrow result, not the raw text again, and a
    lost executor costs no more than its own part.
    """
    folder = scratch_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let the Python workers import this package wherever it lies on the driver; once per application."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        _shipped.add(application)
        package = Path(__file__).resolve().parent
        archive = f"{tempfile.mkdtemp()}/{package.name}"
        spark.sparkContext.addPyFile(shutil.make_archive(archive, "zip", package.parent, package.name))
