"""One commit for all the outputs of a run.

Every run writes its outputs into folders of its own, `<out>/<output>/run=<id>/<by>=<source>/`, that nobody reads yet. It
then becomes visible as a whole: a small file with the next number is put under `<out>/_runs` by one rename that fails if
the number is taken. It names the sources that the run has read; of each source, the run with the highest number counts,
for every output alike, also where it wrote no row. A run that fails on its way leaves everything as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filefeatures.contracts import CSV_OPTIONS, SOURCE_FILE
from filefeatures.functions.paths import decoded, without_scheme
from filefeatures.session import delete_folder, qualified
from filefeatures.sinks.commits import commits, publish
from filefeatures.sinks.csv import escaped
from filefeatures.sources.csv import read_by_header

COMMITS, SOURCES = "_runs", "_sources"


class Run:
    """The outputs of one run: written below `path(output)`, seen by readers after `commit`."""

    def __init__(self, spark: SparkSession, out: str, outputs: Sequence[str], *, by: str = SOURCE_FILE):
        self.spark, self.out, self.outputs, self.by = spark, out.rstrip("/"), tuple(outputs), by
        self.id = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex}"

    def path(self, output: str) -> str:
        if output not in self.outputs:
            raise ValueError(f"{output} is not one of {self.outputs}")
        return f"{self.out}/{output}/run={self.id}"

    def commit(self, sources: DataFrame, *, clean: bool = True) -> int:
        """Make the run visible for these sources (one column, `by`); gives its number.

        With `clean`, the folders that no reader sees any more are removed afterwards. A reader that has begun before may
        then miss files; without it, `remove_superseded` does that later.
        """
        names = sources.select(F.col(self.by).alias("source")).distinct()
        names.withColumn("run", F.lit(self.id)).write.parquet(f"{self.out}/{SOURCES}/{self.id}")
        number = publish(self.spark, f"{self.out}/{COMMITS}", {"run": self.id, "complete": False})
        if clean:
            own = self.spark.read.parquet(f"{self.out}/{SOURCES}/{self.id}").select("source")
            remove_superseded(self.spark, self.out, self.outputs, by=self.by, sources=own)
        return number

    def abandon(self) -> None:
        """Remove what the run has written, after a failure."""
        for output in self.outputs:
            delete_folder(self.spark, self.path(output))
        delete_folder(self.spark, f"{self.out}/{SOURCES}/{self.id}")


def counting_commits(spark: SparkSession, out: str) -> list[dict]:
    """The commits (number, run, complete) that count: from the last one on that lists all sources."""
    found = commits(spark, f"{out.rstrip('/')}/{COMMITS}")
    whole = max((i for i, commit in enumerate(found) if commit["complete"]), default=0)
    return found[whole:]


def _history(spark: SparkSession, out: str) -> DataFrame:
    """(source, run, number): which run has written which source, by commit."""
    known = counting_commits(spark, out)
    if not known:
        return spark.createDataFrame([], "source string, run string, number long")
    folders = [f"{out.rstrip('/')}/{SOURCES}/{commit['run']}" for commit in known]
    rows = spark.read.schema("source string, run string").parquet(*folders)
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    numbers = spark.createDataFrame([(commit["run"], commit["number"]) for commit in known], "folder string, number long")
    return rows.withColumn("folder", folder).join(F.broadcast(numbers), "folder").drop("folder")


def current_sources(spark: SparkSession, out: str) -> DataFrame:
    """(source, run): for each source the run whose outputs count."""
    return _history(spark, out).groupBy("source").agg(F.max_by("run", "number").alias("run"))


def read_output(spark: SparkSession, out: str, output: str, *, schema: T.StructType | str | None = None, by: str = SOURCE_FILE) -> DataFrame:
    """The rows of an output that count, with their source.

    Without a schema the files have headers, which may differ from run to run: columns are aligned by name and all text.
    With one, the files have no header and its columns. What was written without a commit does not count; an output that
    no run has written is an error.
    """
    folder = f"{out.rstrip('/')}/{output}"
    if schema is None:
        rows = read_by_header(spark, f"{folder}/run=*/*", root=without_scheme(qualified(spark, folder)))
        place = F.col(SOURCE_FILE)
    else:
        rows = spark.read.options(**CSV_OPTIONS, multiLine=True, recursiveFileLookup=True).schema(schema).csv(folder)
        place = decoded(F.col("_metadata.file_path"))
    names = [c for c in rows.columns if c != SOURCE_FILE]
    # What Spark has escaped in a folder's name is escaped once more nowhere: a %2F there stands for a slash.
    run, source = F.regexp_extract(place, "run=([^/]*)/", 1), decoded(F.regexp_extract(place, f"/{by}=([^/]*)/", 1))
    rows = rows.select("*", run.alias("_run"), source.alias("_source"))
    current = current_sources(spark, out).select(F.col("run").alias("_run"), F.col("source").alias("_source"))
    kept = rows.join(current, ["_run", "_source"])
    return kept.select(*[_column(name) for name in names], F.col("_source").alias(by))


def _column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def remove_superseded(
    spark: SparkSession, out: str, outputs: Iterable[str], *, by: str = SOURCE_FILE, sources: DataFrame | None = None
) -> None:
    """Remove the folders that an earlier run wrote for sources that a later one has replaced, of all or of these sources."""
    history = _history(spark, out)
    if sources is not None:
        history = history.join(sources, "source", "left_semi")
    old = history.select("source", "run").distinct().join(current_sources(spark, out), ["source", "run"], "left_anti")
    outputs = list(outputs)
    for row in old.toLocalIterator():
        for output in outputs:
            delete_folder(spark, f"{out.rstrip('/')}/{output}/run={row.run}/{by}={escaped(row.source)}")


def merge_commits(spark: SparkSession, out: str) -> int:
    """One commit that lists all sources, so that readers need no earlier one."""
    run = f"merged-{uuid.uuid4().hex}"
    current_sources(spark, out).write.parquet(f"{out.rstrip('/')}/{SOURCES}/{run}")
    return publish(spark, f"{out.rstrip('/')}/{COMMITS}", {"run": run, "complete": True})
