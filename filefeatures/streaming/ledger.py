"""An arrival ledger: which version of every file was taken, so that a re-upload under the same name is taken again.

A file source of a stream takes a path once. Here a folder is listed and compared with the ledger: a file whose path is new,
or whose length or time differ from the last version, is looked into; if its lines are other ones it is a new version, if
not, a repeated delivery. Lines are read in splits and added up, so a file's size does not matter. What one pass has found is
a table of its own, made part of the ledger by one commit after its files were handled.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filefeatures.functions.paths import decoded, plain_path
from filefeatures.session import scratch_scope, stage
from filefeatures.sinks.commits import commits, publish
from filefeatures.sources.csv import glob_literal
from filefeatures.sources.listing import list_files

COMMITS = "_commits"
ENTRY = "path string, version int, bytes long, modified timestamp, lines long, digest string, news boolean"


def content_digests(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, lines, digest) of files: equal for files of the same lines, in any order.

    Two sums of 64-bit hashes and the number of lines stand for the lines; they are added up where a split is read.
    """
    if not paths:
        return spark.createDataFrame([], "path string, lines long, digest string")
    text = spark.read.text([glob_literal(path) for path in paths])
    path = plain_path(decoded(F.col("_metadata.file_path"))).alias("path")
    lines = text.select(path, *[F.xxhash64("value", F.lit(seed)).cast("decimal(38,0)").alias(f"h{seed}") for seed in (1, 2)])
    sums = lines.groupBy("path").agg(F.count(F.lit(1)).alias("lines"), F.sum("h1").alias("h1"), F.sum("h2").alias("h2"))
    return sums.select("path", "lines", F.sha2(F.concat_ws(" ", "lines", "h1", "h2"), 256).alias("digest"))


def merge_entries(entries: DataFrame) -> DataFrame:
    """The last entry of each path, of any number of ledgers or parts of one; with the news of its last version only."""
    last = F.max_by(F.struct(*[c for c in entries.columns if c != "path"]), F.struct("version", "modified", "news"))
    return entries.groupBy("path").agg(last.alias("last")).select("path", "last.*")


class Ledger:
    """What was taken from one input folder, below a folder of its own."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def entries(self) -> DataFrame:
        """Every entry of every pass, the last of a path being its state."""
        tables = [f"{self.folder}/{commit['table']}" for commit in commits(self.spark, f"{self.folder}/{COMMITS}")]
        return self.spark.read.schema(ENTRY).parquet(*tables) if tables else self.spark.createDataFrame([], ENTRY)

    def versions(self) -> DataFrame:
        """(path, version, bytes, modified, lines, digest) of every version that was taken."""
        return self.entries().where("news").drop("news")

    def arrivals(self, folder: str, glob: str = "*.csv") -> DataFrame:
        """What a pass would add: new versions (`news`), and files that were only delivered again; with the `uri` to read.

        Only files that look changed are read. Empty files are not listed.
        """
        listed = list_files(self.spark, folder, glob)
        listed = listed.select(plain_path(F.col("path")).alias("path"), F.col("path").alias("uri"), "bytes", "modified")
        known = merge_entries(self.entries())
        old = known.select("path", *[F.col(name).alias(f"old_{name}") for name in ("version", "bytes", "modified", "digest")])
        both = listed.join(old, "path", "left")
        changed = stage(both.where("old_version IS NULL OR bytes <> old_bytes OR modified <> old_modified"), "changed-files")
        paths = [row.uri for row in changed.select("uri").toLocalIterator()]
        found = changed.join(content_digests(self.spark, paths), "path", "left")
        digest = F.coalesce("digest", F.lit(""))
        news = F.col("old_digest").isNull() | (digest != F.col("old_digest"))
        version = F.coalesce("old_version", F.lit(0)) + F.when(news, 1).otherwise(0)
        lines = F.coalesce("lines", F.lit(0)).alias("lines")
        return found.select("path", version.alias("version"), "bytes", "modified", lines, digest.alias("digest"), news.alias("news"), "uri")

    def add(self, arrivals: DataFrame) -> int:
        """Make a pass part of the ledger; gives its number."""
        name = f"pass={uuid.uuid4().hex}"
        arrivals.drop("uri").write.parquet(f"{self.folder}/{name}")
        return publish(self.spark, f"{self.folder}/{COMMITS}", {"table": name})

    def take(self, folder: str, handler: Callable[[Sequence[str], int], None], glob: str = "*.csv") -> int:
        """One pass: new versions go to the handler, with the number of the pass; gives how many files these were.

        The ledger knows them when the handler has returned. If it fails, the next pass hands them over again, so a handler
        replaces what it wrote before for a file, as `features_handler` does. One taker at a time owns a ledger.
        """
        with scratch_scope(self.spark):
            found = stage(self.arrivals(folder, glob), "arrivals")
            paths = sorted(row.uri for row in found.where("news").select("uri").collect())
            if paths:
                handler(paths, 1 + len(commits(self.spark, f"{self.folder}/{COMMITS}")))
            if paths or not found.isEmpty():
                self.add(found)
        return len(paths)
