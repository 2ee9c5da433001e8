"""Quarantined rows that come back repaired, each through the job once, however often a replay is run."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filefeatures.contracts import CSV_OPTIONS, SOURCE_FILE
from filefeatures.operators.delivery import require_unique
from filefeatures.operators.select import quoted
from filefeatures.session import stage
from filefeatures.sinks.commits import commits, publish
from filefeatures.sources.csv import CHECK_OPTIONS, CORRUPT, marked_schema

COMMITS, ROWS, DONE = "_commits", "rows", "done"


def row_id() -> Column:
    """What a bad row is known by: its file and its text. Rows of one file with the same text are the same problem."""
    file, line = F.col(SOURCE_FILE), F.col("line")
    return F.sha2(F.concat(F.octet_length(file).cast("string"), F.lit(":"), file, line), 256)


def quarantined(bad: DataFrame) -> DataFrame:
    """(id, source_file, line, copies) of bad rows (source_file, line); equal rows are counted before they are shuffled."""
    rows = bad.select(F.coalesce(SOURCE_FILE, F.lit("")).alias(SOURCE_FILE), F.coalesce("line", F.lit("")).alias("line"))
    counted = rows.groupBy(SOURCE_FILE, "line").agg(F.count(F.lit(1)).alias("copies"))
    return counted.select(row_id().alias("id"), SOURCE_FILE, "line", "copies")


@dataclass(frozen=True)
class Replays:
    """What replays have given, below a folder: every replay writes its rows and the ids that they stand for, and then
    commits both. One replay at a time owns the folder."""

    spark: SparkSession
    folder: str

    def _tables(self, kind: str) -> list[str]:
        return [f"{self.folder}/{kind}/{commit['table']}" for commit in commits(self.spark, f"{self.folder}/{COMMITS}")]

    def done(self) -> DataFrame:
        """(id) of the rows that went through."""
        tables = self._tables(DONE)
        return self.spark.read.schema("id string").parquet(*tables) if tables else self.spark.createDataFrame([], "id string")

    def rows(self) -> DataFrame | None:
        """What the job made of all of them; None before the first replay."""
        tables = self._tables(ROWS)
        return self.spark.read.parquet(*tables) if tables else None

    def replay(
        self,
        quarantine: DataFrame,
        repairs: DataFrame,
        schema: T.StructType,
        job: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    ) -> DataFrame:
        """Send repaired lines (id, line) through the job; gives (id, line) of those that still break the schema.

        A line stands for all copies of the bad row. What went through before is left out, as are repairs of unknown rows;
        two repairs of one row are an error. A line that breaks the schema can be repaired again. When a replay fails,
        nothing of it counts. `job` gets the columns of the schema and `source_file`.
        """
        require_unique(repairs, ["id"])
        fixed = repairs.select("id", F.col("line").alias("_text"))
        open_ = quarantine.select("id", SOURCE_FILE, "copies").join(fixed, "id").join(self.done(), "id", "left_anti")
        ddl = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in marked_schema(schema))
        parsed = F.from_csv("_text", ddl, {**CSV_OPTIONS, **{k: CHECK_OPTIONS[k] for k in ("mode", "columnNameOfCorruptRecord")}})
        rows = stage(open_.withColumn("_row", parsed), "repaired")
        broken = F.col(f"_row.{CORRUPT}").isNotNull() | F.col("_text").isNull()
        good = rows.where(~broken)
        copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
        again = good.withColumn("_copy", copies).select(*[F.col(f"_row.{quoted(f.name)}") for f in schema], SOURCE_FILE)
        name = f"replay={uuid.uuid4().hex}"
        job(again).write.parquet(f"{self.folder}/{ROWS}/{name}")
        good.select("id").write.parquet(f"{self.folder}/{DONE}/{name}")
        publish(self.spark, f"{self.folder}/{COMMITS}", {"table": name})
        return rows.where(broken).select("id", F.col("_text").alias("line"))
