"""Category labels that follow a stream: counts merge, known labels keep their index, new ones are appended.

Every version of the label table is a folder of its own, and a commit says which one counts, with the batch that it came
from; so a batch that is repeated after a failure is counted once. Ranking all labels anew by their counts begins another
epoch: an index means the same label in all versions of one epoch.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from filefeatures.operators.labels import ONE_WINDOW_LABELS, LabelModel, encode, load_labels, rank_counts
from filefeatures.operators.lookup import key_part
from filefeatures.operators.select import quoted
from filefeatures.session import scratch_scope, stage
from filefeatures.sinks.commits import Overtaken, commits, publish
from filefeatures.streaming.rows import _write_batch, for_each_batch

COMMITS = "_commits"


@dataclass(frozen=True)
class LabelHistory:
    """The versions of a label table below a folder. One stream adds to it; any number of readers follow."""

    spark: SparkSession
    folder: str

    def last(self) -> dict | None:
        """The commit that counts: number, epoch, batch, table."""
        found = commits(self.spark, f"{self.folder}/{COMMITS}")
        return found[-1] if found else None

    def model(self) -> LabelModel | None:
        last = self.last()
        return load_labels(self.spark, f"{self.folder}/{last['table']}") if last else None

    def add(self, rows: DataFrame, column: str, batch: int, *, one_window_labels: int = ONE_WINDOW_LABELS) -> int:
        """Count the labels of a batch into the table; gives the epoch. A batch that is in it already changes nothing.

        Batches come in rising order, as a stream numbers them. The counts of the batch are combined before they are
        shuffled; after that there is one row per label. New labels get the next indices, the batch's most frequent first,
        ties by label. NULL is counted and has no index.
        """
        last = self.last()
        if last and last["batch"] is not None and batch <= last["batch"]:
            return last["epoch"]
        label = F.col(quoted(column)).cast("string").alias("label")
        counts = stage(rows.groupBy(label).agg(F.count(F.lit(1)).alias("rows")), "batch-labels")
        if last is None:
            table = rank_counts(counts, (), counts.count(), one_window_labels=one_window_labels)
            return self._commit(table, None, 0, batch)
        old = load_labels(self.spark, f"{self.folder}/{last['table']}")
        keyed = counts.select(key_part(F.col("label")).alias("key"), F.col("label").alias("new_label"), F.col("rows").alias("more"))
        known = old.table.select(key_part(F.col("label")).alias("key"), "label", "idx", "rows")
        both = stage(known.join(keyed, "key", "full"), "merged-labels")
        first_seen = both.where("label IS NULL AND new_label IS NOT NULL").select(F.col("new_label").alias("label"), F.col("more").alias("rows"))
        ranked = rank_counts(first_seen, (), first_seen.count(), one_window_labels=one_window_labels)
        appended = ranked.select("label", (F.col("idx") + old.labels).cast("int").alias("idx"), "rows")
        kept = both.where("label IS NOT NULL OR new_label IS NULL")
        kept = kept.select("label", "idx", (F.coalesce("rows", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("rows"))
        return self._commit(kept.unionByName(appended), last, last["epoch"], batch)

    def rerank(self, *, one_window_labels: int = ONE_WINDOW_LABELS) -> int:
        """Begin a new epoch, with indices by falling frequency over all that was counted; gives its number."""
        last = self.last()
        if last is None:
            raise ValueError(f"{self.folder} has no labels yet")
        old = load_labels(self.spark, f"{self.folder}/{last['table']}")
        table = rank_counts(old.table.select("label", "rows"), (), old.table_rows, one_window_labels=one_window_labels)
        return self._commit(table, last, last["epoch"] + 1, last["batch"])

    def _commit(self, table: DataFrame, last: dict | None, epoch: int, batch: int | None) -> int:
        name = f"version={uuid.uuid4().hex}"
        staged = stage(table.select("label", "idx", "rows"), "labels")
        labels = staged.where("label IS NOT NULL").count()
        staged.select("label", "idx", F.lit(labels).cast("long").alias("n"), "rows").write.parquet(f"{self.folder}/{name}")
        facts = {"epoch": epoch, "batch": batch, "table": name}
        try:
            publish(self.spark, f"{self.folder}/{COMMITS}", facts, after=last["number"] if last else 0)
        except Overtaken:
            raise Overtaken(f"another stream adds to {self.folder}") from None
        return epoch


def append_encoded(
    stream: DataFrame,
    column: str,
    out: str,
    history: LabelHistory,
    path: str,
    checkpoint: str,
    *,
    derive: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Encode each micro-batch with labels that follow the stream, and write it as parquet with its `label_epoch`.

    A batch owns the folder `batch_id=N`. Repeated after a failure it replaces itself and is not counted twice; its vectors
    may then be as wide as labels of later batches made the table, with the same indices.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(batch.sparkSession):
            rows = stage(derive(batch), "batch")
            epoch = history.add(rows, column, batch_id)
            encoded = encode(rows, history.model(), column, out)
            _write_batch(encoded.withColumn("label_epoch", F.lit(epoch)), batch_id, path)

    return for_each_batch(stream, handle, checkpoint, trigger=trigger)
