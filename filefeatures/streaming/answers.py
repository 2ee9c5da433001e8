"""Predictions that arrive later: two streams joined with watermarks; and files that wait for an answer."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from filefeatures.operators.select import quoted
from filefeatures.streaming.rows import POLL


def join_answers(
    features: DataFrame,
    predictions: DataFrame,
    keys: Sequence[str],
    *,
    asked_at: str,
    answered_at: str,
    wait: str = "1 hour",
    late: str = "10 minutes",
) -> DataFrame:
    """A stream of features with its predictions, NULL for a feature that was not answered within `wait`.

    A feature row meets the prediction of the same keys whose time lies from `asked_at` to `wait` after it. What is kept of
    either stream ends there: when both streams have passed that time by `late`, an unanswered row goes out without a
    prediction, once, and what comes for it later is dropped. So the state is what arrives within `wait` and `late`, not
    the history of the streams. Two predictions of one key in that time give two rows. A NULL key is never answered. Rows
    that are behind the watermark when they arrive, or have no time, are not taken. Only the keys may have the same name
    in both streams.
    """
    keys = list(keys)
    added = [name for name in predictions.columns if name not in keys]
    clash = sorted({name.lower() for name in added} & {name.lower() for name in features.columns})
    if clash:
        raise ValueError(f"rename the columns {clash}: both streams have them")
    left = features.withWatermark(asked_at, late)
    renamed = predictions.withColumnsRenamed({key: f"_answer:{key}" for key in keys}).withWatermark(answered_at, late)
    equal = [F.col(quoted(key)) == F.col(quoted(f"_answer:{key}")) for key in keys]
    asked, answered = F.col(quoted(asked_at)), F.col(quoted(answered_at))
    in_time = [answered >= asked, answered <= asked + F.expr(f"interval {wait}")]
    joined = left.join(renamed, reduce(lambda a, b: a & b, equal + in_time), "leftOuter")
    return joined.select(*[F.col(quoted(c)) for c in features.columns], *[F.col(quoted(c)) for c in added])


def append_parquet(df: DataFrame, path: str, checkpoint: str, *, trigger: dict | None = None) -> StreamingQuery:
    """Append to a parquet folder; with the checkpoint, every row is written exactly once."""
    writer = df.writeStream.outputMode("append").format("parquet").option("path", path)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or POLL)).start()


def watch_answers(
    incoming: DataFrame,
    outgoing: DataFrame,
    *,
    name: str = "file_name",
    time: str = "modified",
    deadline: str = "1 day",
    late: str = "1 hour",
) -> DataFrame:
    """The state of every file name from streams of what came in and what went out: (name, state, came, answered).

    A name is DONE as soon as both are there, at most `deadline` apart, whichever came first. When both streams have passed
    the deadline by `late`, a file without an answer is MISSING, and an answer without a file STRAY; each goes out once. An
    answer after its deadline is STRAY, the file MISSING: a report says so in two rows. Names that repeat within the
    deadline count once. What is kept per name ends with its deadline. Rows without a name are not taken.
    """

    def named(rows: DataFrame, side: str) -> DataFrame:
        rows = rows.select(F.col(quoted(name)).alias(f"{side}_name"), F.col(quoted(time)).alias(side))
        rows = rows.where(F.col(f"{side}_name").isNotNull()).withWatermark(side, late)
        return rows.dropDuplicatesWithinWatermark([f"{side}_name"])

    came, answered = named(incoming, "came"), named(outgoing, "answered")
    apart = F.expr(f"interval {deadline}")
    near = (F.col("answered") >= F.col("came") - apart) & (F.col("answered") <= F.col("came") + apart)
    joined = came.join(answered, (F.col("came_name") == F.col("answered_name")) & near, "fullOuter")
    state = F.when(F.col("answered").isNull(), "MISSING").when(F.col("came").isNull(), "STRAY").otherwise("DONE")
    return joined.select(F.coalesce("came_name", "answered_name").alias(name), state.alias("state"), "came", "answered")
