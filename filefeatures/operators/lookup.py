"""Left joins to a table with unique keys that survive one key holding a large share of the rows.

Hot keys are answered from a broadcast of at most 1/HOT_SHARE rows: no more keys than that can each
hold HOT_SHARE of the rows. All other rows are shuffled, and none of their keys is large.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filefeatures.operators.select import quoted
from filefeatures.session import stage

HOT_SHARE = 1 / 10_000
HOT_MIN_ROWS = 1_000_000
KEY_BYTES = 64
# Hot rows wider than this in all are not broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024


def key_part(value: Column) -> Column:
    """A join key that is never NULL and at most 71 bytes long, whatever the value is."""
    text = value.cast("string")
    return (
        F.when(text.isNull(), "n")
        .when(F.octet_length(text) <= KEY_BYTES, F.concat(F.lit("v"), text))
        .otherwise(F.concat(F.lit("sha256:"), F.sha2(text, 256)))
    )


def hot_keys(
    fact: DataFrame, keys: Sequence[str], *, min_rows: int = HOT_MIN_ROWS, share: float = HOT_SHARE
) -> DataFrame | None:
    """The keys that hold at least `share` of the rows and at least `min_rows`; None when there are none."""
    counts = stage(fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")), "key-counts")
    total = counts.agg(F.sum("_rows")).first()[0] or 0
    if total < min_rows:
        return None
    hot = stage(counts.where(F.col("_rows") >= max(min_rows, total * share)).select(*keys), "hot-keys")
    return None if hot.isEmpty() else hot


def hot_part(dim: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per hot key: its row of `dim`, or NULLs."""
    return hot.join(dim.join(hot, list(keys), "left_semi"), list(keys), "left")


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    hot: DataFrame | None,
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """`fact LEFT JOIN dim` on non-NULL keys that are unique in `dim`.

    `hot` holds the keys to answer from a broadcast, with their columns of `dim`. The rows are read once: those
    with a hot key take its columns from the broadcast and go to the join under a key of their own, which spreads
    them over the tasks and finds nothing there. When the hot rows are too wide to broadcast, it is a plain join,
    and adaptive execution splits what is skewed.
    """
    keys = list(keys)
    if hot is not None:
        hot = stage(hot.select(dim.columns), "hot-rows")
        size = hot.select(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
        if size <= broadcast_bytes:
            added = [name for name in dim.columns if name not in keys]
            packed = hot.select(*[quoted(k) for k in keys], F.struct(F.lit(1).alias("_is"), *[quoted(c) for c in added]).alias("_hot"))
            fact = fact.join(F.broadcast(packed), keys, "left")
            spread = F.concat(F.lit("h"), F.monotonically_increasing_id().cast("string"))
            own = [F.when(F.col("_hot").isNotNull(), spread if i == 0 else F.lit("h")).otherwise(key_part(F.col(quoted(k)))) for i, k in enumerate(keys)]
            fact = fact.withColumns({f"_join{i}": key for i, key in enumerate(own)})
            cold = dim.select(
                *[key_part(F.col(quoted(k))).alias(f"_join{i}") for i, k in enumerate(keys)],
                *[F.col(quoted(c)).alias(f"_cold:{c}") for c in added],
            )
            joined = fact.join(cold, [f"_join{i}" for i in range(len(keys))], "left")
            values = {c: F.when(F.col("_hot").isNotNull(), F.col(f"_hot.{quoted(c)}")).otherwise(F.col(quoted(f"_cold:{c}"))) for c in added}
            return joined.withColumns(values).drop("_hot", *[f"_join{i}" for i in range(len(keys))], *[f"_cold:{c}" for c in added])
    return fact.join(dim, keys, "left")
