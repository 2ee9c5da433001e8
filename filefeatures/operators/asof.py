"""As-of join: each row meets the version of its key that was valid at its time.

Rows and versions are put together and sorted into ranges of (key, time), so that no key has to fit into one task; within
a range the last version is carried forward, and a range starts with the one that the ranges before it end with. Nothing
is compared pair by pair, whatever the number of versions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filefeatures.operators.delivery import require_unique
from filefeatures.operators.lookup import key_part
from filefeatures.operators.select import quoted
from filefeatures.session import stage


def _key(names: Sequence[str]) -> Column:
    """One text for all the keys, NULL where one of them is; never longer than the keys' digests."""
    parts = [key_part(F.col(quoted(name))) for name in names]
    missing = F.lit(False)
    for name in names:
        missing = missing | F.col(quoted(name)).isNull()
    # A part's length stands before it, so different keys never give the same text.
    joined = F.concat(*[text for part in parts for text in (F.octet_length(part).cast("string"), F.lit(":"), part)])
    return F.when(~missing, joined)


def asof_join(
    rows: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    *,
    time: str,
    valid_from: str,
    valid_to: str | None = None,
) -> DataFrame:
    """`rows` with the columns of the version that has the same keys and the latest `valid_from` not after `time`.

    A row without such a version, or with a NULL key or time, keeps NULLs. With `valid_to` a version ends there (NULL: it
    does not), and the row then has none, not an older one. Versions without keys or start never match; two versions of one
    key with the same start are an error. Rows that repeat stay as often. Both tables are read twice, once to find the
    ranges. Only the keys may have the same name in both tables.
    """
    keys = list(keys)
    added = [name for name in versions.columns if name not in keys]
    clash = sorted({name.lower() for name in added} & {name.lower() for name in rows.columns})
    if clash:
        raise ValueError(f"rename the columns {clash}: both tables have them")
    require_unique(versions.where(F.col(quoted(valid_from)).isNotNull()), [*keys, valid_from])

    own = rows.select(
        _key(keys).alias("_key"),
        F.col(quoted(time)).cast("timestamp_ntz").alias("_time"),
        F.lit(1).alias("_side"),
        F.struct(*[F.col(quoted(name)) for name in rows.columns]).alias("_row"),
        F.monotonically_increasing_id().alias("_order"),
    )
    known = versions.select(
        _key(keys).alias("_key"),
        F.col(quoted(valid_from)).cast("timestamp_ntz").alias("_time"),
        F.lit(0).alias("_side"),
        F.struct(*[F.col(quoted(name)) for name in added]).alias("_version"),
        F.lit(0).cast("long").alias("_order"),
    )
    known = known.where("_key IS NOT NULL AND _time IS NOT NULL")
    both = own.unionByName(known, allowMissingColumns=True)
    # A row without key or time has nothing to be carried to: it is spread by its number.
    both = both.withColumn("_key", F.when(F.col("_time").isNull(), None).otherwise(F.col("_key")))
    order = ["_key", "_time", "_side", "_order"]
    ranged = stage(both.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "asof")

    so_far = Window.partitionBy("_key", "_range").orderBy("_time", "_side", "_order").rowsBetween(Window.unboundedPreceding, 0)
    keyed = ranged.where("_key IS NOT NULL").withColumn("_found", F.last("_version", ignorenulls=True).over(so_far))
    # One row per key and range, and no more ranges of a key than there are ranges.
    ends = ranged.where("_key IS NOT NULL").groupBy("_key", "_range")
    ends = ends.agg(F.max_by("_version", F.when(F.col("_version").isNotNull(), F.col("_time"))).alias("_end"))
    before = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("_carried", F.last("_end", ignorenulls=True).over(before)).where("_carried IS NOT NULL")
    keyed = keyed.where("_side = 1").join(carried.select("_key", "_range", "_carried"), ["_key", "_range"], "left")
    version = F.coalesce("_found", "_carried")
    if valid_to is not None:
        end = version.getField(valid_to).cast("timestamp_ntz")
        version = F.when(end.isNull() | (F.col("_time") < end), version)
    keyed = keyed.select("_row", version.alias("_version"))
    rest = ranged.where("_key IS NULL AND _side = 1").select("_row", F.lit(None).cast(ranged.schema["_version"].dataType).alias("_version"))
    return keyed.unionByName(rest).select("_row.*", *[F.col("_version").getField(name).alias(name) for name in added])
