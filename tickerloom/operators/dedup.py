"""Duplicate trades: removing, counting, and auditing a replay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup(
    trades: DataFrame, key: str = "trade_id", order_by: list[str] | None = None
) -> DataFrame:
    """One row per key; NULL keys count as one key.

    Without ``order_by`` an arbitrary row survives, enough for exact copies. With
    it the row that is smallest by ``order_by``, then by the remaining columns,
    survives. Both are aggregates with a map-side partial form: copies of one key
    collapse before the shuffle, where a ranking window would gather them in one
    task first.
    """
    if order_by is None:
        return trades.dropDuplicates([key])
    rest = [c for c in trades.columns if c != key and c not in order_by]
    smallest = F.min(F.struct(*order_by, *rest)).alias("_row")
    return trades.groupBy(key).agg(smallest).select(key, "_row.*").select(*trades.columns)


def dedup_stream(
    trades: DataFrame, delay: str, key: str = "trade_id", time: str = "event_time"
) -> DataFrame:
    """Streaming form: copies that arrive within the delay of each other are dropped."""
    return trades.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def duplicate_keys(trades: DataFrame, key: str = "trade_id") -> DataFrame:
    """Keys that occur more than once, with their count."""
    return trades.groupBy(key).agg(F.count("*").alias("cnt")).filter("cnt > 1")


def duplicate_stats(trades: DataFrame, key: str = "trade_id") -> DataFrame:
    """One row of duplicate totals; ``all_exactly_twice`` is NULL without duplicates."""
    repeated = F.col("cnt") > 1
    return (
        trades.groupBy(key).agg(F.count("*").alias("cnt"))
        .agg(
            F.coalesce(F.sum("cnt"), F.lit(0)).alias("total_rows"),
            F.count_if(repeated).alias("duplicate_ids"),
            F.bool_and(F.when(repeated, F.col("cnt") == 2)).alias("all_exactly_twice"),
            F.count("*").alias("deduped_rows"),
        )
        .withColumn("removed_rows", F.col("total_rows") - F.col("deduped_rows"))
    )


def replay_audit(before: DataFrame, after: DataFrame, key: str = "trade_id") -> DataFrame:
    """One row comparing a table before a crash with the table after the restart.

    ``lost_ids`` counts ids present before and absent after; it is computed, from
    the same grouping that yields the duplicate counts.
    """
    tagged = before.select(key, F.lit(1).alias("_old"), F.lit(0).alias("_new")).unionAll(
        after.select(key, F.lit(0).alias("_old"), F.lit(1).alias("_new"))
    )
    per_id = tagged.groupBy(key).agg(F.sum("_old").alias("old"), F.sum("_new").alias("new"))
    kept = F.col("new") > 0
    return per_id.agg(
        F.coalesce(F.sum("old"), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("new"), F.lit(0)).alias("rows_after"),
        F.count_if(kept).alias("distinct_ids"),
        F.count_if((F.col("old") > 0) & ~kept).alias("lost_ids"),
    ).withColumns({
        "new_rows": F.col("rows_after") - F.col("rows_before"),
        "raw_duplicates": F.col("rows_after") - F.col("distinct_ids"),
        "exactly_once_on_write": F.col("rows_after") == F.col("distinct_ids"),
    })
