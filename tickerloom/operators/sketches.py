"""Distinct counts over any range of days from sketches stored per day.

A day is scanned once. A question about a month then merges thirty sketches of a few
kilobytes for every kept column, instead of shuffling the month's values. The exact forms
are ``market.data_summary`` and ``dedup.duplicate_stats``.
"""

from __future__ import annotations

import math
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.functions.measures import utc_date

DAY = "event_date"
#: Binary logarithm of a sketch's size.
LOG_SIZE = 12


def error_bound(log_size: int = LOG_SIZE, deviations: float = 3.0) -> float:
    """Relative error that an estimate keeps within that many standard deviations."""
    return deviations * 1.04 / math.sqrt(1 << log_size)


def _hashed(name: str) -> Column:
    """A value of any type as a long; NULL stays NULL, so that it is not counted. An empty
    string is a value, which the sketch itself would pass over."""
    return F.when(F.col(name).isNotNull(), F.xxhash64(name))


def day_sketches(
    trades: DataFrame, columns: tuple[str, ...] = ("ticker", "trade_id"), log_size: int = LOG_SIZE,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """One row per UTC day (and ``by``): rows, and a sketch of every column's values.

    Sketches are built on the map side, so a day or ticker with most rows costs one row per
    task. Rows without an event time are in the day NULL.
    """
    return trades.groupBy(utc_date(F.col("event_time")).alias(DAY), *by).agg(
        F.count("*").alias("rows"),
        *[F.hll_sketch_agg(_hashed(name), F.lit(log_size)).alias(f"{name}_sketch") for name in columns])


def store_day_sketches(sketches: DataFrame, path: str) -> None:
    """Replace the days at hand and leave the others; a day may be counted again at any time."""
    (sketches.repartition(DAY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(DAY).parquet(path))


def distinct_over(
    sketches: DataFrame, since: date | None = None, until: date | None = None, by: tuple[str, ...] = (),
) -> DataFrame:
    """Rows and estimated distinct values from ``since`` to ``until``, both included.

    A bound that is None is open; days in no bound include the day NULL. Without any day
    there are zero rows and zero values (one row; none with ``by``). All sketches need to be
    of one size, or the smallest decides.
    """
    kept = sketches
    if since is not None:
        kept = kept.filter(F.col(DAY) >= F.lit(since))
    if until is not None:
        kept = kept.filter(F.col(DAY) <= F.lit(until))
    names = [name for name in sketches.columns if name.endswith("_sketch")]
    return kept.groupBy(*by).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        *[F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(name, F.lit(True))), F.lit(0))
          .alias(f"distinct_{name.removesuffix('_sketch')}") for name in names])
