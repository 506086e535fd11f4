"""Reconciliation that follows the batches of two versioned tables.

A run asks the logs of the trades and of the streamed bars which batches are new or were
written again, finds the windows these touch, and compares those windows only; all others keep
their rows. Beside the result an index says which windows each batch had, so that a batch
that is replaced also touches the windows it had before, and so that the trades of a window are
looked for in its own batches only.

Repeats of a trade id must be re-deliveries, with the same event time and ticker; where ids are
used again for other trades, ``operators.reconcile.reconcile`` compares everything.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.functions.measures import utc_date, window_start
from tickerloom.operators.reconcile import reconcile
from tickerloom.session import materialize
from tickerloom.sinks import versioned
from tickerloom.sinks.storage import delete, names
from tickerloom.sinks.versioned import BATCH
from tickerloom.sources.tables import TableMissing, read_table

TRADES, BARS = "trades", "bars"
DATE = "window_date"
INDEX = "side string, batch bigint, written_at timestamp, window_start timestamp, ticker string"


class Run(NamedTuple):
    """What one run looked at: its number, the batches that changed and those it read."""

    number: int
    changed: dict[str, list[int]]
    read: dict[str, list[int]]


def _index_path(state: str) -> str:
    return f"{state.rstrip('/')}/index"


def _result_path(state: str) -> str:
    return f"{state.rstrip('/')}/windows"


def _same_window(a: DataFrame, b: DataFrame) -> Column:
    return (a["window_start"].eqNullSafe(b["window_start"])) & (a["ticker"].eqNullSafe(b["ticker"]))


def _index(spark: SparkSession, state: str, number: int) -> DataFrame:
    """Entries of the last run that looked at each batch, of the runs before ``number``."""
    try:
        rows = versioned.batches(spark, _index_path(state), range(number))
    except TableMissing:
        return spark.createDataFrame([], INDEX)
    last = rows.groupBy("side", "batch").agg(F.max(BATCH).alias(BATCH))
    return rows.join(last, ["side", "batch", BATCH], "left_semi").drop(BATCH)


def _numbers(rows: DataFrame) -> dict[str, list[int]]:
    """One number per batch."""
    found: dict[str, list[int]] = {TRADES: [], BARS: []}
    for side, batch in rows.select("side", "batch").distinct().collect():
        found[side].append(batch)
    return {side: sorted(numbers) for side, numbers in found.items()}


def reconcile_changes(
    spark: SparkSession, trades_path: str, bars_path: str, state: str, duration: str = "1 minute"
) -> Run:
    """Bring the comparison kept in ``state`` up to date with both tables.

    Rows are those of ``reconcile(how="full_outer")`` over the whole tables. The work of a run
    grows with the windows its changed batches touch, not with the tables; the first one
    compares everything. A run cut short is repeated: the windows are replaced before the
    index says that the batches were seen. One run at a time.
    """
    paths = {TRADES: trades_path, BARS: bars_path}
    done = versioned.batch_log(spark, _index_path(state))
    number = done.agg(F.coalesce(F.max(BATCH) + 1, F.lit(0))).first()[0]
    index = materialize(_index(spark, state, number), "reconciled-index") if number else \
        spark.createDataFrame([], INDEX)
    logs = [versioned.batch_log(spark, path).select(
        F.lit(side).alias("side"), F.col(BATCH).alias("batch"), "written_at") for side, path in paths.items()]
    log = logs[0].unionByName(logs[1])
    new = materialize(log.join(index, ["side", "batch", "written_at"], "left_anti"), "changed-batches")
    changed = _numbers(new)
    if not any(changed.values()):
        return Run(number, changed, {TRADES: [], BARS: []})

    def windows(side: str, numbers: list[int]) -> DataFrame:
        if not numbers:
            return spark.createDataFrame([], "batch bigint, window_start timestamp, ticker string")
        rows = versioned.batches(spark, paths[side], numbers)
        start = window_start(F.col("event_time"), duration) if side == TRADES else F.col("window_start")
        return (rows.select(F.col(BATCH).cast("bigint").alias("batch"), start.alias("window_start"), "ticker")
                .filter("window_start IS NOT NULL").distinct())

    found = [windows(side, numbers).withColumn("side", F.lit(side)) for side, numbers in changed.items()]
    # A batch without windows has one row as well, so that it counts as seen.
    entries = materialize(
        new.join(found[0].unionByName(found[1]), ["side", "batch"], "left")
        .select("side", "batch", "written_at", "window_start", "ticker"), "new-entries")
    stale = index.join(new.select("side", "batch"), ["side", "batch"], "left_semi")
    touched = materialize(
        stale.unionByName(entries).filter("window_start IS NOT NULL")
        .select("window_start", "ticker").distinct(), "touched-windows")

    current = index.join(new.select("side", "batch"), ["side", "batch"], "left_anti").unionByName(entries)
    holding = current.join(touched, _same_window(current, touched), "left_semi")
    read = _numbers(holding)

    def rows_of(side: str, start: Column) -> DataFrame:
        rows = versioned.batches(spark, paths[side], read[side]).drop(BATCH).withColumn("_start", start)
        wanted = touched.withColumnRenamed("window_start", "_start")
        same = (rows["_start"] == wanted["_start"]) & rows["ticker"].eqNullSafe(wanted["ticker"])
        return rows.join(wanted, same, "left_semi").drop("_start")

    compared = reconcile(
        rows_of(TRADES, window_start(F.col("event_time"), duration)),
        rows_of(BARS, F.col("window_start")), duration, "full_outer",
    ).withColumn(DATE, utc_date(F.col("window_start")))
    _replace_windows(spark, state, touched, compared)
    versioned.write_batch(entries, number, _index_path(state))
    return Run(number, changed, read)


def _replace_windows(spark: SparkSession, state: str, touched: DataFrame, compared: DataFrame) -> None:
    """Replace the rows of the touched windows; only days with such a window are rewritten."""
    days = [r[0] for r in touched.select(utc_date(F.col("window_start")).alias(DATE)).distinct().collect()]
    new = compared
    if any(name.startswith(f"{DATE}=") for name in names(spark, _result_path(state))):
        kept = reconciled(spark, state, with_date=True).filter(F.col(DATE).isin(days))
        new = kept.join(touched, _same_window(kept, touched), "left_anti").unionByName(compared)
    new = materialize(new, "replaced-days")
    (
        new.repartition(DATE).sortWithinPartitions("window_start", "ticker")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(DATE).parquet(_result_path(state))
    )
    left = {r[0] for r in new.select(DATE).distinct().collect()}
    for day in set(days) - left:
        delete(spark, f"{_result_path(state)}/{DATE}={day}")


def reconciled(spark: SparkSession, state: str, with_date: bool = False) -> DataFrame:
    """One row per compared window, as the last run left it."""
    rows = read_table(spark, _result_path(state))
    return rows if with_date else rows.drop(DATE)
