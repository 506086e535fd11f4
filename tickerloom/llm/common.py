"""Helpers shared by the training-data operators."""

from __future__ import annotations

import math
import os
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickerloom.session import materialize, scratch_path

__all__ = ["batches", "clean_text", "documents", "each_copy", "importable", "ordinals", "prefix_sums",
           "read", "stored", "scratch_path"]

# Rows that one Arrow batch leaving a Python task may hold.
BATCH_ROWS = 2048
# Copies of a row that one step writes out.
COPIES_AT_ONCE = 4096


# Python workers live as long as their executor and share its memory with the JVM. So that one
# stage does not hold what an earlier one has freed: Arrow takes memory from the C library, which
# keeps few arenas and gives blocks of a megabyte and more back at once.
_WORKER_ENVIRONMENT = {
    "ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "2",
    "MALLOC_MMAP_THRESHOLD_": str(1 << 20), "MALLOC_TRIM_THRESHOLD_": str(1 << 20),
}
# Whole texts may be long; a batch of them is bounded by these, unless the session says otherwise.
_BATCH_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
               "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20)}


def sparing(spark: SparkSession) -> None:
    """Let Python workers give freed memory back, and bound the batches they get; for work in
    many stages, as it takes time.

    Holds for the session from the first call on; the session's own settings win.
    """
    given = spark.sparkContext.getConf()
    for name, value in _WORKER_ENVIRONMENT.items():
        if not given.contains(f"spark.executorEnv.{name}"):
            spark.sparkContext.environment.setdefault(name, value)
    for name, value in _BATCH_CONF.items():
        if not given.contains(name):
            spark.conf.set(name, value)


def importable(spark: SparkSession) -> None:
    """Let Python workers that run beside the driver import this package from where it lies."""
    environment = spark.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def documents(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` as a long and ``text`` with NULL read as empty; other columns are dropped."""
    importable(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       clean_text("text"), *more)


def clean_text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back, so that a lost executor costs one stage."""
    return materialize(df, label)


def batches(rows: Iterable[tuple], schema: pa.Schema, size: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """Arrow batches of a lazy stream of row tuples."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, type=field.type) for column, field in zip(zip(*rows), schema)],
        schema=schema)


def prefix_sums(counts: DataFrame, key: str, value: str, into: str, *, within: tuple[str, ...] = (),
                fan: int = 1024) -> DataFrame:
    """Running total of ``value`` before each ``key`` (dense numbers from 0), exclusive.

    Two levels of ``fan`` keys, so the window that sees all blocks holds one row per
    ``fan`` keys and no task holds all keys.
    """
    block = F.expr(f"{key} div {fan}")
    blocked = counts.withColumn("_block", block)
    totals = blocked.groupBy(*within, "_block").agg(F.sum(value).alias("_total"))
    above = Window.partitionBy(*within).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*within, "_block",
                           F.coalesce(F.sum("_total").over(above), F.lit(0)).alias("_start"))
    inner = (Window.partitionBy(*within, "_block").orderBy(key)
             .rowsBetween(Window.unboundedPreceding, -1))
    return (blocked.join(starts, [*within, "_block"])
            .withColumn(into, (F.col("_start") + F.coalesce(F.sum(value).over(inner), F.lit(0)))
                        .cast("long"))
            .drop("_block", "_start"))


def each_copy(counted: DataFrame, copies: str, into: str) -> DataFrame:
    """A row per copy, numbered from 0; a row of many copies is written out by many tasks."""
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"({copies} - 1) div {COPIES_AT_ONCE}")))
    names = [name for name in counted.columns if name != copies]
    first = F.col("_block") * COPIES_AT_ONCE
    return (counted.select(*counted.columns, block.alias("_block")).repartition(*names, "_block")
            .select(*names, F.explode(F.sequence(
                first, F.least(F.col(copies), first + COPIES_AT_ONCE) - 1)).alias(into)))


def ordinals(rows: DataFrame, key: str, order: list[str], into: str, total: int) -> DataFrame:
    """Number the rows of each ``key`` from 0, in a fixed order, without gathering a key.

    Every key is split over about sqrt(total) buckets by a hash of ``order``. A task numbers
    one bucket of one key; the counts of the buckets before it are added. A key with all rows
    costs sqrt(total) rows a task in either step. Rows equal in ``order`` share a bucket; rows
    equal in all columns are one row with a number of copies until they have their numbers.
    """
    buckets = max(1, math.isqrt(max(0, total)))
    spread = (rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_copies")).withColumn(
        "_bucket", F.pmod(F.xxhash64(*order, F.lit(17)), F.lit(buckets)).cast("int")))
    counts = spread.groupBy(key, "_bucket").agg(F.sum("_copies").alias("_rows"))
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(key, "_bucket",
                           F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    rest = [name for name in rows.columns if name not in (key, *order)]
    inside = (Window.partitionBy(key, "_bucket").orderBy(*order, *rest)
              .rowsBetween(Window.unboundedPreceding, -1))
    numbered = (spread.withColumn("_inside", F.coalesce(F.sum("_copies").over(inside), F.lit(0)))
                .join(starts, [key, "_bucket"])
                .withColumn(into, (F.col("_before") + F.col("_inside")).cast("long")))
    written = each_copy(numbered.select(*rows.columns, into, "_copies"), "_copies", "_nth")
    return written.select(*rows.columns, (F.col(into) + F.col("_nth")).alias(into))
