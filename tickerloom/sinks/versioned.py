"""Tables that keep one partition per batch: safe to replay, readable as of a version.

Batch N is the partition ``batch_group=N div 1000/batch_id=N``. Writing it again replaces
that partition only, so a batch repeated after a crash leaves no duplicates; an empty batch
empties it. A log beside the table (``batchlog``) has one entry per batch, empty ones
included: number, time, rows. A version is everything up to a batch.

``merge_groups`` rewrites whole groups of a thousand batches into few files, with the batch
number as a column, so that a reader of an old table lists groups, not batches. A batch that
is written again after its group was merged lies in its own partition as before and hides its
rows in the merged files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tickerloom.sinks import batchlog
from tickerloom.sinks.storage import delete, get_text, names, put_text
from tickerloom.sources.tables import TableMissing, read_table

BATCH, GROUP = "batch_id", "batch_group"
_PLACE = "_place"
GROUP_SIZE = 1000
# Rows that one task of a merge sorts.
SORTED_ROWS = 1_000_000


class SchemaMismatch(ValueError):
    """An append does not fit the columns of the stored table."""


def schema_problems(stored: StructType, incoming: StructType) -> list[str]:
    """What keeps ``incoming`` from being appended: unknown columns and other types."""
    have = {f.name: f.dataType for f in stored.fields}
    problems = []
    for field in incoming.fields:
        if field.name not in have:
            problems.append(f"unknown column {field.name}")
        elif have[field.name] != field.dataType:
            problems.append(
                f"{field.name} is {field.dataType.simpleString()}, "
                f"stored as {have[field.name].simpleString()}"
            )
    return problems


def stored_schema(spark: SparkSession, path: str) -> StructType | None:
    """Columns of the stored table without the batch column; ``None`` if there is none.

    Looks into one group of batches, however many there are.
    """
    root = path.rstrip("/")
    for group in reversed(_live_groups(spark, path)):
        if names(spark, f"{root}/{GROUP}={group}"):
            found = spark.read.option("basePath", path).parquet(f"{root}/{GROUP}={group}")
            return found.drop(BATCH, GROUP).schema
    merged = _merged(spark, path)
    if merged:
        return _read_merged(spark, path, merged, [max(merged)]).drop(BATCH).schema
    try:
        return read_table(spark, path).drop(BATCH, GROUP).schema
    except TableMissing:
        return None


def fit_to_schema(df: DataFrame, stored: StructType | None) -> DataFrame:
    """``df`` in the stored column order, absent columns as NULL.

    Raises ``SchemaMismatch`` before anything is written. A new table takes any schema.
    """
    if stored is None:
        return df
    problems = schema_problems(stored, df.schema)
    if problems:
        raise SchemaMismatch("; ".join(problems))
    given = set(df.columns)
    return df.select(*[
        F.col(f.name) if f.name in given else F.lit(None).cast(f.dataType).alias(f.name)
        for f in stored.fields
    ])


def log_path(path: str) -> str:
    return f"{path.rstrip('/')}_batches"


def _partition(root: str, batch_id: int) -> str:
    return f"{root.rstrip('/')}/{GROUP}={batch_id // GROUP_SIZE}/{BATCH}={batch_id}"


def _replace_batch(df: DataFrame, batch_id: int, path: str, metrics: list[Column] | None = None) -> dict:
    """Data first, then the log: a batch cut short between the two is written again.

    Returns the number of ``rows`` and the ``metrics``, aggregates over what was written, which
    the write itself collects.
    """
    spark = df.sparkSession
    seen = Observation()
    (
        df.observe(seen, F.count(F.lit(1)).alias("rows"), *(metrics or []))
        .withColumns({
            GROUP: F.lit(batch_id // GROUP_SIZE).cast("bigint"),
            BATCH: F.lit(batch_id).cast("bigint"),
        })
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(GROUP, BATCH)
        .parquet(path)
    )
    found = seen.get
    if found["rows"] == 0:
        # A dynamic overwrite without rows leaves every partition as it was.
        delete(spark, _partition(path, batch_id))
    batchlog.append(spark, log_path(path), batch_id, found["rows"])
    return found


def write_batch(df: DataFrame, batch_id: int, path: str, metrics: list[Column] | None = None) -> dict:
    """Write ``df`` as batch ``batch_id``, replacing that batch if it exists.

    Returns the ``rows`` written and the aggregates ``metrics``, collected by the write.
    """
    return _replace_batch(fit_to_schema(df, stored_schema(df.sparkSession, path)), batch_id, path, metrics)


def stream_batches(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write a stream as versioned batches.

    A running stream cannot change its columns, so they are compared with the table
    once, at the start. A micro-batch never lists the partitions written before it.
    """
    stored = stored_schema(stream.sparkSession, path)
    fit_to_schema(stream, stored)
    return (
        stream.writeStream.foreachBatch(
            lambda df, batch_id: _replace_batch(fit_to_schema(df, stored), batch_id, path)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def batch_log(spark: SparkSession, path: str) -> DataFrame:
    """(batch_id, written_at, rows_written), one row per batch number."""
    return batchlog.entries(spark, log_path(path))


def history(spark: SparkSession, path: str) -> DataFrame:
    """One row per version, also of those that wrote nothing. Reads the log only."""
    return batch_log(spark, path).select(
        F.col(BATCH).alias("version"), "written_at", "rows_written",
        F.lit("append").alias("operation"),
    )


def _live_groups(spark: SparkSession, path: str) -> list[int]:
    """Groups with partitions of their own, from one listing."""
    return sorted(int(name.partition("=")[2]) for name in names(spark, path.rstrip("/"))
                  if name.startswith(f"{GROUP}="))


def _merged_root(path: str) -> str:
    return f"{path.rstrip('/')}_merged"


def _merged(spark: SparkSession, path: str) -> dict[int, dict]:
    """Merged groups: {group: {"folder": name, "moment": time of the last batch before}}."""
    text = get_text(spark, f"{_merged_root(path)}/current.json")
    return {int(group): facts for group, facts in json.loads(text).items()} if text else {}


def _read_merged(spark: SparkSession, path: str, merged: dict[int, dict], groups: list[int]) -> DataFrame:
    return spark.read.parquet(*[f"{_merged_root(path)}/{merged[g]['folder']}" for g in groups])


def _written_since(spark: SparkSession, path: str, merged: dict[int, dict], groups: list[int]) -> list[int]:
    """Batches of merged groups that were written again afterwards, without rows perhaps."""
    moments = spark.createDataFrame([(g, merged[g]["moment"]) for g in groups], "g bigint, moment string")
    log = batch_log(spark, path).withColumn("g", F.expr(f"{BATCH} div {GROUP_SIZE}"))
    late = log.join(F.broadcast(moments), "g").filter(F.col("written_at") > F.to_timestamp("moment"))
    return [r[0] for r in late.select(BATCH).collect()]


def _rows(spark: SparkSession, path: str, wanted: Callable[[int], bool]) -> DataFrame:
    """Rows of the wanted groups with their ``batch_id``, merged and not."""
    root, merged = path.rstrip("/"), _merged(spark, path)
    parts = []
    done = sorted(filter(wanted, merged))
    if done:
        rows, hidden = _read_merged(spark, path, merged, done), _written_since(spark, path, merged, done)
        parts.append(rows.filter(~F.col(BATCH).isin(hidden)) if hidden else rows)
    live = [g for g in _live_groups(spark, path) if wanted(g) and names(spark, f"{root}/{GROUP}={g}")]
    if live:
        parts.append(spark.read.option("basePath", path)
                     .parquet(*[f"{root}/{GROUP}={g}" for g in live]).drop(GROUP))
    if not parts:
        schema = stored_schema(spark, path)
        if schema is None:
            raise TableMissing(f"no table at {path}")
        return spark.createDataFrame([], schema).withColumn(BATCH, F.lit(0).cast("bigint"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def as_of(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table as it was after batch ``version``; as it is now without one.

    Lists the groups up to the version, then prunes to its batches.
    """
    if version is None:
        return _rows(spark, path, lambda group: True).drop(BATCH)
    rows = _rows(spark, path, lambda group: group * GROUP_SIZE <= version)
    return rows.filter(F.col(BATCH) <= version).drop(BATCH)


def batches(spark: SparkSession, path: str, numbers: Iterable[int]) -> DataFrame:
    """Rows of these batches, with their ``batch_id``; lists their groups only."""
    numbers = sorted(set(numbers))
    groups = {number // GROUP_SIZE for number in numbers}
    return _rows(spark, path, groups.__contains__).filter(F.col(BATCH).isin(numbers))


def merge_groups(spark: SparkSession, path: str, rows_per_file: int = 5_000_000) -> list[int]:
    """Rewrite every whole group of batches into few files; returns the groups merged now.

    A group is whole when a batch of a later group exists. It is merged again when batches of it
    were written since. Files are sorted by batch, so that a reader of an old version skips row
    groups. A task sorts and writes one file, of about ``SORTED_ROWS`` rows at most; a batch with
    more is dealt over several by the places of its rows. The new files count from the moment the list of groups is replaced, by one rename;
    what they were made of is deleted after that. One writer at a time, as for batches.
    """
    log, root = batch_log(spark, path), path.rstrip("/")
    moment = log.agg(F.date_format(F.to_utc_timestamp(F.max("written_at"), F.current_timezone()),
                                   "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).first()[0]
    sizes = log.groupBy(F.expr(f"{BATCH} div {GROUP_SIZE}").alias("g")).agg(
        F.sum("rows_written").alias("n")).orderBy("g").collect()        # a row a group
    changed = []
    for group, rows in [(r["g"], r["n"]) for r in sizes[:-1]]:
        merged = _merged(spark, path)
        before = merged.get(group)
        if before and not _written_since(spark, path, merged, [group]) or not before and not rows:
            continue
        folder = f"{GROUP}={group}-{uuid.uuid4().hex}"
        number = max(1, -(-rows // min(rows_per_file, SORTED_ROWS)))
        (
            _rows(spark, path, group.__eq__)
            .withColumn(_PLACE, F.monotonically_increasing_id())
            .repartitionByRange(number, BATCH, _PLACE).drop(_PLACE)
            .sortWithinPartitions(BATCH).write.parquet(f"{_merged_root(path)}/{folder}")
        )
        put_text(spark, f"{_merged_root(path)}/current.json", json.dumps(
            {**merged, group: {"folder": folder, "moment": moment}}))
        delete(spark, f"{root}/{GROUP}={group}")
        if before:
            delete(spark, f"{_merged_root(path)}/{before['folder']}")
        changed.append(group)
    return changed


def version_growth(spark: SparkSession, path: str, version: int = 0) -> DataFrame:
    """One row: rows at ``version``, rows now, and the difference."""
    return history(spark, path).agg(
        F.coalesce(
            F.sum(F.when(F.col("version") <= version, F.col("rows_written"))), F.lit(0)
        ).alias("rows_then"),
        F.coalesce(F.sum("rows_written"), F.lit(0)).alias("rows_now"),
    ).withColumn("rows_added", F.col("rows_now") - F.col("rows_then"))
