"""Late rows kept in a side table, told apart by the watermark of their micro-batch."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickerloom.fixed_values import WATERMARK
from tickerloom.functions.measures import width_micros, window_end, window_start
from tickerloom.sinks.storage import get_text, put_text
from tickerloom.sinks.versioned import as_of, fit_to_schema, stored_schema, write_batch
from tickerloom.streaming.queries import AVAILABLE_NOW

LATE = "late"


def _mark_path(path: str) -> str:
    return f"{path.rstrip('/')}_watermark.json"


def _watermarks(spark: SparkSession, path: str, batch_id: int) -> tuple[int | None, int | None]:
    """Micros up to which windows were closed when the batch before ``batch_id`` began, and when
    ``batch_id`` itself did.

    The mark names the batch it was made by: a batch that is repeated after a crash gets the
    watermarks it had the first time.
    """
    text = get_text(spark, _mark_path(path))
    if text is None:
        return None, None
    mark = json.loads(text)
    if mark["batch"] >= batch_id:
        return mark["earlier"], mark["before"]
    return mark["before"], mark["after"]


def split_late(
    trades: DataFrame,
    path: str,
    checkpoint: str,
    duration: str = "1 minute",
    delay: str = WATERMARK,
    trigger: dict | None = None,
    as_engine: bool = False,
) -> StreamingQuery:
    """Write a stream of trades as versioned batches with a column ``late``.

    A row is late if its window of ``duration`` had closed before its micro-batch: the window's
    end is not after the largest event time of earlier micro-batches less ``delay``. Spark's own
    window operator closes windows by that watermark, but drops rows by that of the micro-batch
    before; with ``as_engine`` the rows kept aside are those which it drops, given the same
    micro-batches without empty ones between.

    So every row is either in an accepted window or here, with its whole content, and can be
    counted, repaired or replayed. Rows without an event time are in no window and never late.
    One pass over each micro-batch: the write itself finds its largest event time. Data, log
    and watermark are replaced when a micro-batch is repeated.
    """
    spark = trades.sparkSession
    stored = stored_schema(spark, path)
    wait = spark.range(1).select(width_micros(delay)).first()[0]
    closes = F.unix_micros(window_end(window_start(F.col("event_time"), duration), duration))
    shape = trades.withColumn(LATE, F.lit(False))
    fit_to_schema(shape, stored)

    def write(batch: DataFrame, batch_id: int) -> None:
        earlier, before = _watermarks(batch.sparkSession, path, batch_id)
        limit = earlier if as_engine else before
        late = F.lit(False) if limit is None else F.coalesce(closes <= limit, F.lit(False))
        # Spark's watermark is in whole milliseconds.
        newest = F.max(F.unix_millis("event_time")).alias("newest")
        found = write_batch(batch.withColumn(LATE, late), batch_id, path, [newest])
        reached = [] if found["newest"] is None else [found["newest"] * 1000 - wait]
        after = max([*reached, *([] if before is None else [before])], default=None)
        put_text(batch.sparkSession, _mark_path(path), json.dumps(
            {"batch": batch_id, "earlier": earlier, "before": before, "after": after}))

    return (
        trades.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """The side table: every row that came after its window had closed."""
    return as_of(spark, path).filter(LATE).drop(LATE)


def accepted_rows(spark: SparkSession, path: str) -> DataFrame:
    """Every row that came while its window was open."""
    return as_of(spark, path).filter(~F.col(LATE)).drop(LATE)
