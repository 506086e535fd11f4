"""Stream writers and the four-table fan-out."""

from __future__ import annotations

import time
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tickerloom.fixed_values import BAR_COLUMNS, THRESHOLD_PCT, TRIGGER, WATERMARK
from tickerloom.functions.measures import utc_date
from tickerloom.operators.bars import anomaly_bounds, mergeable_bars, rollup_bars, windowed_vwap
from tickerloom.operators.trades import bronze, enrich
from tickerloom.sources.messages import parse_trades

EVERY_TRIGGER = {"processingTime": TRIGGER}
AVAILABLE_NOW = {"availableNow": True}


def write_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    output_mode: str = "append",
    trigger: dict | None = None,
    partition_by: list[str] | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Append a stream to a table under its own checkpoint.

    Offsets and window state resume from the checkpoint after a crash. The number
    of shuffle partitions is frozen there at the first start.
    """
    writer = (
        df.writeStream.format(fmt)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_TRIGGER))
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    return writer.start(path)


def console_preview(
    df: DataFrame, rows: int = 10, name: str = "preview", trigger: dict | None = None
) -> StreamingQuery:
    """Print each micro-batch of a stream, untruncated."""
    return (
        df.writeStream.outputMode("append").format("console")
        .option("truncate", False).option("numRows", rows)
        .trigger(**(trigger or EVERY_TRIGGER)).queryName(name).start()
    )


def start_fan_out(
    messages: DataFrame,
    base_path: str,
    checkpoint_base: str,
    durations: tuple[str, str] = ("1 minute", "5 minutes"),
    watermark: str = WATERMARK,
    threshold_pct: float = THRESHOLD_PCT,
    trigger: dict | None = None,
    fmt: str = "parquet",
    by_date: bool = True,
    preview_rows: int | None = None,
    roll_up: bool = False,
) -> dict[str, StreamingQuery]:
    """Start the bronze, short-bar, long-bar and bounds queries.

    The first three read the topic, each on its own; the bounds are a projection of the
    short bars and are streamed from the table these write, without another parse or window
    state. Every query has its own checkpoint, so one can fail and resume without the
    others. Bronze keeps every row however late. Tables are partitioned by UTC date
    (``event_date``, ``window_date``), so that a question about a day reads that day.

    With ``roll_up`` the short bars keep the sums and counts behind their means, and the long
    bars are made from the stored short ones: the topic is read and parsed twice, not three
    times, and the second window state holds short bars instead of trades. A long bar is then
    emitted once a short bar behind it is stored, and a row too late for its short window
    counts in no long bar (see ``rollup_bars``).

    With a trigger that ends by itself the queries on stored bars start when the short bars are
    done, or they would miss the last ones.
    """
    trades = enrich(parse_trades(messages))
    short, long_ = durations
    short_bars = (mergeable_bars if roll_up else windowed_vwap)(trades, short, watermark)

    def start(name: str, frame: DataFrame, time_column: str, date_column: str) -> StreamingQuery:
        if by_date:
            frame = frame.withColumn(date_column, utc_date(F.col(time_column)))
        return write_stream(
            frame, f"{base_path}/{name}", f"{checkpoint_base}/{name}", fmt=fmt, trigger=trigger,
            partition_by=[date_column] if by_date else None,
        )

    started = {
        "raw_trades": start("raw_trades", bronze(trades), "event_time", "event_date"),
        "vwap_1min": start("vwap_1min", short_bars, "window_start", "window_date"),
    }
    if not roll_up:
        started["vwap_5min"] = start(
            "vwap_5min", windowed_vwap(trades, long_, watermark), "window_start", "window_date")
    if trigger is not None and ("availableNow" in trigger or "once" in trigger):
        started["vwap_1min"].awaitTermination()
    stored = stored_stream(messages.sparkSession, f"{base_path}/vwap_1min", short_bars.schema, fmt)
    if roll_up:
        started["vwap_5min"] = start(
            "vwap_5min", rollup_bars(stored, long_).select(*BAR_COLUMNS), "window_start", "window_date")
    started["anomaly_alerts"] = start(
        "anomaly_alerts", anomaly_bounds(stored, threshold_pct), "window_start", "window_date")
    if preview_rows is not None:
        started["preview"] = console_preview(short_bars, preview_rows, "bar_preview", trigger)
    return started


def stored_stream(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet"
) -> DataFrame:
    """The table that another query is writing, as a stream of its committed files."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    reader = spark.readStream.format(fmt)
    return (reader if fmt == "delta" else reader.schema(schema)).load(path)


def compact_days(
    spark: SparkSession, source: str, target: str, before: date, date_column: str = "window_date",
    fmt: str = "parquet", bytes_per_file: str = "128MB", cluster_by: tuple[str, ...] = (),
    row_group_bytes: int = 16 << 20,
) -> None:
    """Rewrite the days before ``before`` of a streamed table into few files per day.

    A stream appends a file per state partition and micro-batch. Its own folder stays as it
    is, since a file log lists it; ``target`` gets the same rows, day by day replaced, so the
    step may be repeated. A day larger than a file is split by Spark.

    With ``cluster_by``, such as ticker and event time, the rows of a day are in that order over
    its files, row groups are small, and the first of these columns gets Parquet bloom filters:
    a question about one ticker of a day reads the row groups that hold it. The files are cut
    at sampled borders of all these columns, so a ticker with most rows is in many of them.
    """
    closed = spark.read.format(fmt).load(source).filter(F.col(date_column) < F.lit(before))
    sizes = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    previous = spark.conf.get(sizes)
    spark.conf.set(sizes, bytes_per_file)
    try:
        if cluster_by:
            order = (date_column, *cluster_by)
            dealt = closed.repartitionByRange(*order).sortWithinPartitions(*order)
        else:
            dealt = closed.hint("rebalance", date_column)
        writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        if cluster_by:
            writer = writer.option("parquet.block.size", row_group_bytes).option(
                f"parquet.bloom.filter.enabled#{cluster_by[0]}", "true")
        writer.partitionBy(date_column).format(fmt).save(target)
    finally:
        spark.conf.set(sizes, previous)


def stop_all(queries: dict[str, StreamingQuery]) -> None:
    for query in queries.values():
        if query.isActive:
            query.stop()


def await_any(
    queries: dict[str, StreamingQuery], timeout: float | None = None, poll: float = 0.5
) -> str | None:
    """Wait until one of these queries ends, then stop the rest.

    Returns the name of the query that ended, ``None`` on timeout; raises its error
    if it failed. Other queries of the session are left alone.
    """
    deadline = None if timeout is None else time.monotonic() + timeout
    ended = None
    try:
        while ended is None and (deadline is None or time.monotonic() < deadline):
            ended = next((n for n, q in queries.items() if not q.isActive), None)
            if ended is None:
                time.sleep(poll)
    finally:
        stop_all(queries)
    if ended is not None and queries[ended].exception() is not None:
        raise queries[ended].exception()
    return ended


def finish(queries: dict[str, StreamingQuery]) -> None:
    """Wait for ``availableNow`` queries to work off everything there is."""
    try:
        for query in queries.values():
            query.awaitTermination()
    finally:
        stop_all(queries)


def rows_dropped_late(query: StreamingQuery) -> int:
    """Late rows dropped so far. Rows are counted after partial aggregation, so this
    says whether anything was dropped, not how many input rows were; ``late.split_late``
    keeps the rows themselves."""
    return sum(
        int(op.get("numRowsDroppedByWatermark", 0))
        for progress in query.recentProgress
        for op in progress["stateOperators"]
    )
