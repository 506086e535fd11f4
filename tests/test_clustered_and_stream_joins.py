"""Clustered days skip row groups; outliers found on streams with bounded state."""

import os
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from tickerloom.operators.bars import anomaly_bounds, windowed_vwap
from tickerloom.operators.outliers import outlier_trades, stream_outlier_trades
from tickerloom.streaming.queries import AVAILABLE_NOW, compact_days, finish, stored_stream, write_stream

START = datetime(2024, 1, 1, 10)


def rows_scanned(df):
    """Rows that the file scan of an executed query has handed on."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    while not node.nodeName().startswith("Scan"):
        node = node.finalPhysicalPlan() if node.nodeName() == "AdaptiveSparkPlan" else node.children().head()
    return node.metrics().apply("numOutputRows").value()


def test_a_question_about_one_ticker_skips_row_groups(spark, tmp_path):
    source, plain, sorted_ = (str(tmp_path / name) for name in ("source", "plain", "sorted"))
    rows = spark.range(40_000).select(
        F.concat(F.lit("T"), (F.col("id") * 7919 % 40).cast("string")).alias("ticker"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id")).alias("event_time"), F.col("id"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 2).cast("int")).alias("event_date"))
    rows.write.partitionBy("event_date").parquet(source)
    options = {"before": date(2024, 1, 3), "date_column": "event_date"}
    compact_days(spark, source, plain, **options)
    compact_days(spark, source, sorted_, **options, cluster_by=("ticker", "event_time"), row_group_bytes=1 << 16)
    compact_days(spark, source, sorted_, **options, cluster_by=("ticker", "event_time"), row_group_bytes=1 << 16)
    compacted = spark.read.parquet(sorted_)
    assert compacted.count() == 40_000
    assert compacted.exceptAll(spark.read.parquet(source).select(*compacted.columns)).count() == 0

    def asked(path):
        return spark.read.parquet(path).filter("event_date = '2024-01-01' AND ticker = 'T12'").select("id", "payload")

    assert asked(sorted_).count() == asked(plain).count() > 0
    assert rows_scanned(asked(sorted_)) < 4000 and rows_scanned(asked(plain)) == 20_000


def test_a_hot_ticker_is_cut_by_time(spark, tmp_path):
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    spark.range(200_000).select(
        F.lit("HOT").alias("ticker"), F.timestamp_seconds(F.lit(1704067200) + F.col("id")).alias("event_time"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"), F.lit(date(2024, 1, 1)).alias("event_date"),
    ).write.partitionBy("event_date").parquet(source)
    compact_days(spark, source, target, date(2024, 1, 2), "event_date", bytes_per_file="200KB", cluster_by=("ticker", "event_time"))
    assert len(spark.read.parquet(target).inputFiles()) > 1


def stream_of(spark, folder, frames):
    """One file per frame, in this order, one per micro-batch."""
    for number, frame in enumerate(frames):
        path = f"{folder}/{number}"
        frame.coalesce(1).write.parquet(path)
        for name in os.listdir(path):
            os.utime(f"{path}/{name}", (1_700_000_000 + number,) * 2)
    return spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", 1).option(
        "recursiveFileLookup", True).parquet(folder)


def test_outliers_of_replayed_streams_equal_those_of_the_tables(spark, tmp_path, make_trades):
    def minute(m):
        prices = [100.0] * 8 + [90.0, 110.0]
        return [(f"{m}-{i}", ticker, price, 10, "BUY", str(START + timedelta(minutes=m, seconds=5 * i)))
                for ticker in ("AAPL", None) for i, price in enumerate(prices)]

    files = [make_trades(minute(m)) for m in range(12)]
    trades = files[0]
    for more in files[1:]:
        trades = trades.unionAll(more)
    live = stream_of(spark, str(tmp_path / "trades"), files)
    bounds = anomaly_bounds(windowed_vwap(live, "1 minute", "10 seconds"))
    kept = str(tmp_path / "bounds")
    finish({"bounds": write_stream(bounds, kept, str(tmp_path / "bounds-state"), trigger=AVAILABLE_NOW)})
    again = stream_of(spark, str(tmp_path / "again"), files)
    found = str(tmp_path / "found")
    query = write_stream(
        stream_outlier_trades(again, stored_stream(spark, kept, bounds.schema)), found,
        str(tmp_path / "state"), trigger=AVAILABLE_NOW)
    finish({"outliers": query})
    stored = anomaly_bounds(windowed_vwap(trades, "1 minute"))
    closed = stored.filter(F.col("window_end") <= F.lit(START + timedelta(minutes=11, seconds=35)))
    want = outlier_trades(trades, closed)
    assert want.count() == 22
    assert sorted(map(str, spark.read.parquet(found).select(*want.columns).collect())) == sorted(map(str, want.collect()))
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert held[-1] < 12 * 20       # trades of closed windows are gone from the state
