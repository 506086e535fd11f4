import pytest
from pyspark.sql import functions as F

from tickerloom.operators.bars import anomaly_bounds, windowed_vwap
from tickerloom.operators.outliers import (
    match_windows,
    outlier_directions,
    outlier_summary,
    outlier_trades,
    outliers_by_ticker,
    top_outliers,
)
from tickerloom.plans.outlier_report import outlier_report, stored_bounds


@pytest.fixture
def busy(spark):
    """5,000 trades, half of them in one window of one ticker, many exact copies."""
    hot = F.col("id") % 2 == 0
    return spark.range(5000).select(
        F.when(F.col("id") % 10 == 0, "copy").otherwise(F.col("id").cast("string"))
        .alias("trade_id"),
        F.when(hot, "AAPL").otherwise(F.concat(F.lit("T"), F.col("id") % 7)).alias("ticker"),
        (100 + F.pmod(F.hash("id"), F.lit(20))).cast("double").alias("price"),
        F.lit(10).alias("quantity"),
        F.lit("BUY").alias("side"),
        F.lit("odd_lot").alias("trade_type"),
        F.timestamp_seconds(
            F.when(hot, F.col("id") % 60).otherwise(F.col("id"))
        ).alias("event_time"),
        F.lit(None).cast("double").alias("bid_price"),
        F.lit(None).cast("double").alias("ask_price"),
    ).withColumns({
        "dollar_volume": F.col("price") * F.col("quantity"),
        "buy_volume": F.col("quantity"),
    })


def as_set(df):
    return sorted(map(str, df.collect()))


def brute_force(trades, bounds):
    t, b = trades.alias("t"), bounds.alias("b")
    return t.join(b, (F.col("t.ticker") == F.col("b.ticker"))
                  & (F.col("t.event_time") >= F.col("b.window_start"))
                  & (F.col("t.event_time") < F.col("b.window_end"))).filter(
        "t.price > b.anomaly_upper OR t.price < b.anomaly_lower"
    ).select("t.trade_id", "t.ticker", "t.price", "t.event_time", "b.window_start")


COMPARED = ["trade_id", "ticker", "price", "event_time", "window_start"]


@pytest.mark.parametrize("slice_rows", [10, 200, 5_000_000])
@pytest.mark.parametrize("grid", ["1 minute", None])
def test_join_forms_agree_with_brute_force(busy, slice_rows, grid):
    bounds = anomaly_bounds(windowed_vwap(busy))
    got = outlier_trades(busy, bounds, grid, slice_rows=slice_rows).select(*COMPARED)
    want = brute_force(busy, bounds)
    assert want.count() > 1000
    assert as_set(got) == as_set(want)


@pytest.mark.parametrize("cell_seconds", [7, 60, 1000])
def test_intervals_off_the_grid(busy, spark, cell_seconds):
    """Overlapping windows of odd lengths: every pair is found exactly once."""
    bounds = spark.range(40).select(
        F.when(F.col("id") % 2 == 0, "AAPL").otherwise("T3").alias("ticker"),
        F.timestamp_seconds(F.col("id") * 31 - 5).alias("window_start"),
        F.timestamp_seconds(F.col("id") * 31 - 5 + F.col("id") * 13).alias("window_end"),
        F.lit(100.0).alias("window_avg_price"),
        F.lit(104.0).alias("anomaly_upper"),
        F.lit(98.0).alias("anomaly_lower"),
        (F.col("id") * 100).alias("window_trade_count"),
    )
    got = outlier_trades(
        busy, bounds, None, cell_seconds=cell_seconds, slice_rows=300
    ).select(*COMPARED)
    assert as_set(got) == as_set(brute_force(busy, bounds))


@pytest.mark.parametrize("slice_rows", [10, 5_000_000])
def test_repeated_bounds_multiply_trades(busy, slice_rows):
    """A window listed twice, with different counts, pairs each trade twice."""
    bounds = anomaly_bounds(windowed_vwap(busy))
    twice = bounds.unionAll(bounds.withColumn("window_trade_count", F.lit(1).cast("bigint")))
    once = outlier_trades(busy, bounds, slice_rows=slice_rows).count()
    assert outlier_trades(busy, twice, slice_rows=slice_rows).count() == 2 * once


def test_the_rate_counts_a_trade_once(busy):
    """Bounds stored three times, every trade delivered twice: still a rate."""
    bounds = anomaly_bounds(windowed_vwap(busy))
    trades, repeated = busy.unionAll(busy), bounds.unionAll(bounds).unionAll(bounds)
    found = outlier_trades(trades, repeated)
    row = outlier_summary(trades, repeated, found).collect()[0]
    assert row.total_trades == busy.select("trade_id").distinct().count()
    assert row.total_windows == bounds.count()
    assert 0 < row.anomalies <= row.total_trades and row.anomaly_rate_pct <= 100
    raw = outlier_summary(trades, repeated, found, distinct=False).collect()[0]
    assert raw.anomalies == found.count() == 6 * outlier_trades(busy, bounds).count()


def test_cells_longer_than_windows_are_sliced_by_their_sum(busy):
    """Many windows share a cell; no slice holds much more than ``slice_rows`` trades."""
    bounds = anomaly_bounds(windowed_vwap(busy, "1 minute"), 0.0)
    cell = 30 * 86_400
    placed = match_windows(busy, bounds, None, cell_seconds=cell, slice_rows=100)
    largest = placed.groupBy("ticker", "_slot", "_slice").agg(
        F.countDistinct("trade_id", "event_time", "price").alias("n")).agg(F.max("n")).collect()[0][0]
    assert largest < 250


def test_bounds_are_strict(make_trades, spark):
    trades = make_trades([
        ("low", "AAPL", 98.0, 1, "BUY", "2024-01-01 10:00:00"),
        ("mid", "AAPL", 100.0, 1, "BUY", "2024-01-01 10:00:00"),
        ("high", "AAPL", 102.0, 1, "BUY", "2024-01-01 10:00:00"),
    ])
    bounds = anomaly_bounds(windowed_vwap(trades)).withColumns({
        "anomaly_upper": F.lit(102.0), "anomaly_lower": F.lit(98.0),
    })
    assert outlier_trades(trades, bounds).count() == 0
    assert outlier_trades(trades, bounds.withColumn("anomaly_upper", F.lit(101.9))).count() == 1


def test_summaries(make_trades):
    rows = [(str(i), "AAPL", 100.0, 1, "BUY", "2024-01-01 10:00:00") for i in range(8)]
    rows += [("up", "AAPL", 150.0, 1, "BUY", "2024-01-01 10:00:00"),
             ("down", "MSFT", 10.0, 1, "BUY", "2024-01-01 10:00:00"),
             ("flat", "MSFT", 90.0, 1, "BUY", "2024-01-01 10:00:01")]
    trades = make_trades(rows)
    bounds = stored_bounds(trades, threshold_pct=10.0)
    report = outlier_report(trades, bounds)
    summary = report["summary"].collect()[0]
    assert (summary.total_trades, summary.total_windows, summary.anomalies) == (11, 2, 3)
    assert (summary.above, summary.below) == (2, 1)
    assert summary.anomaly_rate_pct == pytest.approx(300 / 11)
    assert [(r.ticker, r.anomalies) for r in report["by_ticker"].collect()] == [
        ("MSFT", 2), ("AAPL", 1)]
    assert [r.trade_id for r in report["top"].collect()] == ["flat", "up", "down"]
    share = report["directions"].collect()[0]
    assert share.above_pct == pytest.approx(200 / 3)


def test_nothing_found(make_trades):
    empty = make_trades([])
    bounds = anomaly_bounds(windowed_vwap(empty))
    found = outlier_trades(empty, bounds)
    summary = outlier_summary(empty, bounds, found).collect()[0]
    assert (summary.anomalies, summary.anomaly_rate_pct) == (0, 0.0)
    assert outlier_directions(found).collect()[0].above_pct is None
    assert outliers_by_ticker(found).count() == 0 and top_outliers(found).count() == 0
