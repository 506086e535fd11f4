from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tickerloom.fixed_values import BAR_COLUMNS, BOUND_COLUMNS
from tickerloom.functions.measures import window_end, window_start
from tickerloom.operators.bars import anomaly_bounds, vwap_by_ticker, windowed_vwap


@pytest.mark.parametrize("rows, expected", [
    ([(10.0, 100), (12.0, 200)], 11.3333),
    ([(140.0, 500)], 140.0),
    ([(280.0, 100), (290.0, 100)], 285.0),
    ([(100.0, 1), (200.0, 10000)], 199.99),
    ([(10.0, 0)], None),
    ([(10.0, None), (12.0, 5)], 12.0),
])
def test_vwap(make_trades, spark, rows, expected):
    trades = make_trades([
        (str(i), "AAPL", p, q, "BUY", "2024-01-01 10:00:10") for i, (p, q) in enumerate(rows)
    ])
    bar = windowed_vwap(trades).collect()[0]
    plain = vwap_by_ticker(trades).collect()[0]
    for got in (bar.vwap, plain.vwap):
        assert got is None if expected is None else got == pytest.approx(expected, abs=0.01)
    assert bar.trade_count == len(rows)


def test_bar_measures(make_trades):
    trades = make_trades([
        ("a", "AAPL", 10.0, 100, "BUY", "2024-01-01 10:00:00"),
        ("b", "AAPL", 12.0, 200, "SELL", "2024-01-01 10:00:59.999999"),
        ("c", "AAPL", 20.0, 300, "UNKNOWN", "2024-01-01 10:01:00"),
        (None, "AAPL", 11.0, 100, None, "2024-01-01 10:00:30"),
        ("e", "AAPL", 11.0, 100, "BUY", None),
    ])
    bars = windowed_vwap(trades).orderBy("window_start")
    assert bars.columns == BAR_COLUMNS
    first, second = bars.collect()
    assert (first.low_price, first.high_price, first.avg_price) == (10.0, 12.0, 11.0)
    assert (first.total_volume, first.buy_volume, first.sell_volume) == (400, 100, 300)
    assert first.trade_count == 2  # the NULL id is not counted
    assert first.total_dollar_volume == 4500.0
    assert first.buy_pressure == Decimal("25.00")
    assert first.avg_spread == Decimal("0.0200")
    assert str(first.window_start) == "2024-01-01 10:00:00"
    assert str(first.window_end) == "2024-01-01 10:01:00"
    assert first.window_duration == "1 minute"
    assert second.buy_pressure == Decimal("0.00") and second.sell_volume == 300


def test_all_null_measures(make_trades, spark):
    trades = make_trades([("a", "AAPL", None, None, None, "2024-01-01 10:00:00")])
    bar = windowed_vwap(trades).collect()[0]
    assert bar.vwap is None and bar.total_volume is None and bar.buy_pressure is None


def test_pressure_overflow_is_null(make_trades):
    # Negative sell quantities can push the share past decimal(5,2).
    trades = make_trades([
        ("a", "AAPL", 1.0, 1000, "BUY", "2024-01-01 10:00:00"),
        ("b", "AAPL", 1.0, -999, "SELL", "2024-01-01 10:00:00"),
    ])
    assert windowed_vwap(trades).collect()[0].buy_pressure is None


def test_durations_share_rows(make_trades):
    trades = make_trades([
        (str(i), "AAPL", 10.0, 1, "BUY", f"2024-01-01 10:0{i}:00") for i in range(10)
    ])
    assert windowed_vwap(trades, "1 minute").count() == 10
    five = windowed_vwap(trades, "5 minutes").orderBy("window_start").collect()
    assert [b.trade_count for b in five] == [5, 5]


def test_bounds(make_trades):
    trades = make_trades([
        ("a", "AAPL", 90.0, 1, "BUY", "2024-01-01 10:00:00"),
        ("b", "AAPL", 110.0, 3, "BUY", "2024-01-01 10:00:01"),
    ])
    bounds = anomaly_bounds(windowed_vwap(trades))
    assert bounds.columns == BOUND_COLUMNS
    row = bounds.collect()[0]
    assert row.window_avg_price == 100.0  # plain mean, not VWAP
    assert row.anomaly_upper == pytest.approx(102.0)
    assert row.anomaly_lower == pytest.approx(98.0)
    assert (row.window_volume, row.window_trade_count, row.threshold_pct) == (4, 2, 2.0)


@pytest.mark.parametrize("duration", [
    "10 seconds", "1 minute", "5 minutes", "7 minutes", "1 hour", "1 day", "1 week",
])
def test_window_arithmetic_equals_window_function(spark, duration):
    times = spark.range(5000).select(
        F.timestamp_micros(F.col("id") * 987_654_321_987 - F.lit(10**15)).alias("t")
    )
    start = window_start(F.col("t"), duration)
    differing = times.select(
        start.alias("s"), window_end(start, duration).alias("e"),
        F.window("t", duration).alias("w"),
    ).filter("s <> w.start OR e <> w.end")
    assert differing.count() == 0


def test_durations_need_a_fixed_length(make_trades):
    with pytest.raises(ValueError, match="fixed length"):
        windowed_vwap(make_trades([]), "1 month")
