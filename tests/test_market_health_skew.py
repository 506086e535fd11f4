import pytest
from pyspark.sql import functions as F

from tickerloom.operators import health, market, skew
from tickerloom.plans.reports import boards, market_report, skew_report
from tickerloom.operators.bars import anomaly_bounds


@pytest.fixture
def bars(make_bars):
    return make_bars(*[
        {"ticker": t, "total_volume": v, "buy_pressure": p, "avg_spread": s, "high_price": h,
         "window_start": w}
        for t, v, p, s, h, w in [
            ("A", 10, "55.04", "0.1000", 101.0, "2024-01-01 10:00:00"),
            ("B", 30, "55.05", "0.3000", 109.0, "2024-01-01 10:00:00"),
            ("C", 20, "45.00", None, 105.0, "2024-01-01 10:00:00"),
            ("A", 30, "44.94", "0.2000", 103.0, "2024-01-01 10:01:00"),
            ("B", 50, None, "0.0500", 99.0, "2024-01-01 10:01:00"),
        ]
    ])


def pairs(df):
    return [(r.ticker, r.window_start.minute) for r in df.collect()]


def test_volume_lists(bars):
    assert pairs(market.volume_leaders(bars, 3)) == [("B", 1), ("A", 1), ("B", 0)]
    assert pairs(market.volume_laggards(bars, 2)) == [("A", 0), ("C", 0)]
    assert pairs(market.window_listing(bars))[0] == ("B", 1)


def test_pressure_uses_the_rounded_value(bars):
    assert pairs(market.bullish(bars)) == [("B", 0)]  # 55.04 rounds to 55.0
    assert pairs(market.bearish(bars)) == [("A", 1)]


def test_liquidity_and_missing_spreads(bars):
    assert pairs(market.most_liquid(bars, 2)) == [("B", 1), ("A", 0)]
    assert pairs(market.most_liquid(bars, 5))[-1] == ("C", 0)
    assert pairs(market.least_liquid(bars, 2)) == [("C", 0), ("B", 0)]
    assert pairs(market.least_liquid(bars, 1, known_only=True)) == [("B", 0)]
    assert market.most_liquid(bars, 1).collect()[0].spread_bps == 5.0


def test_volatility(bars):
    top = market.most_volatile(bars, 1).collect()[0]
    assert (top.ticker, top.range_pct) == ("B", 10.0)
    assert pairs(market.least_volatile(bars, 1)) == [("B", 1)]


def test_latest_window(bars):
    assert pairs(market.latest_window(bars).orderBy("ticker")) == [("A", 1), ("B", 1)]
    assert pairs(market.vwap_board(bars, 15)) == [("B", 1), ("A", 1)]
    assert pairs(market.vwap_board(bars, 1)) == [("B", 1)]
    bounds = anomaly_bounds(bars)
    assert pairs(market.bounds_board(bounds, 5)) == [("B", 1), ("A", 1)]


def test_latest_of_nothing(bars):
    assert market.vwap_board(bars.limit(0)).count() == 0
    assert market.latest_window(bars.limit(0)).count() == 0


@pytest.fixture
def trades(make_trades):
    return make_trades(
        [(str(i), "AB"[i % 2], 1.0, 1, "BUY", f"2024-01-01 10:00:{i:02d}") for i in range(6)]
        + [("x", "A", 1.0, 1, "BUY", "2024-01-01 11:00:00"), (None, "A", 1.0, 1, "BUY", None)]
    )


def test_sources_and_summary(trades, bars):
    named = trades.withColumn("source", F.when(F.col("trade_id") == "x", None)
                              .otherwise(F.col("source")))
    assert [tuple(r) for r in market.source_breakdown(named).collect()] == [("simulator", 6, 2)]
    counts = {r.source: r.cnt for r in market.source_counts(named).collect()}
    assert counts == {"simulator": 7, None: 1}
    row = market.data_summary(named, bars, bars.limit(2)).collect()[0]
    assert tuple(row) == (8, 2, 1, 5, 2)
    board = market.health_board(trades, bars).collect()[0]
    assert (board.raw_trades, board.vwap_windows, board.tickers) == (8, 5, 2)
    assert str(board.latest_trade) == "2024-01-01 11:00:00"
    assert len(market_report(trades, bars, bars)) == 11
    assert boards(trades, bars, anomaly_bounds(bars))["vwap"].count() == 2


def test_table_health(spark, trades, bars):
    rows = health.table_health(spark, {
        "raw_trades": (trades, "event_time"), "vwap_1min": (bars, "window_start"),
        "vwap_5min": (bars.limit(0), "window_start"), "anomaly_alerts": (None, "window_start"),
    })
    got = {r.table_name: (r.row_count, r.status) for r in rows.collect()}
    assert got == {"raw_trades": (8, "OK"), "vwap_1min": (5, "OK"), "vwap_5min": (0, "Empty"),
                   "anomaly_alerts": (None, "Missing")}
    verdict = health.health_verdict(rows).collect()[0]
    assert (verdict.healthy, verdict.tables_not_ok) == (False, 2)
    assert verdict.approx_windows_per_symbol == 1
    good = health.health_verdict(rows.filter("status = 'OK'"), symbols=2).collect()[0]
    assert (good.healthy, good.approx_windows_per_symbol) == (True, 2)


def test_column_summary(bars):
    rows = {r.column_name: r for r in health.column_summary(bars).collect()}
    volume = rows["total_volume"]
    assert (volume.min_value, volume.max_value, volume.mean_value) == (10.0, 50.0, 28.0)
    text = {r["summary"]: r["total_volume"] for r in health.column_summary_text(bars).collect()}
    assert text == {"min": "10", "max": "50", "mean": "28.0"}
    assert health.sample_rows(bars, 2).count() == 2


def tickers(spark, **counts):
    return spark.createDataFrame(
        [(t, f"{t}{i}") for t, n in counts.items() for i in range(n)],
        "ticker string, trade_id string",
    )


def test_skew(spark):
    df = tickers(spark, A=10, B=4, C=2)
    report = skew_report(df)
    assert {r.ticker: r.category for r in report["tickers"].collect()} == {
        "A": "High volume", "B": "Normal", "C": "Normal"}
    row = report["summary"].collect()[0]
    assert (row.tickers, row.median_count, row.max_count, row.min_count, row.skew_ratio) == (
        3, 4.0, 10, 2, 5.0)
    assert [r.ticker for r in skew.top_tickers(df, 2).collect()] == ["A", "B"]
    assert skew.skew_summary(df.limit(0)).collect()[0].skew_ratio == 0.0


def test_salted_count_equals_plain_count(spark):
    df = tickers(spark, A=500, B=3)
    got = {r.ticker: r.cnt for r in skew.salted_count(df, "ticker", "trade_id", 7).collect()}
    assert got == {"A": 500, "B": 3}


def test_key_distribution(spark):
    df = tickers(spark, A=5, B=2, C=1, D=1).withColumn(
        "partition", F.when(F.col("ticker") == "D", 1).otherwise(0))
    got = {r.partition: r for r in skew.key_distribution(df, "ticker", ["A", "B", "D"]).collect()}
    assert (got[0].key_count, got[0].messages, got[0]["keys"]) == (3, 8, "A, B")
    balance = skew.placement_balance(skew.key_distribution(df, "ticker")).collect()[0]
    assert tuple(balance) == (3, 1, 2, True)
    placed = skew.placed_by_hash(df.drop("partition"), "ticker", 3)
    assert skew.key_placement(placed, "ticker").count() == 4
    assert placed.filter("partition NOT BETWEEN 0 AND 2").count() == 0
