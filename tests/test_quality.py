import pytest
from pyspark.sql import functions as F

from tickerloom.fixed_values import UNIVERSE
from tickerloom.operators.quality import (
    contaminated_tickers,
    gate,
    lateness_audit,
    missing_tickers,
    quality_checks,
    ticker_bars,
    ticker_max_vwap,
)
from tickerloom.plans.publish import GateClosed, require_quality
from tickerloom.plans.reports import quality_report
from tickerloom.sources.dimensions import universe

ALL = [{"ticker": t} for t in UNIVERSE]


def failed(short, long_):
    return [r.check_no for r in quality_checks(short, long_).filter("not passed").collect()]


def test_clean(make_bars):
    bars = make_bars(*ALL)
    report = quality_report(bars, bars)
    assert report["checks"].count() == 7
    row = report["gate"].collect()[0]
    assert (row.passed_checks, row.total_checks, row.failed_checks, row.ok) == (7, 7, "", True)
    require_quality(report["checks"])


@pytest.mark.parametrize("no, change", [
    (1, {"vwap": None}),
    (2, {"vwap": 0.99}),
    (2, {"vwap": 2000.01}),
    (3, {"buy_pressure": "-0.01"}),
    (3, {"buy_pressure": "100.01"}),
    (4, {"total_volume": 0}),
    (6, {"window_end": "2024-01-01 10:00:59"}),
    (6, {"window_end": None}),
    (7, {"high_price": 98.0}),
])
def test_one_bad_row_fails_one_check(make_bars, no, change):
    assert failed(make_bars(*ALL, change), make_bars(*ALL)) == [no]


@pytest.mark.parametrize("change", [
    {"vwap": 1.0}, {"vwap": 2000.0}, {"buy_pressure": None}, {"buy_pressure": "0.00"},
    {"buy_pressure": "100.00"}, {"total_volume": None}, {"high_price": 99.0},
    {"high_price": None}, {"low_price": None},
])
def test_edges_and_nulls_pass(make_bars, change):
    assert failed(make_bars(*ALL, change), make_bars(*ALL, change)) == []


def test_window_width_is_checked_on_short_bars_only(make_bars):
    wide = {"window_end": "2024-01-01 10:05:00"}
    assert failed(make_bars(*ALL), make_bars(*[{**t, **wide} for t in ALL])) == []


def test_completeness_is_checked_on_long_bars_only(make_bars, spark):
    most = [t for t in ALL if t["ticker"] not in ("LLY", "KO")]
    assert failed(make_bars(*most), make_bars(*ALL)) == []
    checks = quality_checks(make_bars(*ALL), make_bars(*most, {"ticker": "STRAY"}))
    row = checks.filter("check_no = 5").collect()[0]
    assert (row.violations, row.detail) == (2, "missing: KO, LLY")
    absent = missing_tickers(make_bars(*most), universe(spark))
    assert {r.ticker for r in absent.collect()} == {"KO", "LLY"}


def test_empty_long_table_fails_only_completeness(make_bars):
    assert failed(make_bars(*ALL), make_bars()) == [5]
    assert failed(make_bars(), make_bars(*ALL)) == []


def test_gate_lists_failures(make_bars):
    checks = quality_checks(
        make_bars({"vwap": None, "total_volume": -1}), make_bars(*ALL, {"high_price": 1.0})
    )
    row = gate(checks).collect()[0]
    assert (row.passed_checks, row.failed_checks, row.ok) == (4, "1, 4, 7", False)
    with pytest.raises(GateClosed) as error:
        require_quality(checks)
    assert [f[0] for f in error.value.failed] == [1, 4, 7]


def test_contamination(make_bars):
    bars = make_bars({"vwap": 999.0}, {"vwap": 500.0, "ticker": "KO"},
                     {"vwap": 900.0, "ticker": "LLY"}, {"vwap": None, "ticker": "V"})
    assert [r.ticker for r in contaminated_tickers(bars).collect()] == ["AAPL"]
    assert {r.ticker: r.max_vwap for r in ticker_max_vwap(bars).collect()}["LLY"] == 900.0
    assert ticker_bars(bars, "KO").count() == 1


def late_rows(make_trades):
    rows = [(f"ontime-{i}", "AAPL", 210.0, 100, "BUY", "2024-01-01 10:00:10") for i in range(20)]
    rows += [(f"late-within-{i}", "AAPL", 211.0, 500, "BUY", "2024-01-01 10:00:20")
             for i in range(5)]
    rows += [(f"late-beyond-{i}", "AAPL", 999.99, 9999, "BUY", "2024-01-01 09:59:10")
             for i in range(5)]
    return make_trades(rows, source="late_data_demo")


def audit(trades, bars):
    return {r.check_name: (r.actual, r.passed) for r in lateness_audit(trades, bars, "AAPL").collect()}


def test_lateness_audit(make_trades, make_bars):
    trades = late_rows(make_trades)
    clean = audit(trades, make_bars({"vwap": 210.5}))
    assert all(passed for _, passed in clean.values()) and len(clean) == 6
    poisoned = audit(trades, make_bars({"vwap": 910.5}))
    assert poisoned["AAPL vwap within limit"] == (1, False)


def test_lateness_audit_does_not_pass_on_no_output(make_trades, make_bars):
    trades = late_rows(make_trades)
    nothing = audit(trades, make_bars())
    assert nothing["on-time window emitted"] == (0, False)
    missing = audit(trades.filter(~F.col("trade_id").startswith("late-beyond")), make_bars({}))
    assert missing["late-beyond stored"] == (0, False)
