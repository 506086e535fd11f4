"""The remaining reports: each is a set of frames, computed when read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickerloom.operators import dedup, health, market, quality, reconcile, skew
from tickerloom.session import materialize
from tickerloom.sources.tables import read_tables


def market_report(
    trades: DataFrame, short_bars: DataFrame, long_bars: DataFrame
) -> dict[str, DataFrame]:
    return {
        "data": market.data_summary(trades, short_bars, long_bars),
        "listing": market.window_listing(long_bars),
        "leaders": market.volume_leaders(long_bars),
        "laggards": market.volume_laggards(long_bars),
        "bullish": market.bullish(long_bars),
        "bearish": market.bearish(long_bars),
        "most_liquid": market.most_liquid(long_bars),
        "least_liquid": market.least_liquid(long_bars),
        "most_volatile": market.most_volatile(long_bars),
        "least_volatile": market.least_volatile(long_bars),
        "sources": market.source_breakdown(trades),
    }


def boards(trades: DataFrame, bars: DataFrame, bounds: DataFrame) -> dict[str, DataFrame]:
    return {
        "vwap": market.vwap_board(bars),
        "health": market.health_board(trades, bars),
        "bounds": market.bounds_board(bounds),
    }


def reconciliation_report(
    trades: DataFrame,
    bars: DataFrame,
    duration: str = "1 minute",
    how: str = "inner",
    order_by: list[str] | None = reconcile.PAYLOAD_ORDER,
) -> dict[str, DataFrame]:
    """The comparison is stored, as summary and mismatches both read it."""
    compared = materialize(reconcile.reconcile(trades, bars, duration, how, order_by), "compared")
    return {
        "windows": compared,
        "summary": reconcile.reconcile_summary(compared),
        "mismatches": reconcile.reconcile_mismatches(compared),
        "raw": dedup.duplicate_stats(trades),
    }


def skew_report(trades: DataFrame) -> dict[str, DataFrame]:
    return {"tickers": skew.ticker_skew(trades), "summary": skew.skew_summary(trades)}


# Table name -> column that tells how fresh it is.
FRESHNESS = {
    "raw_trades": "event_time",
    "vwap_1min": "window_start",
    "vwap_5min": "window_start",
    "anomaly_alerts": "window_start",
}


def health_report(spark: SparkSession, base_path: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """Health of the four tables under ``base_path``; missing ones are reported."""
    paths = {name: f"{base_path.rstrip('/')}/{name}" for name in FRESHNESS}
    found = read_tables(spark, paths, fmt, keep_errors=True)
    rows = health.table_health(
        spark, {name: (found[name], time) for name, time in FRESHNESS.items()}
    )
    return {"tables": rows, "verdict": health.health_verdict(rows)}


def quality_report(short_bars: DataFrame, long_bars: DataFrame) -> dict[str, DataFrame]:
    checks = quality.quality_checks(short_bars, long_bars)
    return {"checks": checks, "gate": quality.gate(checks)}
