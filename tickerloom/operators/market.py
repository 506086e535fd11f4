"""Market reports over bars. Every top-k is tie-broken, so it is repeatable.

Roundings are half-up. Filters and sorts use the rounded value, as shown.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.fixed_values import BEARISH_BELOW, BULLISH_ABOVE
from tickerloom.functions.measures import range_pct, spread_bps

TIES = ["ticker", "window_start"]


def window_listing(bars: DataFrame) -> DataFrame:
    """Every bar, rounded for reading, by volume descending."""
    return bars.select(
        *TIES,
        F.round("vwap", 2).alias("vwap"),
        "total_volume",
        "trade_count",
        F.round("buy_pressure", 1).cast("double").alias("buy_pressure"),
    ).orderBy(F.desc_nulls_last("total_volume"), *TIES)


def volume_leaders(bars: DataFrame, n: int = 5) -> DataFrame:
    return window_listing(bars).limit(n).drop("buy_pressure")


def volume_laggards(bars: DataFrame, n: int = 5) -> DataFrame:
    return (
        window_listing(bars).drop("buy_pressure")
        .orderBy(F.asc_nulls_last("total_volume"), *TIES).limit(n)
    )


def _pressure(bars: DataFrame) -> DataFrame:
    return bars.select(
        *TIES, F.round("buy_pressure", 1).cast("double").alias("buy_pressure")
    )


def bullish(bars: DataFrame, above: float = BULLISH_ABOVE) -> DataFrame:
    return _pressure(bars).filter(F.col("buy_pressure") > above).orderBy(
        F.desc("buy_pressure"), *TIES
    )


def bearish(bars: DataFrame, below: float = BEARISH_BELOW) -> DataFrame:
    return _pressure(bars).filter(F.col("buy_pressure") < below).orderBy(
        F.desc("buy_pressure"), *TIES
    )


def _liquidity(bars: DataFrame) -> DataFrame:
    spread = F.col("avg_spread").cast("double")
    return bars.select(
        *TIES,
        spread.alias("avg_spread"),
        spread_bps(spread, F.col("vwap")).alias("spread_bps"),
    )


def most_liquid(bars: DataFrame, n: int = 5) -> DataFrame:
    """Tightest spreads; bars without a spread come last."""
    return _liquidity(bars).orderBy(F.asc_nulls_last("spread_bps"), *TIES).limit(n)


def least_liquid(bars: DataFrame, n: int = 5, known_only: bool = False) -> DataFrame:
    """Widest spreads. The list is the other end of ``most_liquid``, so bars without
    a spread lead it unless ``known_only``."""
    listed = _liquidity(bars)
    if known_only:
        listed = listed.filter(F.col("spread_bps").isNotNull())
    return listed.orderBy(F.desc_nulls_first("spread_bps"), *TIES).limit(n)


def _volatility(bars: DataFrame) -> DataFrame:
    return bars.select(
        *TIES, "low_price", "high_price", "vwap",
        range_pct(F.col("low_price"), F.col("high_price"), F.col("vwap")).alias("range_pct"),
    )


def most_volatile(bars: DataFrame, n: int = 5) -> DataFrame:
    return _volatility(bars).orderBy(F.desc_nulls_last("range_pct"), *TIES).limit(n)


def least_volatile(bars: DataFrame, n: int = 5, known_only: bool = False) -> DataFrame:
    """Smallest ranges; bars without a range lead unless ``known_only``."""
    listed = _volatility(bars)
    if known_only:
        listed = listed.filter(F.col("range_pct").isNotNull())
    return listed.orderBy(F.asc_nulls_first("range_pct"), *TIES).limit(n)


def source_breakdown(trades: DataFrame) -> DataFrame:
    """Trades and distinct tickers per named source.

    Counted over (source, ticker) first: one pass, no row expansion, and a source
    holding most of the trades is small by the second step.
    """
    return (
        trades.filter(F.col("source").isNotNull())
        .groupBy("source", "ticker")
        .agg(F.count("trade_id").alias("n"))
        .groupBy("source")
        .agg(F.sum("n").alias("trades"), F.count("ticker").alias("tickers"))
    )


def source_counts(trades: DataFrame) -> DataFrame:
    """Rows per source, rows without a source included."""
    return trades.groupBy("source").agg(F.count("*").alias("cnt"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def data_summary(trades: DataFrame, short_bars: DataFrame, long_bars: DataFrame) -> DataFrame:
    """One row: rows per table, distinct tickers, distinct sources."""
    pairs = trades.groupBy("ticker", "source").agg(F.count("*").alias("n"))
    parts = [
        pairs.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("raw_trades"),
            F.countDistinct("ticker").alias("tickers"),
            F.countDistinct("source").alias("sources"),
        ),
        short_bars.agg(F.count("*").alias("short_windows")),
        long_bars.agg(F.count("*").alias("long_windows")),
    ]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    names = ["raw_trades", "tickers", "sources", "short_windows", "long_windows"]
    return merged.agg(*[F.max(n).alias(n) for n in names])


def latest_window(df: DataFrame, time: str = "window_start") -> DataFrame:
    """Rows of the newest window. The maximum stays in the plan as a scalar subquery."""
    return df.filter(F.col(time) == df.select(F.max(time)).scalar())


def latest_top(df: DataFrame, volume: str, n: int) -> DataFrame:
    """Top ``n`` of the newest window in one scan.

    Sorted by window first, the newest window's leaders head the list; the rows of
    older windows among those ``n`` are then dropped. The window function sees
    ``n`` rows.
    """
    head = df.orderBy(F.desc("window_start"), F.desc_nulls_last(volume), "ticker").limit(n)
    newest = F.max("window_start").over(Window.partitionBy())
    return (
        head.withColumn("_newest", newest)
        .filter(F.col("window_start") == F.col("_newest"))
        .drop("_newest")
    )


def vwap_board(bars: DataFrame, n: int = 15) -> DataFrame:
    """Newest window: the ``n`` tickers with most volume."""
    return latest_top(
        bars.select(*TIES, "vwap", "total_volume", "trade_count"), "total_volume", n
    )


def bounds_board(bounds: DataFrame, n: int = 5) -> DataFrame:
    """Newest window: price bands of the ``n`` tickers with most volume."""
    return latest_top(
        bounds.select(
            *TIES, "window_volume", "window_avg_price", "anomaly_upper", "anomaly_lower"
        ),
        "window_volume", n,
    )


def health_board(trades: DataFrame, bars: DataFrame) -> DataFrame:
    """One row: trades, bars, distinct tickers, newest trade time."""
    per_ticker = trades.groupBy("ticker").agg(
        F.count("*").alias("n"), F.max("event_time").alias("newest")
    )
    parts = per_ticker.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("raw_trades"),
        F.count("*").alias("tickers"),
        F.max("newest").alias("latest_trade"),
    ).unionByName(bars.agg(F.count("*").alias("vwap_windows")), allowMissingColumns=True)
    names = ["raw_trades", "vwap_windows", "tickers", "latest_trade"]
    return parts.agg(*[F.max(n).alias(n) for n in names])
