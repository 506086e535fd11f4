"""Tumbling-window bars and the price bounds derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.fixed_values import BAR_COLUMNS, BOUND_COLUMNS, THRESHOLD_PCT
from tickerloom.functions.measures import percent, ratio, window_end, window_start


def _by_window(trades: DataFrame, duration: str, measures: list[Column]) -> DataFrame:
    """Aggregate per (window, ticker) and expose ``window_start``/``window_end``.

    State eviction in a stream needs the window struct as the key. In batch the
    start alone is the key: it is half as wide in the shuffle, and the result is
    already partitioned for a join on (window_start, ticker).
    """
    if trades.isStreaming:
        grouped = trades.groupBy(F.window("event_time", duration).alias("_w"), "ticker")
        return (
            grouped.agg(*measures)
            .withColumn("window_start", F.col("_w.start"))
            .withColumn("window_end", F.col("_w.end"))
            .drop("_w")
        )
    start = window_start(F.col("event_time"), duration).alias("window_start")
    return (
        trades.filter(F.col("event_time").isNotNull())
        .groupBy(start, "ticker")
        .agg(*measures)
        .withColumn("window_end", window_end(F.col("window_start"), duration))
    )


def windowed_vwap(
    trades: DataFrame,
    duration: str = "1 minute",
    watermark: str | None = None,
    unknown_volume: bool = False,
) -> DataFrame:
    """One bar per (window, ticker) of enriched trades.

    ``unknown_volume`` adds the volume whose side is neither BUY nor SELL, which
    ``sell_volume`` contains.

    Every measure has a map-side partial form, so a ticker holding most of the
    rows reaches the shuffle as one row per map task and window.
    """
    if watermark is not None:
        trades = trades.withWatermark("event_time", watermark)
    volume, bought = F.col("total_volume"), F.col("buy_volume")
    unknown = F.when(~F.coalesce(F.col("side").isin("BUY", "SELL"), F.lit(False)), F.col("quantity"))
    extra = [F.coalesce(F.sum(unknown), F.lit(0)).alias("unknown_volume")] if unknown_volume else []
    bars = _by_window(trades, duration, [
        *extra,
        F.sum("dollar_volume").alias("total_dollar_volume"),
        F.sum("quantity").alias("total_volume"),
        F.sum("buy_volume").alias("buy_volume"),
        F.count("trade_id").alias("trade_count"),
        F.min("price").alias("low_price"),
        F.max("price").alias("high_price"),
        F.avg("price").alias("avg_price"),
        F.avg("bid_price").alias("avg_bid"),
        F.avg("ask_price").alias("avg_ask"),
    ])
    return bars.withColumns({
        "vwap": ratio(F.col("total_dollar_volume"), volume),
        "sell_volume": volume - bought,
        "buy_pressure": percent(bought, volume).try_cast("decimal(5,2)"),
        "avg_spread": (F.col("avg_ask") - F.col("avg_bid")).try_cast("decimal(10,4)"),
        "window_duration": F.lit(duration),
    }).select(*BAR_COLUMNS, *(["unknown_volume"] if unknown_volume else []))


#: Sums and counts that, kept beside a bar, let bars of longer windows be made from it.
PART_COLUMNS = ["price_sum", "price_count", "bid_sum", "bid_count", "ask_sum", "ask_count"]


def _finished(sums: DataFrame, duration: str) -> DataFrame:
    """Bars, with their parts, from sums, counts and extremes."""
    volume, bought = F.col("total_volume"), F.col("buy_volume")
    return sums.withColumns({
        "avg_price": ratio(F.col("price_sum"), F.col("price_count")),
        "avg_bid": ratio(F.col("bid_sum"), F.col("bid_count")),
        "avg_ask": ratio(F.col("ask_sum"), F.col("ask_count")),
    }).withColumns({
        "vwap": ratio(F.col("total_dollar_volume"), volume),
        "sell_volume": volume - bought,
        "buy_pressure": percent(bought, volume).try_cast("decimal(5,2)"),
        "avg_spread": (F.col("avg_ask") - F.col("avg_bid")).try_cast("decimal(10,4)"),
        "window_duration": F.lit(duration),
    }).select(*BAR_COLUMNS, *PART_COLUMNS)


def mergeable_bars(
    trades: DataFrame, duration: str = "1 minute", watermark: str | None = None
) -> DataFrame:
    """The bars of ``windowed_vwap`` with the parts that ``rollup_bars`` needs.

    A mean cannot be merged; its sum and count can.
    """
    if watermark is not None:
        trades = trades.withWatermark("event_time", watermark)
    means = [measure(name).alias(f"{short}_{kind}")
             for short, name in (("price", "price"), ("bid", "bid_price"), ("ask", "ask_price"))
             for kind, measure in (("sum", F.sum), ("count", F.count))]
    return _finished(_by_window(trades, duration, [
        F.sum("dollar_volume").alias("total_dollar_volume"),
        F.sum("quantity").alias("total_volume"),
        F.sum("buy_volume").alias("buy_volume"),
        F.count("trade_id").alias("trade_count"),
        F.min("price").alias("low_price"),
        F.max("price").alias("high_price"),
        *means,
    ]), duration)


def rollup_bars(bars: DataFrame, duration: str = "5 minutes") -> DataFrame:
    """Bars of longer windows from stored ``mergeable_bars``, whose windows must divide theirs.

    No trade is read again. On a stream, bars of a window come before those of later windows,
    as a closed-window table emits them, so no delay is waited for: a long bar is emitted when
    the first short bar behind its window is there. Rows that came too late for their short
    window are in no short bar and so in no long one, though bars made from trades may still
    have counted them in the longer window.
    """
    shorter = bars.withColumnRenamed("window_start", "event_time")
    if bars.isStreaming:
        shorter = shorter.withWatermark("event_time", "0 seconds")
    added = ["total_dollar_volume", "total_volume", "buy_volume", "trade_count", *PART_COLUMNS]
    return _finished(_by_window(shorter, duration, [
        *[F.sum(name).alias(name) for name in added],
        F.min("low_price").alias("low_price"),
        F.max("high_price").alias("high_price"),
    ]), duration)


def anomaly_bounds(bars: DataFrame, threshold_pct: float = THRESHOLD_PCT) -> DataFrame:
    """Band of ``threshold_pct`` around each bar's plain average price.

    A projection of the bars: on top of a bar aggregate Catalyst prunes it to the
    three measures used here; on a stored bar table nothing is aggregated again.
    """
    mean = F.col("avg_price")
    return bars.select(
        "ticker",
        mean.alias("window_avg_price"),
        F.col("total_volume").alias("window_volume"),
        F.col("trade_count").alias("window_trade_count"),
        "window_start",
        "window_end",
        (mean * (1 + threshold_pct / 100)).alias("anomaly_upper"),
        (mean * (1 - threshold_pct / 100)).alias("anomaly_lower"),
        F.lit(float(threshold_pct)).alias("threshold_pct"),
    ).select(*BOUND_COLUMNS)


def vwap_by_ticker(trades: DataFrame) -> DataFrame:
    """Volume-weighted price per ticker without windows, from price and quantity."""
    return trades.groupBy("ticker").agg(
        ratio(F.sum(F.col("price") * F.col("quantity")), F.sum("quantity")).alias("vwap")
    )
