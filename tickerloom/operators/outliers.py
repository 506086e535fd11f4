"""Trades outside the price band of their window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.fixed_values import WATERMARK
from tickerloom.functions.measures import percent, window_start
from tickerloom.operators.skew import SLICE_ROWS, spread_hot_keys

TRADE_PART = ["trade_id", "ticker", "price", "quantity", "side", "trade_type", "event_time"]
# Trades of a busy window are dealt to its slices by these.
SPREAD_ON = ["trade_id", "event_time", "price", "quantity"]
BOUND_PART = ["window_avg_price", "anomaly_upper", "anomaly_lower", "window_start"]


def match_windows(
    trades: DataFrame,
    bounds: DataFrame,
    grid: str | None = "1 minute",
    cell_seconds: int = 60,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Pair each trade with the bounds of the window(s) holding its event time.

    ``grid`` is the tumbling duration the bounds were built with; the pairing is
    then an equi join on (ticker, window start). ``grid=None`` accepts any
    ``[window_start, window_end)`` intervals: time is cut into cells, an interval
    is listed under each cell it touches, and the join is an equi join on
    (ticker, cell) with the exact interval test on top. A trade has one cell, so
    a pair is found once. Cells about as long as an interval are best: shorter ones
    repeat the bounds, longer ones test more pairs. Busy windows are split, see ``spread_hot_keys``.
    """
    if grid is not None:
        trades = trades.withColumn("_slot", window_start(F.col("event_time"), grid))
        bounds = bounds.withColumn("_slot", F.col("window_start"))
    else:
        width = F.lit(cell_seconds * 1_000_000)

        def cell(micros):
            return F.floor(micros / width)

        trades = trades.withColumn("_slot", cell(F.unix_micros("event_time")))
        bounds = bounds.filter(F.col("window_end") > F.col("window_start")).withColumn(
            "_slot",
            F.explode(F.sequence(
                cell(F.unix_micros("window_start")), cell(F.unix_micros("window_end") - 1)
            )),
        )
    bounds = bounds.select("ticker", "_slot", "window_end", "window_trade_count", *BOUND_PART)
    trades, bounds, keys = spread_hot_keys(
        trades, bounds, ["ticker", "_slot"], "window_trade_count", SPREAD_ON, slice_rows,
    )
    pairs = trades.join(bounds, keys)
    if grid is None:
        pairs = pairs.filter(
            (F.col("event_time") >= F.col("window_start"))
            & (F.col("event_time") < F.col("window_end"))
        )
    return pairs


def outlier_trades(
    trades: DataFrame,
    bounds: DataFrame,
    grid: str | None = "1 minute",
    cell_seconds: int = 60,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Trades strictly above the upper or below the lower bound of their window."""
    return _outside(match_windows(trades.select(*TRADE_PART), bounds, grid, cell_seconds, slice_rows))


def _outside(pairs: DataFrame) -> DataFrame:
    outside = (F.col("price") > F.col("anomaly_upper")) | (
        F.col("price") < F.col("anomaly_lower")
    )
    deviation = percent(F.col("price") - F.col("window_avg_price"), F.col("window_avg_price"))
    return pairs.filter(outside).select(
        *TRADE_PART, *BOUND_PART, F.round(deviation, 2).alias("deviation_pct"))


def stream_outlier_trades(
    trades: DataFrame, bounds: DataFrame, grid: str = "1 minute", delay: str = WATERMARK
) -> DataFrame:
    """``outlier_trades`` on streams: trades joined with the bounds of closed windows.

    ``bounds`` is the stream of a stored bounds table, whose windows of ``grid`` come in order.
    Both sides have a watermark and the join a time range, so a trade is kept until the bounds
    of its window have come and no longer; state holds the trades of the windows that are still
    open, whatever the length of the streams. The window start is a join key beside the ticker,
    so a busy ticker is looked up window by window. A trade later than ``delay`` is left out;
    ``outlier_trades`` over the stored tables finds it.
    """
    live = trades.select(*TRADE_PART).withWatermark("event_time", delay).withColumn(
        "_slot", window_start(F.col("event_time"), grid))
    known = (
        bounds.select(F.col("ticker").alias("_ticker"), F.col("window_start").alias("_start"), *BOUND_PART)
        .withWatermark("window_start", "0 seconds")
    )
    same = (F.col("ticker") == F.col("_ticker")) & (F.col("_slot") == F.col("_start"))
    inside = (F.col("event_time") >= F.col("window_start")) & (
        F.col("event_time") < F.col("window_start") + F.expr(f"INTERVAL {grid}"))
    return _outside(live.join(known, same & inside))


def outliers_by_ticker(outliers: DataFrame) -> DataFrame:
    return (
        outliers.groupBy("ticker").agg(F.count("*").alias("anomalies"))
        .orderBy(F.desc("anomalies"), "ticker")
    )


def outlier_directions(outliers: DataFrame) -> DataFrame:
    """One row: how many outliers lie above and below, with shares."""
    return outliers.agg(
        F.count("*").alias("anomalies"),
        F.count_if(F.col("price") > F.col("anomaly_upper")).alias("above"),
        F.count_if(F.col("price") < F.col("anomaly_lower")).alias("below"),
    ).withColumns({
        "above_pct": percent(F.col("above"), F.col("anomalies")),
        "below_pct": percent(F.col("below"), F.col("anomalies")),
    })


def distinct_outliers(outliers: DataFrame) -> DataFrame:
    """One row: outlier trades by id, however often a trade or its bounds are stored."""
    per_trade = outliers.groupBy("trade_id").agg(
        F.bool_or(F.col("price") > F.col("anomaly_upper")).alias("high"),
        F.bool_or(F.col("price") < F.col("anomaly_lower")).alias("low"),
    )
    return per_trade.agg(
        F.count("*").alias("anomalies"),
        F.count_if("high").alias("above"),
        F.count_if("low").alias("below"),
    )


def outlier_summary(
    trades: DataFrame, bounds: DataFrame, outliers: DataFrame, distinct: bool = True
) -> DataFrame:
    """One row of totals; the rate is 0 when there are no trades.

    By default a trade id and a (window, ticker) count once, so the rate cannot exceed
    100 %. ``distinct=False`` counts stored rows and pairs as they are.
    """
    if distinct:
        trades = trades.select("trade_id").distinct()
        bounds = bounds.select("window_start", "ticker").distinct()
    counts = [
        trades.agg(F.count("*").alias("total_trades")),
        bounds.agg(F.count("*").alias("total_windows")),
        distinct_outliers(outliers) if distinct
        else outlier_directions(outliers).select("anomalies", "above", "below"),
    ]
    merged = counts[0]
    for part in counts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    names = ["total_trades", "total_windows", "anomalies", "above", "below"]
    return merged.agg(*[F.max(n).alias(n) for n in names]).withColumn(
        "anomaly_rate_pct",
        F.coalesce(percent(F.col("anomalies"), F.col("total_trades")), F.lit(0.0)),
    )


def top_outliers(outliers: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` highest deviations; ties go to the smaller trade id."""
    return outliers.orderBy(F.desc("deviation_pct"), "trade_id").limit(n)
