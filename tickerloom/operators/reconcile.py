"""Compare streamed bars with bars recomputed in batch from the raw trades."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.fixed_values import CLOSE_DIFF_PCT, CLOSE_PCT, EXACT_DIFF_PCT, PASSED_PCT
from tickerloom.functions.measures import percent, ratio, window_start
from tickerloom.operators.dedup import dedup

KEYS = ["window_start", "ticker"]
# Of the payloads that share an id, the smallest by these is compared.
PAYLOAD_ORDER = ["event_time", "price", "quantity", "ticker"]


def batch_bars(
    trades: DataFrame, duration: str = "1 minute", order_by: list[str] | None = PAYLOAD_ORDER
) -> DataFrame:
    """VWAP, count and volume per window of the deduplicated trades.

    The result does not depend on row order; ``order_by=None`` keeps any payload of an
    id, which is enough, and cheaper, where repeats are exact copies.
    """
    used = ["trade_id", "ticker", "event_time", "price", "quantity"]
    extra = [c for c in order_by or [] if c not in used]
    start = window_start(F.col("event_time"), duration).alias("window_start")
    once = dedup(
        trades.filter(F.col("event_time").isNotNull()).select(*used, *extra), order_by=order_by
    )
    return once.groupBy(start, "ticker").agg(
        ratio(F.sum(F.col("price") * F.col("quantity")), F.sum("quantity")).alias("batch_vwap"),
        F.count("trade_id").alias("batch_trade_count"),
        F.sum("quantity").alias("batch_volume"),
    )


def reconcile(
    trades: DataFrame,
    bars: DataFrame,
    duration: str = "1 minute",
    how: str = "inner",
    order_by: list[str] | None = PAYLOAD_ORDER,
) -> DataFrame:
    """One row per compared window.

    ``how="inner"`` sees windows present on both sides. ``"full_outer"`` also shows
    those that only one side has, told apart by ``seen_in``. The batch side leaves
    its aggregate partitioned by the join keys, so only the bars are shuffled.
    """
    streamed = bars.select(
        *KEYS,
        F.col("vwap").alias("stream_vwap"),
        F.col("trade_count").alias("stream_trade_count"),
        F.col("total_volume").alias("stream_volume"),
    )
    gap = F.abs(F.col("batch_vwap") - F.col("stream_vwap"))
    return (
        batch_bars(trades, duration, order_by)
        .join(streamed, KEYS, how)
        .withColumns({
            "vwap_diff": gap,
            "vwap_diff_pct": percent(gap, F.col("batch_vwap")),
            "count_match": F.col("batch_trade_count") == F.col("stream_trade_count"),
            "seen_in": F.when(F.col("stream_trade_count").isNull(), "batch_only")
            .when(F.col("batch_trade_count").isNull(), "stream_only")
            .otherwise("both"),
        })
    )


def reconcile_summary(compared: DataFrame) -> DataFrame:
    """One row: match counts, match rate and verdict. No windows at all is a failure."""
    diff = F.col("vwap_diff_pct")
    rate = F.col("match_pct")
    return compared.agg(
        F.count("*").alias("total_windows"),
        F.count_if(diff < EXACT_DIFF_PCT).alias("exact_matches"),
        F.count_if(diff < CLOSE_DIFF_PCT).alias("close_matches"),
        F.count_if(F.col("seen_in") == "batch_only").alias("batch_only"),
        F.count_if(F.col("seen_in") == "stream_only").alias("stream_only"),
        F.count_if(~F.col("count_match")).alias("count_mismatches"),
    ).withColumns({
        "mismatched": F.col("total_windows") - F.col("exact_matches"),
        "match_pct": F.coalesce(
            percent(F.col("exact_matches"), F.col("total_windows")), F.lit(0.0)
        ),
    }).withColumn(
        "verdict",
        F.when(rate >= PASSED_PCT, "PASSED").when(rate >= CLOSE_PCT, "CLOSE").otherwise("FAILED"),
    )


def reconcile_mismatches(compared: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` windows that differ most; a difference of exactly 0.01 % differs."""
    return (
        compared.filter(F.col("vwap_diff_pct") >= EXACT_DIFF_PCT)
        .orderBy(F.desc("vwap_diff_pct"), *KEYS)
        .limit(n)
        .select(
            *KEYS,
            *[F.round(c, 4).alias(c) for c in ("batch_vwap", "stream_vwap", "vwap_diff_pct")],
            "count_match",
        )
    )
