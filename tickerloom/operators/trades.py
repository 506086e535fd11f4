"""Row-level trade operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.fixed_values import BRONZE_COLUMNS
from tickerloom.functions.measures import in_regular_session
from tickerloom.operators.skew import broadcast_if_small


def enrich(trades: DataFrame) -> DataFrame:
    """Add ``dollar_volume``, ``is_buy`` and ``buy_volume``; NULL side stays NULL."""
    is_buy = (F.col("side") == "BUY").cast("int")
    return trades.withColumns({
        "dollar_volume": F.col("price") * F.col("quantity"),
        "is_buy": is_buy,
        "buy_volume": is_buy * F.col("quantity"),
    })


def bronze(trades: DataFrame) -> DataFrame:
    """The event-log projection of enriched trades."""
    return trades.select(*BRONZE_COLUMNS)


def in_session(
    trades: DataFrame, zone: str = "America/New_York", holidays: DataFrame | None = None
) -> DataFrame:
    """Add ``in_session``: whether the trade falls in regular exchange hours.

    ``holidays`` is a dimension with a ``holiday`` date in local time; trades of such a
    day are out of session. Without it every weekday is a trading day.
    """
    flagged = trades.withColumn("in_session", in_regular_session(F.col("event_time"), zone))
    if holidays is None:
        return flagged
    local_day = F.to_date(F.from_utc_timestamp("event_time", zone))
    closed = holidays.select(F.col("holiday").alias("_closed")).distinct()
    return (
        flagged.withColumn("_day", local_day)
        .join(broadcast_if_small(closed), F.col("_day") == F.col("_closed"), "left")
        .withColumn("in_session", F.col("in_session") & F.col("_closed").isNull())
        .drop("_day", "_closed")
    )


def with_sector(trades: DataFrame, sectors: DataFrame) -> DataFrame:
    """Left join to the sector dimension, broadcast after a look at its size."""
    return trades.join(broadcast_if_small(sectors), "ticker", "left")
