"""Vendor trade batches -> trades."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.fixed_values import UNIVERSE, VENDOR_BATCH
from tickerloom.sources.messages import unpack


def normalize_vendor_batch(
    messages: DataFrame, tickers: list[str] | None = None
) -> DataFrame:
    """One trade per element of ``data`` in messages of type ``trade``.

    The id is a hash of the message position and the element position, so a
    replay yields the same ids and deduplication still works. A fractional
    volume has no integer quantity and becomes NULL.
    """
    wanted = tickers if tickers is not None else UNIVERSE
    position = ["topic", "partition", "offset"]
    elements = (
        messages.select(
            *position, F.col("timestamp").alias("kafka_ingest_time"), unpack(VENDOR_BATCH)
        )
        .filter(F.col("type") == "trade")
        .select(
            *position, "kafka_ingest_time", F.posexplode("data").alias("element", "trade")
        )
        .filter(F.col("trade.s").isin(*wanted))
    )
    volume = F.coalesce("trade.v", F.lit(0.0))
    event_time = F.timestamp_millis(F.coalesce("trade.t", F.lit(0)))
    place = F.concat_ws("/", F.coalesce("topic", F.lit("")), *position[1:], "element")
    return elements.select(
        F.sha2(place, 256).alias("trade_id"),
        F.col("trade.s").alias("ticker"),
        F.round(F.coalesce("trade.p", F.lit(0.0)), 2).alias("price"),
        F.when(volume == F.floor(volume), volume.try_cast("int")).alias("quantity"),
        F.lit("UNKNOWN").alias("side"),
        F.when(volume >= 100, "round_lot").otherwise("odd_lot").alias("trade_type"),
        F.lit(None).cast("double").alias("bid_price"),
        F.lit(None).cast("double").alias("ask_price"),
        F.date_format(event_time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("timestamp"),
        F.lit("FINNHUB").alias("exchange"),
        F.lit("finnhub_live").alias("source"),
        "kafka_ingest_time",
        event_time.alias("event_time"),
    )
