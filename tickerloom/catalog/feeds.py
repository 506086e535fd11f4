"""The provided tables seen as trades, message streams and deliveries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, TimestampType

from tickerloom.operators.trades import enrich
from tickerloom.session import prepare
from tickerloom.sources.tables import read_table

EVENTS = """
    event_id bigint, ts timestamp, user_id bigint, event_type string, value double,
    props string
"""
LINEITEM = """
    l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
    l_quantity double, l_extendedprice double, l_returnflag string, l_shipdate timestamp
"""
PART = "p_partkey bigint, p_brand string"

TICKERS = ["click", "error", "purchase", "signup", "view"]
# Re-deliver every 40th event, to have duplicates.
REDELIVERED = 40


def events_as_trades(events: DataFrame) -> DataFrame:
    """Event rows -> enriched trades; a row-wise mapping, for batch and stream alike."""
    price, user = F.col("value"), F.col("user_id")
    half_spread = price * (1 + F.col("event_id") % 15) / 20_000
    quoted = user % 7 != 0
    lots = F.get_json_object("props", "$.k").cast("int")
    return enrich(events.select(
        F.col("event_id").cast("string").alias("trade_id"),
        F.col("event_type").alias("ticker"),
        price.alias("price"),
        lots.alias("quantity"),
        F.when(user % 3 == 0, "BUY").when(user % 3 == 1, "SELL").otherwise("UNKNOWN").alias("side"),
        F.when(lots >= 50, "round_lot").otherwise("odd_lot").alias("trade_type"),
        F.when(quoted, price - half_spread).alias("bid_price"),
        F.when(quoted, price + half_spread).alias("ask_price"),
        F.lit("ARCA").alias("exchange"),
        F.when(quoted, "simulator").otherwise("finnhub_live").alias("source"),
        F.col("ts").alias("event_time"),
        "event_id",
        "user_id",
    ))


def events(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(prepare(spark), f"{sf}/events.parquet", schema=EVENTS)


def events_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The event table as a file stream; the glob fits one file and a folder alike."""
    return prepare(spark).readStream.schema(EVENTS).parquet(f"{sf}/events.parquet*")


def trades(spark: SparkSession, sf: str) -> DataFrame:
    return events_as_trades(events(spark, sf))


def twice_delivered(df: DataFrame) -> DataFrame:
    """Each row, and every 40th a second time. One scan, no union."""
    copies = F.when(F.col("event_id") % REDELIVERED == 0, 2).otherwise(1)
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")


def order_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as trades, with 25 tickers; ``trade_id`` repeats with other payloads.

    The part side is not hinted: it grows with the data, so its size decides.
    """
    prepare(spark)
    lines = read_table(spark, f"{sf}/lineitem.parquet", schema=LINEITEM)
    part = read_table(spark, f"{sf}/part.parquet", schema=PART)
    flag = F.col("l_returnflag")
    return lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("trade_id"),
        F.col("p_brand").alias("ticker"),
        F.try_divide("l_extendedprice", "l_quantity").alias("price"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.when(flag == "A", "BUY").when(flag == "R", "SELL").otherwise("UNKNOWN").alias("side"),
        F.col("l_shipdate").alias("event_time"),
        "l_partkey",
        "l_suppkey",
    )


def message(columns: DataFrame, key: Column, payload: Column, partition: Column) -> DataFrame:
    """Broker-shaped rows with one payload each."""
    return columns.select(
        key.cast("binary").alias("key"),
        payload.cast("binary").alias("value"),
        F.lit("stock_trades").alias("topic"),
        partition.cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
    )


def ticker_partition(ticker: Column) -> Column:
    return F.ascii(ticker) % 3


def trade_messages(events: DataFrame) -> DataFrame:
    """Each event as a JSON trade message; every 97th payload is not JSON."""
    mapped = events_as_trades(events).withColumn("ts", F.col("event_time"))
    body = F.to_json(F.struct(
        "trade_id", "ticker", "price", "quantity", "side", "trade_type", "bid_price",
        "ask_price",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("timestamp"),
        "exchange", "source",
    ))
    payload = F.when(F.col("event_id") % 97 == 0, "partition_test").otherwise(body)
    return message(mapped, F.col("ticker"), payload, ticker_partition(F.col("ticker")))


def vendor_messages(events: DataFrame) -> DataFrame:
    """Each event as a vendor batch of two trades; every tenth message is a ping."""
    volume = F.get_json_object("props", "$.k").cast("double")
    moment = F.unix_millis("ts")

    def element(price: Column, size: Column) -> Column:
        return F.struct(
            F.col("event_type").alias("s"), price.alias("p"), size.alias("v"), moment.alias("t")
        )

    kind = F.when(F.col("event_id") % 10 == 0, "ping").otherwise("trade")
    body = F.to_json(F.struct(
        kind.alias("type"),
        F.array(
            element(F.col("value"), volume),
            element(F.col("value") * 2, volume * 2.5),
        ).alias("data"),
    ))
    return message(events, F.col("event_type"), body, ticker_partition(F.col("event_type")))


def comparable(df: DataFrame) -> DataFrame:
    """Plain types and settled digits, so that two engines can be compared.

    Doubles are rounded to four digits after a nudge that moves exact ties off
    the rounding boundary, where the last bit of a sum would decide.
    """
    def plain(name: str) -> Column:
        kind = df.schema[name].dataType
        column = F.col(name)
        if isinstance(kind, TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(kind, DecimalType):
            column = column.cast("double")
        elif isinstance(kind, DoubleType):
            column = F.round(column + 1e-9, 4)
        return column.alias(name)

    return df.select(*[plain(n) for n in df.columns])
