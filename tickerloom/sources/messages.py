"""Message sources and the parse from message frames to trades.

A source yields the broker's columns (key, value, topic, partition, offset,
timestamp). Parsing takes any such frame, streaming or batch, so the same
operators serve a live topic, a folder of captured messages and tests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.fixed_values import MESSAGE_FRAME, TRADE_MESSAGE


def topic_messages(
    spark: SparkSession,
    servers: str,
    topic: str = "stock_trades",
    starting: str = "latest",
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Subscribe to one topic. Needs the Kafka connector on the class path.

    ``starting="latest"`` skips what was produced before the first start; use
    ``"earliest"`` when the producer finishes first (scheduled runs).
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
    )
    if max_offsets_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load()


def captured_messages(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Stream of stored message files with the same columns as a topic."""
    reader = spark.readStream.format(fmt).schema(MESSAGE_FRAME)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def keyed_text(messages: DataFrame) -> DataFrame:
    """Key and payload as text, for looking at a topic."""
    return messages.select(
        F.col("key").cast("string").alias("message_key"),
        F.col("value").cast("string").alias("payload"),
        F.col("timestamp").alias("kafka_ingest_time"),
    )


def unpack(schema: str, options: dict[str, str] | None = None) -> Column:
    """The payload's JSON fields as columns; all NULL if the payload does not fit.

    A generator of one row, because a filter on a column is pushed below a plain
    projection together with the parse: each payload would be parsed once for the
    filter and again for the result.
    """
    payload = F.from_json(F.col("value").cast("string"), schema, options)
    return F.inline(F.array(payload))


def parse_trades(messages: DataFrame, keep_key: bool = False) -> DataFrame:
    """Payload JSON -> trade columns, plus ``kafka_ingest_time`` and ``event_time``.

    A payload that is not a trade object gives a row of NULLs, never an error;
    ``rejected_messages`` returns those payloads.
    """
    named = {"kafka_ingest_time": F.col("timestamp")}
    if keep_key:
        named["message_key"] = F.col("key").cast("string")
    parsed = messages.select(unpack(TRADE_MESSAGE), *[c.alias(n) for n, c in named.items()])
    return parsed.withColumn("event_time", F.try_to_timestamp("timestamp"))


def rejected_messages(messages: DataFrame) -> DataFrame:
    """Messages whose payload does not match the trade contract, with the payload."""
    position = ["topic", "partition", "offset"]
    checked = messages.select(
        *position,
        F.col("timestamp").alias("kafka_ingest_time"),
        F.col("value").cast("string").alias("payload"),
        unpack(TRADE_MESSAGE + ", _bad string", {"columnNameOfCorruptRecord": "_bad"}),
    )
    return checked.filter(F.col("_bad").isNotNull() | F.col("trade_id").isNull()).select(
        *position, "kafka_ingest_time", "payload"
    )
