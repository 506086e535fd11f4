import json

from pyspark.sql import functions as F

from tickerloom.fixed_values import BRONZE_COLUMNS, MESSAGE_FRAME
from tickerloom.operators.trades import bronze, enrich, in_session, with_sector
from tickerloom.operators.vendor import normalize_vendor_batch
from tickerloom.sources.dimensions import sectors, universe
from tickerloom.sources.messages import (
    captured_messages,
    keyed_text,
    parse_trades,
    rejected_messages,
)

GOOD = {
    "trade_id": "t1", "ticker": "AAPL", "price": 210.5, "quantity": 100, "side": "BUY",
    "trade_type": "round_lot", "bid_price": 210.4, "ask_price": 210.6,
    "timestamp": "2024-01-01T10:07:30.123456+00:00", "exchange": "NYSE", "source": "simulator",
}


def messages(spark, *payloads):
    from datetime import datetime

    rows = [
        (b"AAPL", None if p is None else bytearray(p, "utf8"), "stock_trades", 0, i,
         datetime(2024, 1, 1, 10, 8))
        for i, p in enumerate(payloads)
    ]
    return spark.createDataFrame(rows, MESSAGE_FRAME)


def parsed(spark, *payloads):
    return enrich(parse_trades(messages(spark, *payloads))).collect()


def test_well_formed(spark):
    row = parsed(spark, json.dumps(GOOD))[0]
    assert (row.trade_id, row.price, row.quantity) == ("t1", 210.5, 100)
    assert row.dollar_volume == 21050.0
    assert (row.is_buy, row.buy_volume) == (1, 100)
    assert str(row.event_time) == "2024-01-01 10:07:30.123456"
    assert str(row.kafka_ingest_time) == "2024-01-01 10:08:00"


def test_offset_is_applied(spark):
    row = parsed(spark, json.dumps({**GOOD, "timestamp": "2024-01-01T05:00:00-05:00"}))[0]
    assert str(row.event_time) == "2024-01-01 10:00:00"


def test_bad_payloads_give_null_rows(spark):
    for row in parsed(spark, "partition_test", "[]", "", None):
        assert row.trade_id is None and row.event_time is None and row.dollar_volume is None


def test_fractional_quantity_is_null_and_the_rest_kept(spark):
    for payload in ('"quantity": 1.5', '"quantity": 2.0'):
        text = json.dumps(GOOD).replace('"quantity": 100', payload)
        row = parsed(spark, text)[0]
        assert row.quantity is None and row.price == 210.5


def test_null_side(spark):
    row = parsed(spark, json.dumps({**GOOD, "side": None}))[0]
    assert row.is_buy is None and row.buy_volume is None


def test_other_sides_are_not_buys(spark):
    row = parsed(spark, json.dumps({**GOOD, "side": "UNKNOWN"}))[0]
    assert (row.is_buy, row.buy_volume) == (0, 0)


def test_garbage_time_is_null(spark):
    assert parsed(spark, json.dumps({**GOOD, "timestamp": "garbage"}))[0].event_time is None


def test_rejected_messages(spark):
    frame = messages(spark, json.dumps(GOOD), "partition_test", '{"ticker": "AAPL"}')
    assert [r.offset for r in rejected_messages(frame).orderBy("offset").collect()] == [1, 2]


def test_keys_and_text(spark):
    frame = messages(spark, "x")
    row = keyed_text(frame).collect()[0]
    assert (row.message_key, row.payload) == ("AAPL", "x")
    assert parse_trades(frame, keep_key=True).collect()[0].message_key == "AAPL"


def test_bronze_columns(spark):
    log = bronze(enrich(parse_trades(messages(spark, json.dumps(GOOD)))))
    assert log.columns == BRONZE_COLUMNS


def test_captured_messages_stream(spark, tmp_path):
    messages(spark, json.dumps(GOOD)).write.parquet(str(tmp_path / "m"))
    stream = captured_messages(spark, str(tmp_path / "m"))
    assert stream.isStreaming
    query = (
        parse_trades(stream).writeStream.format("memory").queryName("captured")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.table("captured").count() == 1


def vendor(spark, *bodies):
    return normalize_vendor_batch(messages(spark, *map(json.dumps, bodies)))


def test_vendor_batch(spark):
    rows = vendor(spark, {"type": "trade", "data": [
        {"s": "AAPL", "p": 210.123, "v": 99, "t": 1704103650123},
        {"s": "MSFT", "p": 470.0, "v": 100, "t": 1704103650000},
        {"s": "ZZZZ", "p": 1.0, "v": 1, "t": 1704103650000},
    ]}).orderBy("ticker").collect()
    assert [(r.ticker, r.price, r.quantity, r.trade_type) for r in rows] == [
        ("AAPL", 210.12, 99, "odd_lot"), ("MSFT", 470.0, 100, "round_lot"),
    ]
    first = rows[0]
    assert str(first.event_time) == "2024-01-01 10:07:30.123000"
    assert first.timestamp == "2024-01-01T10:07:30.123000+00:00"
    assert (first.side, first.exchange, first.source) == ("UNKNOWN", "FINNHUB", "finnhub_live")
    assert first.bid_price is None and first.ask_price is None


def test_vendor_ignores_other_messages(spark):
    assert vendor(spark, {"type": "ping"}, {"type": "trade"},
                  {"type": "trade", "data": []}).count() == 0


def test_vendor_defaults_for_absent_fields(spark):
    row = vendor(spark, {"type": "trade", "data": [{"s": "AAPL"}]}).collect()[0]
    assert (row.price, row.quantity, row.trade_type) == (0.0, 0, "odd_lot")
    assert str(row.event_time) == "1970-01-01 00:00:00"


def test_vendor_ids_are_stable_and_distinct(spark):
    body = {"type": "trade", "data": [{"s": "AAPL", "p": 1.0, "v": 1, "t": 0}] * 3}
    first = {r.trade_id for r in vendor(spark, body, body).collect()}
    again = {r.trade_id for r in vendor(spark, body, body).collect()}
    assert len(first) == 6 and first == again


def test_vendor_fractional_volume(spark):
    row = vendor(spark, {"type": "trade", "data": [
        {"s": "AAPL", "p": 1.0, "v": 100.5, "t": 0}]}).collect()[0]
    assert row.quantity is None and row.trade_type == "round_lot"


def test_session_edges(spark):
    cases = {
        "2024-01-02 14:29:59.999999": False,  # Tuesday, 09:29:59.999999 in New York
        "2024-01-02 14:30:00": True,
        "2024-01-02 21:00:00": True,
        "2024-01-02 21:00:00.000001": False,
        "2024-01-06 15:00:00": False,  # Saturday
        "2024-07-02 13:30:00": True,  # summer time
        "2024-07-02 20:00:01": False,
    }
    df = spark.createDataFrame([(t,) for t in cases], "t string").select(
        "t", F.col("t").cast("timestamp").alias("event_time")
    )
    assert {r.t: r.in_session for r in in_session(df).collect()} == cases


def test_sectors(spark):
    dim = sectors(spark)
    assert dim.count() == 25 and universe(spark).count() == 25
    assert dim.filter("ticker = 'AMZN'").collect()[0].sector == "Other"
    rows = spark.createDataFrame([("AAPL",), ("ZZZZ",)], "ticker string")
    got = {r.ticker: r.sector for r in with_sector(rows, dim).collect()}
    assert got == {"AAPL": "Technology", "ZZZZ": None}
