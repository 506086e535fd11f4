import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickerloom.fixed_values import BAR_COLUMNS, BOUND_COLUMNS, BRONZE_COLUMNS, MESSAGE_FRAME
from tickerloom.operators.bars import windowed_vwap
from tickerloom.operators.quality import lateness_audit
from tickerloom.operators.trades import enrich
from tickerloom.session import recommended_conf
from tickerloom.sinks.versioned import as_of, history, stream_batches
from tickerloom.sinks.warehouse import StagedFilesSink
from tickerloom.sources.messages import captured_messages, parse_trades, topic_messages
from tickerloom.sources.tables import read_tables, read_trade_log
from tickerloom.functions.measures import utc_date
from tickerloom.streaming.queries import (
    AVAILABLE_NOW,
    await_any,
    compact_days,
    console_preview,
    finish,
    rows_dropped_late,
    start_fan_out,
    stop_all,
    write_stream,
)
from tickerloom.streaming.scheduled import run_once
from tickerloom.operators.dedup import dedup_stream

NOW = datetime(2024, 1, 1, 10, 7, 30)


def trade(name, price, quantity, at, ticker="AAPL"):
    return {
        "trade_id": name, "ticker": ticker, "price": price, "quantity": quantity, "side": "BUY",
        "trade_type": "round_lot", "bid_price": price - 0.01, "ask_price": price + 0.01,
        "timestamp": at.isoformat() + "+00:00", "exchange": "NYSE", "source": "late_data_demo",
    }


def write_messages(spark, folder, number, trades):
    """One more message file, later than those before it."""
    rows = [(b"AAPL", bytearray(json.dumps(t), "utf8"), "stock_trades", 0, number * 1000 + i, NOW)
            for i, t in enumerate(trades)]
    staging = f"{folder}-{number}"
    spark.createDataFrame(rows, MESSAGE_FRAME).coalesce(1).write.parquet(staging)
    os.makedirs(folder, exist_ok=True)
    part = next(f for f in os.listdir(staging) if f.endswith(".parquet"))
    target = f"{folder}/{number:03d}.parquet"
    with open(f"{staging}/{part}", "rb") as source, open(target, "wb") as out:
        out.write(source.read())
    os.utime(target, (1_700_000_000 + number, 1_700_000_000 + number))


def half_seconds(prefix, n, price, quantity):
    return [trade(f"{prefix}-{i}", price, quantity, NOW + timedelta(seconds=i / 2))
            for i in range(n)]


def three_phases(spark, folder, closer=True):
    phases = [
        half_seconds("ontime", 20, 210.0, 100),
        half_seconds("late-within", 5, 211.0, 500),
        [trade(f"late-beyond-{i}", 999.99, 9999, NOW - timedelta(seconds=60)) for i in range(5)],
    ]
    if closer:
        phases.append([trade("closer", 210.0, 1, NOW + timedelta(seconds=900))])
    for number, rows in enumerate(phases):
        write_messages(spark, folder, number, rows)


def run_fan_out(spark, folder, base):
    messages = captured_messages(spark, folder, max_files_per_trigger=1)
    queries = start_fan_out(messages, f"{base}/tables", f"{base}/state", trigger=AVAILABLE_NOW)
    finish(queries)
    return queries


def table(spark, base, name):
    return spark.read.parquet(f"{base}/tables/{name}")


@pytest.fixture(scope="module")
def late_run(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("late"))
    three_phases(spark, f"{base}/messages")
    return base, run_fan_out(spark, f"{base}/messages", base)


def test_canary_is_kept_out_of_the_closed_short_window(spark, late_run):
    rows = table(spark, late_run[0], "vwap_1min").collect()
    assert [(r.window_start.minute, round(r.vwap, 3), r.trade_count) for r in rows] == [
        (7, 210.556, 25)]


def test_canary_stays_in_the_open_long_window(spark, late_run):
    rows = table(spark, late_run[0], "vwap_5min").collect()
    assert [(r.window_start.minute, round(r.vwap, 3), r.trade_count) for r in rows] == [
        (5, 934.801, 30)]


def test_bronze_keeps_everything(spark, late_run):
    log = table(spark, late_run[0], "raw_trades")
    assert log.count() == 31
    assert set(log.columns) == {*BRONZE_COLUMNS, "event_date"}


def test_the_log_is_read_by_date(spark, late_run):
    path = f"{late_run[0]}/tables/raw_trades"
    assert read_trade_log(spark, path).columns == BRONZE_COLUMNS
    some = read_trade_log(spark, path, NOW, NOW + timedelta(seconds=2))
    assert some.count() == 8  # four on time, four late, half a second apart
    text = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in text
    assert read_trade_log(spark, path, NOW + timedelta(days=1)).count() == 0


def test_bounds_of_any_zone_and_logs_cut_in_another_zone(spark, tmp_path):
    from datetime import timezone

    rows = [(datetime(2024, 1, 1, 16, 30),), (datetime(2024, 1, 2, 3, 0),)]
    log = spark.createDataFrame(rows, "event_time timestamp")
    utc, york = str(tmp_path / "utc"), str(tmp_path / "york")
    log.withColumn("event_date", utc_date(F.col("event_time"))).write.partitionBy("event_date").parquet(utc)
    log.withColumn("event_date", F.to_date(F.from_utc_timestamp("event_time", "America/New_York"))
                   ).write.partitionBy("event_date").parquet(york)
    start = datetime(2024, 1, 2, 1, 0, tzinfo=timezone(timedelta(hours=9)))     # 16:00 UTC the day before
    assert read_trade_log(spark, utc, start).count() == 2
    assert read_trade_log(spark, york, datetime(2024, 1, 2), datetime(2024, 1, 3)).count() == 1
    assert read_trade_log(spark, york, datetime(2024, 1, 1), datetime(2024, 1, 3)).count() == 2


def test_compaction_keeps_rows_and_leaves_few_files(spark, late_run, tmp_path):
    source, target = f"{late_run[0]}/tables/raw_trades", str(tmp_path / "compact")
    for _ in range(2):      # repeated, it replaces what it wrote
        compact_days(spark, source, target, NOW.date() + timedelta(days=1), "event_date")
    small, whole = spark.read.parquet(target), spark.read.parquet(source)
    assert small.count() == whole.count() == 31
    assert small.select(*BRONZE_COLUMNS).exceptAll(whole.select(*BRONZE_COLUMNS)).count() == 0
    assert len(small.inputFiles()) < len(whole.inputFiles()) and len(small.inputFiles()) <= 2


def test_the_topic_is_read_three_times(spark, late_run):
    _, queries = late_run
    read = {name: sum(p["numInputRows"] for p in q.recentProgress) for name, q in queries.items()}
    assert read["raw_trades"] == read["vwap_1min"] == read["vwap_5min"] == 31
    assert read["anomaly_alerts"] == 1      # the one bar that was written


def test_four_tables_and_their_columns(spark, late_run):
    base, queries = late_run
    assert set(queries) == {"raw_trades", "vwap_1min", "vwap_5min", "anomaly_alerts"}
    assert table(spark, base, "vwap_1min").columns == [*BAR_COLUMNS, "window_date"]
    assert table(spark, base, "anomaly_alerts").columns == [*BOUND_COLUMNS, "window_date"]
    assert table(spark, base, "anomaly_alerts").count() == 1
    assert rows_dropped_late(queries["vwap_1min"]) > 0
    assert rows_dropped_late(queries["vwap_5min"]) == 0


def test_lateness_audit_of_the_run(spark, late_run):
    base, _ = late_run
    log = table(spark, base, "raw_trades")
    short = lateness_audit(log, table(spark, base, "vwap_1min"), "AAPL")
    assert short.filter("not passed").count() == 0
    long_ = lateness_audit(log, table(spark, base, "vwap_5min"), "AAPL")
    assert [r.check_name for r in long_.filter("not passed").collect()] == [
        "AAPL vwap within limit", "other tickers within limit"]


def test_nothing_is_emitted_without_a_later_event(spark, tmp_path):
    base = str(tmp_path)
    write_messages(spark, f"{base}/messages", 0, half_seconds("ontime", 20, 210.0, 100))
    run_fan_out(spark, f"{base}/messages", base)
    # A table by date has no file, and so no schema of its own, before its first row.
    assert read_tables(spark, {"bars": f"{base}/tables/vwap_1min"}) == {"bars": None}
    assert table(spark, base, "raw_trades").count() == 20


def test_restart_resumes_from_the_checkpoint(spark, tmp_path):
    """Two runs over growing input give the tables of one run over all of it."""
    base, whole = str(tmp_path / "two"), str(tmp_path / "one")
    minutes = [
        [trade(f"{m}-{i}", 100.0 + i, 10, NOW + timedelta(minutes=m, seconds=i)) for i in range(9)]
        for m in range(6)
    ]
    for number, rows in enumerate(minutes):
        write_messages(spark, f"{whole}/messages", number, rows)
        write_messages(spark, f"{base}/messages", number, rows)
        if number == 2:
            run_fan_out(spark, f"{base}/messages", base)
            assert table(spark, base, "raw_trades").count() == 27
    run_fan_out(spark, f"{base}/messages", base)
    run_fan_out(spark, f"{whole}/messages", whole)
    for name in ("raw_trades", "vwap_1min", "vwap_5min", "anomaly_alerts"):
        columns = sorted(table(spark, base, name).columns)
        a, b = (table(spark, where, name).select(*columns) for where in (base, whole))
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert table(spark, base, "raw_trades").count() == 54


def test_stream_equals_batch_on_closed_windows(spark, tmp_path):
    folder = f"{tmp_path}/messages"
    for m in range(5):
        write_messages(spark, folder, m, [
            trade(f"{m}-{i}", 100.0 + i * m, 1 + i, NOW + timedelta(minutes=m, seconds=3 * i),
                  ticker="AB"[i % 2]) for i in range(15)
        ])
    messages = captured_messages(spark, folder, max_files_per_trigger=2)
    live = windowed_vwap(enrich(parse_trades(messages)), "1 minute", "10 seconds")
    out = f"{tmp_path}/out"
    finish({"bars": write_stream(live, out, f"{tmp_path}/state", trigger=AVAILABLE_NOW)})
    batch = windowed_vwap(enrich(parse_trades(spark.read.parquet(folder))))
    newest = parse_trades(spark.read.parquet(folder)).agg(F.max("event_time")).collect()[0][0]
    closed = batch.filter(F.col("window_end") <= F.lit(newest - timedelta(seconds=10)))
    assert closed.count() == 10
    got = spark.read.parquet(out)
    assert got.exceptAll(closed).count() == 0 and closed.exceptAll(got).count() == 0


def test_replayed_stream_batches_leave_no_duplicates(spark, tmp_path):
    folder, path = f"{tmp_path}/messages", f"{tmp_path}/table"
    for n in range(3):
        write_messages(spark, folder, n, half_seconds(f"b{n}", 10, 1.0, 1))
    for attempt in ("first", "after-crash"):
        trades = parse_trades(captured_messages(spark, folder, max_files_per_trigger=1))
        finish({"t": stream_batches(trades, path, f"{tmp_path}/{attempt}")})
        assert as_of(spark, path, 99).count() == 30
    assert sorted(r.version for r in history(spark, path).collect()) == [0, 1, 2]
    assert as_of(spark, path, 0).count() == 10


def test_stream_dedup(spark, tmp_path):
    folder = f"{tmp_path}/messages"
    rows = half_seconds("a", 10, 1.0, 1)
    write_messages(spark, folder, 0, rows + rows[:4])
    write_messages(spark, folder, 1, rows[:2])
    trades = parse_trades(captured_messages(spark, folder, max_files_per_trigger=1))
    kept = dedup_stream(trades, "1 minute")
    out = f"{tmp_path}/out"
    finish({"d": write_stream(kept, out, f"{tmp_path}/state", trigger=AVAILABLE_NOW)})
    assert spark.read.parquet(out).count() == 10


def test_preview_stop_and_timeout(spark, tmp_path):
    folder = f"{tmp_path}/messages"
    write_messages(spark, folder, 0, half_seconds("a", 3, 1.0, 1))
    trades = parse_trades(captured_messages(spark, folder))
    queries = {"preview": console_preview(trades, rows=2, trigger={"processingTime": "1 second"})}
    queries["preview"].processAllAvailable()
    assert await_any(queries, timeout=0.1) is None
    assert not queries["preview"].isActive
    assert sum(p["numInputRows"] for p in queries["preview"].recentProgress) == 3
    stop_all(queries)


def test_a_failing_query_stops_the_others(spark, tmp_path):
    folder = f"{tmp_path}/messages"
    write_messages(spark, folder, 0, half_seconds("a", 3, 1.0, 1))
    trades = parse_trades(captured_messages(spark, folder))

    def explode(df, n):
        raise RuntimeError("sink is down")

    forever = {"processingTime": "1 second"}
    queries = {
        "good": write_stream(trades, f"{tmp_path}/out", f"{tmp_path}/s1", trigger=forever),
        "bad": trades.writeStream.foreachBatch(explode)
        .option("checkpointLocation", f"{tmp_path}/s2").trigger(**forever).start(),
    }
    with pytest.raises(Exception, match="sink is down"):
        await_any(queries, timeout=60)
    assert not queries["good"].isActive


def test_scheduled_run(spark, tmp_path):
    folder = f"{tmp_path}/messages"
    rows = [trade(f"{t}-{m}", 100.0, 10, NOW + timedelta(minutes=m), ticker=t)
            for t in ("A", "B") for m in (0, 10)]
    write_messages(spark, folder, 0, rows)
    done = run_once(
        captured_messages(spark, folder), f"{tmp_path}/tables", f"{tmp_path}/state",
        StagedFilesSink(f"{tmp_path}/warehouse"), universe=["A", "B"],
    )
    assert done == {"VWAP_1MIN": "loaded", "VWAP_5MIN": "loaded"}
    assert spark.read.parquet(f"{tmp_path}/warehouse/VWAP_5MIN").count() == 2


def test_topic_source_needs_its_connector(spark):
    with pytest.raises(Exception, match="kafka"):
        topic_messages(spark, "localhost:1", max_offsets_per_trigger=10)


def test_recommended_settings_run_a_stream(spark, tmp_path):
    """The RocksDB state store of the recommended settings gives the same bars."""
    conf = {k: v for k, v in recommended_conf(4).items() if "stateStore" in k}
    before = {k: spark.conf.get(k, None) for k in conf}
    three_phases(spark, f"{tmp_path}/messages")
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        run_fan_out(spark, f"{tmp_path}/messages", str(tmp_path))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert [round(r.vwap, 3) for r in table(spark, str(tmp_path), "vwap_1min").collect()] == [210.556]
