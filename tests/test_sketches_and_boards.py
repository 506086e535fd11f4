"""Days answered from stored sketches; boards that follow a stream."""

import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickerloom.operators.bars import windowed_vwap
from tickerloom.operators.market import vwap_board
from tickerloom.operators.sketches import day_sketches, distinct_over, error_bound, store_day_sketches
from tickerloom.streaming.boards import keep_board, read_board
from tickerloom.streaming.queries import AVAILABLE_NOW, finish

START = datetime(2024, 1, 1, 10)


@pytest.fixture(scope="module")
def many_days(spark):
    """Six days of 20,000 rows whose ids overlap from day to day; one ticker has half of them."""
    return spark.range(120_000).select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 6 * 86400).alias("event_time"),
        F.when(F.col("id") % 2 == 0, "HOT").otherwise(F.concat(F.lit("T"), F.col("id") % 300)).alias("ticker"),
        F.when(F.col("id") % 10 != 3, (F.col("id") % 50_000).cast("string")).alias("trade_id"))


def exact(frame, since, until):
    day = F.to_date("event_time")
    return frame.filter(day.between(F.lit(since), F.lit(until))).agg(
        F.count("*").alias("rows"), F.count_distinct("ticker").alias("t"), F.count_distinct("trade_id").alias("i")).first()


def test_any_range_of_days_from_sketches_alone(spark, tmp_path, many_days):
    path = str(tmp_path / "days")
    store_day_sketches(day_sketches(many_days), path)
    stored = spark.read.parquet(path)
    assert stored.count() == 6
    for first in range(6):
        for last in range(first, 6):
            since, until = (date(2024, 1, 1) + timedelta(days=n) for n in (first, last))
            got, want = distinct_over(stored, since, until).first(), exact(many_days, since, until)
            assert got.rows == want["rows"]
            assert abs(got.distinct_ticker - want.t) <= 1 + error_bound() * want.t
            assert abs(got.distinct_trade_id - want.i) <= 1 + error_bound() * want.i
    assert distinct_over(stored, since=date(2025, 1, 1)).first() == (0, 0, 0)
    assert distinct_over(stored).first().rows == 120_000


def test_a_day_counted_again_replaces_itself(spark, tmp_path, many_days):
    path = str(tmp_path / "days")
    store_day_sketches(day_sketches(many_days), path)
    before = sorted(map(str, distinct_over(spark.read.parquet(path), by=("event_date",)).collect()))
    again = many_days.filter("event_time < '2024-01-03'")
    store_day_sketches(day_sketches(again), path)
    assert sorted(map(str, distinct_over(spark.read.parquet(path), by=("event_date",)).collect())) == before


def test_a_question_reads_only_its_days(spark, tmp_path, many_days):
    path = str(tmp_path / "days")
    store_day_sketches(day_sketches(many_days), path)
    asked = distinct_over(spark.read.parquet(path), date(2024, 1, 2), date(2024, 1, 3))
    plan = asked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_nulls_and_empty_strings(spark):
    rows = [(START, None, "a"), (START, "", "a"), (START, "", None), (None, "x", "b")]
    frame = spark.createDataFrame(rows, "event_time timestamp, ticker string, trade_id string")
    days = day_sketches(frame)
    assert distinct_over(days, date(2024, 1, 1), date(2024, 1, 1)).first() == (3, 1, 1)
    assert distinct_over(days).first() == (4, 2, 2)
    assert day_sketches(frame.limit(0)).count() == 0 and distinct_over(day_sketches(frame.limit(0))).first() == (0, 0, 0)
    nothing = spark.createDataFrame([(START, None, None)], frame.schema)
    assert distinct_over(day_sketches(nothing)).first() == (1, 0, 0)


def arrive(frame, folder, number):
    path = f"{folder}/{number}"
    frame.coalesce(1).write.parquet(path)
    for name in os.listdir(path):
        os.utime(f"{path}/{name}", (1_700_000_000 + number,) * 2)


def shown(frame):
    return sorted(map(str, frame.collect()))


def test_the_board_equals_a_scan_after_every_file(spark, tmp_path, make_bars):
    folder, path, state = (str(tmp_path / x) for x in ("in", "board", "state"))

    def bar(minute, ticker, volume):
        start = START + timedelta(minutes=minute)
        return {"ticker": ticker, "total_volume": volume, "window_start": str(start),
                "window_end": str(start + timedelta(minutes=1))}

    files = [
        [bar(0, "A", 5), bar(0, "B", 5), bar(0, "C", 9), bar(0, None, 7)],
        [bar(0, "D", 8), bar(0, "E", None)],                    # the same window goes on
        [bar(1, "A", 1)],                                       # a new one, with a single bar
        [bar(0, "F", 99), bar(1, "B", 3)],                      # an older one with more volume
        [bar(2, x, n) for n, x in enumerate("ABCDEFG")],
    ]
    assert read_board(spark, path) is None
    so_far = None
    for number, rows in enumerate(files):
        frame = make_bars(*rows)
        arrive(frame, folder, number)
        so_far = frame if so_far is None else so_far.unionAll(frame)
        live = spark.readStream.schema(frame.schema).option("recursiveFileLookup", True).parquet(folder)
        finish({"board": keep_board(live, path, state, n=3, trigger=AVAILABLE_NOW)})
        want = vwap_board(so_far, 3)
        assert shown(read_board(spark, path).select(*want.columns)) == shown(want)
    assert len([x for x in os.listdir(path) if x.startswith("board-")]) == 2     # state stays the same size


def test_a_repeated_micro_batch_changes_nothing(spark, tmp_path, make_bars):
    folder, path = str(tmp_path / "in"), str(tmp_path / "board")
    frame = make_bars({"ticker": "A"}, {"ticker": "B", "total_volume": 20}, {"ticker": "C", "total_volume": 1})
    arrive(frame, folder, 0)
    live = spark.readStream.schema(frame.schema).option("recursiveFileLookup", True).parquet(folder)
    for attempt in ("first", "again"):      # a fresh checkpoint delivers the same bars again
        finish({"board": keep_board(live, path, str(tmp_path / attempt), n=2, trigger=AVAILABLE_NOW)})
    assert shown(read_board(spark, path).select("ticker", "total_volume")) == shown(
        vwap_board(frame, 2).select("ticker", "total_volume"))


def test_growing_bars_replace_their_older_rows(spark, tmp_path, make_trades):
    folder, path, state = (str(tmp_path / x) for x in ("in", "board", "state"))
    so_far = None
    for number in range(3):
        rows = [(f"{number}-{n}", ticker, 10.0, lots * (number + 1), "BUY", str(START + timedelta(seconds=n)))
                for n, (ticker, lots) in enumerate([("A", 5), ("B", 3 + 4 * number), ("C", 1)])]
        frame = make_trades(rows)
        arrive(frame, folder, number)
        so_far = frame if so_far is None else so_far.unionAll(frame)
        live = spark.readStream.schema(frame.schema).option("recursiveFileLookup", True).parquet(folder)
        bars = windowed_vwap(live, "1 minute", "10 seconds")
        finish({"board": keep_board(bars, path, state, n=2, trigger=AVAILABLE_NOW, output_mode="update")})
        want = vwap_board(windowed_vwap(so_far, "1 minute"), 2)
        assert shown(read_board(spark, path).select(*want.columns)) == shown(want)
