"""A comparison that follows batches, long bars from short ones, late rows kept aside."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickerloom.fixed_values import BAR_COLUMNS
from tickerloom.functions.measures import window_end, window_start
from tickerloom.operators.bars import PART_COLUMNS, mergeable_bars, rollup_bars, windowed_vwap
from tickerloom.operators.reconcile import reconcile
from tickerloom.plans.incremental import reconcile_changes, reconciled
from tickerloom.sinks import storage, versioned
from tickerloom.sinks.storage import get_text, names
from tickerloom.sinks.versioned import as_of, write_batch
from tickerloom.streaming import late
from tickerloom.streaming.queries import AVAILABLE_NOW, finish, start_fan_out, write_stream

START = datetime(2024, 1, 1, 23, 50)


def rows_at(prefix, minutes, ticker="AAPL", price=100.0, quantity=10):
    return [(f"{prefix}-{m}", ticker, price + m, quantity, "BUY", str(START + timedelta(minutes=m)))
            for m in minutes]


@pytest.fixture
def followed(spark, tmp_path, make_trades):
    """Delivers batches of trades and bars, brings the comparison up to date and checks it."""
    paths = [str(tmp_path / name) for name in ("trades", "bars", "state")]

    def full():
        return reconcile(as_of(spark, paths[0]), as_of(spark, paths[1]), "1 minute", "full_outer")

    def settled(frame):
        return sorted(str(sorted(r.asDict().items())) for r in frame.collect())

    def deliver(batch, rows, bars_of=None):
        trades = make_trades(rows).drop("trade_type", "exchange")
        write_batch(trades, batch, paths[0])
        shown = trades if bars_of is None else make_trades(bars_of)
        write_batch(windowed_vwap(shown, "1 minute"), batch, paths[1])

    def follow():
        run = reconcile_changes(spark, *paths)
        assert settled(reconciled(spark, paths[2])) == settled(full())
        return run

    deliver.paths, deliver.follow = paths, follow
    return deliver


def test_appends_and_replays_equal_a_full_pass(followed):
    followed(0, rows_at("a", range(5)))
    followed(1, rows_at("b", range(5, 9), "MSFT") + rows_at("c", [3], "MSFT"))
    run = followed.follow()
    assert run.number == 0 and run.changed == {"trades": [0, 1], "bars": [0, 1]}
    # An append: windows over midnight, a re-delivery, and a bar that differs.
    followed(2, rows_at("d", range(9, 14)) + rows_at("a", [1]), rows_at("x", [9], price=7.0))
    run = followed.follow()
    assert run.changed["trades"] == [2] and run.read["trades"] == [0, 2]
    # A batch that touches no window of earlier ones.
    followed(3, rows_at("e", [30, 31], None))
    assert followed.follow().read == {"trades": [3], "bars": [3]}
    # A replay with other rows, then one without any.
    followed(1, rows_at("f", [100], "MSFT"))
    run = followed.follow()
    assert run.changed["trades"] == [1] and 2 not in run.read["trades"]
    followed(2, [])
    followed.follow()
    assert followed.follow().changed == {"trades": [], "bars": []}


def test_random_deliveries(followed):
    rng = random.Random(7)
    for step in range(6):
        for batch in rng.sample(range(4), 2):
            rows = [r for n in range(rng.randrange(4)) for r in rows_at(
                f"{step}{batch}{n}", rng.sample(range(12), 3), rng.choice(["AAPL", "MSFT", None]))]
            followed(batch, rows, rows[: rng.randrange(len(rows) + 1)] if rng.random() < 0.5 else None)
        followed.follow()


def test_a_run_cut_short_is_made_up_for(followed, monkeypatch):
    from tickerloom.plans import incremental

    followed(0, rows_at("a", range(3)))
    followed.follow()
    followed(1, rows_at("b", range(2, 5)))
    for name in ("_replace_windows", "write_batch"):
        with monkeypatch.context() as patch:
            where = incremental if name == "_replace_windows" else incremental.versioned
            patch.setattr(where, name, lambda *a, **b: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError):
                followed.follow()
    assert followed.follow().changed["trades"] == [1]


def test_only_the_batches_of_touched_windows_are_scanned(spark, followed):
    for batch in range(6):
        followed(batch, rows_at(f"b{batch}", range(10 * batch, 10 * batch + 5)))
    followed.follow()
    followed(6, rows_at("again", [21]))
    run = followed.follow()
    assert run.read == {"trades": [2, 6], "bars": [2, 6]}
    scanned = versioned.batches(spark, followed.paths[0], run.read["trades"])
    plan = scanned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [batch_id" in plan or "PartitionFilters: [cast(batch_id" in plan
    assert len({f.split("batch_id=")[1].split("/")[0] for f in as_of(spark, followed.paths[0]).inputFiles()}) == 7
    metrics = scanned.select(F.input_file_name().alias("f")).distinct().collect()
    assert {m.f.split("batch_id=")[1].split("/")[0] for m in metrics} == {"2", "6"}


# --- long bars from short ones ---


def closely(a, b, keys=("window_start", "ticker")):
    """Equal rows, with sums of doubles equal to 12 digits."""
    def rows(frame):
        return {tuple(str(r[k]) for k in keys): [
            f"{v:.12g}" if isinstance(v, float) else v for v in r] for r in frame.select(*BAR_COLUMNS).collect()}
    return rows(a) == rows(b)


@pytest.mark.parametrize("long_", ["5 minutes", "1 hour", "1 day"])
def test_rolled_up_bars_equal_bars_of_trades(spark, make_trades, long_):
    rng = random.Random(3)
    rows = [(str(n), rng.choice(["A", "B", None]), rng.choice([None, rng.uniform(1, 500)]), rng.randrange(0, 50),
             rng.choice(["BUY", "SELL", "UNKNOWN"]), str(START + timedelta(seconds=rng.randrange(20_000))))
            for n in range(400)]
    trades = make_trades(rows).withColumn("bid_price", F.when(F.col("price") > 100, F.col("bid_price")))
    short = mergeable_bars(trades, "1 minute")
    assert short.columns == [*BAR_COLUMNS, *PART_COLUMNS]
    assert closely(short, windowed_vwap(trades, "1 minute"))
    assert closely(rollup_bars(short, long_), windowed_vwap(trades, long_))
    assert closely(rollup_bars(rollup_bars(short, "5 minutes"), "1 day"), windowed_vwap(trades, "1 day"))
    assert rollup_bars(short.limit(0), long_).collect() == []


def messages(spark, folder, files):
    """Message files, delivered one after the other."""
    from tests.test_streams import write_messages

    for number, trades in enumerate(files):
        write_messages(spark, folder, number, trades)


def test_the_fan_out_reads_the_topic_twice(spark, tmp_path):
    from tests.test_streams import NOW, trade
    from tickerloom.sources.messages import captured_messages

    folder = str(tmp_path / "in")
    sent = [trade(f"t{m}", 100.0 + m, 10, NOW + timedelta(minutes=m)) for m in range(-3, 13)]
    messages(spark, folder, [sent[:6], sent[6:]])
    queries = start_fan_out(captured_messages(spark, folder, max_files_per_trigger=1), str(tmp_path / "out"),
                            str(tmp_path / "state"), trigger=AVAILABLE_NOW, roll_up=True)
    finish(queries)
    read_topic = [name for name, query in queries.items() if any(
        "/in" in source["description"] for p in query.recentProgress for source in p["sources"])]
    assert sorted(read_topic) == ["raw_trades", "vwap_1min"]
    long_ = spark.read.parquet(str(tmp_path / "out" / "vwap_5min"))
    short = spark.read.parquet(str(tmp_path / "out" / "vwap_1min"))
    assert {r.window_start.minute: r.trade_count for r in long_.collect()} == {0: 1, 5: 5, 10: 5}
    assert short.filter("window_start >= '2024-01-01 10:15:00'").count() > 0
    assert set(long_.columns) == {*BAR_COLUMNS, "window_date"} and set(PART_COLUMNS) < set(short.columns)


# --- late rows ---


def late_stream(spark, tmp_path, make_trades, files):
    """A stream with one file per micro-batch."""
    import os

    for number, rows in enumerate(files):
        path = str(tmp_path / "in" / f"{number}")
        make_trades(rows).coalesce(1).write.parquet(path)
        for name in os.listdir(path):
            os.utime(f"{path}/{name}", (1_700_000_000 + number,) * 2)
    schema = make_trades([]).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option(
        "recursiveFileLookup", True).parquet(str(tmp_path / "in"))


def test_every_row_is_accepted_or_kept_aside(spark, tmp_path, make_trades):
    files = [rows_at("a", range(5)), rows_at("b", [10, 3, 4]), rows_at("c", [2, 9, 10, 11]) + [("n", "AAPL", 1.0, 1, "BUY", None)],
             rows_at("d", [0, 10, 11, 30])]
    stream = late_stream(spark, tmp_path, make_trades, files)
    path, state = str(tmp_path / "rows"), str(tmp_path / "state")
    finish({"late": late.split_late(stream, path, state, "1 minute", "10 seconds")})
    # By hand: windows whose end is not after the newest earlier event less ten seconds.
    want, newest = set(), None
    for rows in files:
        for r in rows:
            at = None if r[5] is None else datetime.fromisoformat(r[5])
            if at and newest and at + timedelta(minutes=1) <= newest - timedelta(seconds=10):
                want.add(r[0])
        newest = max([datetime.fromisoformat(r[5]) for r in rows if r[5]] + ([newest] if newest else []))
    assert {r.trade_id for r in late.late_rows(spark, path).collect()} == want
    assert {"c-2", "d-0"} <= want and "b-10" not in want
    assert late.accepted_rows(spark, path).count() + len(want) == sum(map(len, files))
    # The bars of the accepted rows are those that a stream of them closes: none is dropped again.
    accepted = late.accepted_rows(spark, path).filter("event_time IS NOT NULL")
    closed = windowed_vwap(accepted, "1 minute")
    assert closed.agg(F.sum("trade_count")).first()[0] == accepted.count()


def test_a_repeated_micro_batch_gets_its_own_watermark(spark, tmp_path, make_trades):
    path = str(tmp_path / "t")
    assert late._watermarks(spark, path, 0) == (None, None)
    late.put_text(spark, late._mark_path(path), '{"batch": 4, "earlier": 5, "before": 10, "after": 20}')
    assert [late._watermarks(spark, path, n) for n in (4, 5)] == [(5, 10), (10, 20)]
    stream = late_stream(spark, tmp_path, make_trades, [rows_at("a", [0, 9]), rows_at("b", [1, 12])])
    for attempt in ("one", "two"):      # the second run repeats both micro-batches
        if attempt == "one":
            storage.delete(spark, late._mark_path(path))
        else:
            mark = json.loads(get_text(spark, late._mark_path(path)))
            late.put_text(spark, late._mark_path(path), json.dumps({**mark, "batch": 0, "before": None, "earlier": None}))
        finish({"late": late.split_late(stream, path, str(tmp_path / attempt), "1 minute")})
        assert {r.trade_id for r in late.late_rows(spark, path).collect()} == {"b-1"}
        assert late.accepted_rows(spark, path).count() == 3


def test_counts_equal_what_the_engine_dropped(spark, tmp_path, make_trades):
    """The engine lets rows through that come in the micro-batch that emits their window."""
    files = [rows_at("a", range(3)), rows_at("b", [0, 20]), rows_at("c", [0, 1, 2, 21]), rows_at("d", [1, 2, 40]),
             rows_at("e", [2, 20, 41])]
    stream = late_stream(spark, tmp_path, make_trades, files)
    finish({"bars": write_stream(windowed_vwap(stream, "1 minute", "10 seconds"), str(tmp_path / "bars"),
                                 str(tmp_path / "bars-state"), trigger=AVAILABLE_NOW)})
    path = str(tmp_path / "rows")
    finish({"late": late.split_late(stream, path, str(tmp_path / "state"), "1 minute", "10 seconds", as_engine=True)})
    counted = {(r.window_start, r.trade_count) for r in spark.read.parquet(str(tmp_path / "bars")).collect()}
    closed = F.lit(START + timedelta(minutes=41) - timedelta(seconds=10))
    rows = as_of(spark, path).withColumn("w", window_start(F.col("event_time"), "1 minute"))
    accepted = rows.filter("NOT late").filter(window_end(F.col("w"), "1 minute") <= closed).groupBy("w").count()
    assert {tuple(r) for r in accepted.collect()} == counted
    assert {r.trade_id for r in rows.filter("late").collect()} == {"c-0", "d-1", "d-2", "e-2"}
    assert names(spark, path) == ["batch_group=0"]
