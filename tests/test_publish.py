"""One pass per table, a gate from what the write observed, tables shown in one step."""

import pytest
from pyspark.sql import functions as F

from tickerloom.fixed_values import UNIVERSE
from tickerloom.operators.quality import checks_from_metrics, quality_checks, write_metrics
from tickerloom.plans import publish as publishing
from tickerloom.plans.publish import GateClosed, LoadIncomplete, publish, stage
from tickerloom.sinks import storage, warehouse
from tickerloom.sinks.warehouse import AtomicFilesSink, StagedFilesSink
from tickerloom.sources.tables import TableMissing

ALL = [{"ticker": t} for t in UNIVERSE]
BAD = [{}, {"vwap": None}, {"vwap": 0.5, "total_volume": 0}, {"buy_pressure": "101.00"}, {"buy_pressure": None},
       {"low_price": 9.0, "high_price": 8.0}, {"window_end": "2024-01-01 10:02:00"}, {"window_start": None}]


@pytest.mark.parametrize("short,long_", [(ALL, ALL), (BAD, ALL), (ALL, BAD), (BAD, BAD), ([], ALL), (ALL, []), ([], [])])
def test_observed_checks_equal_those_of_a_scan(spark, tmp_path, make_bars, short, long_):
    short, long_ = make_bars(*short), make_bars(*long_)
    seen = [stage(frame, str(tmp_path / name), write_metrics(is_short)).metrics
            for name, frame, is_short in (("s", short, True), ("l", long_, False))]
    assert checks_from_metrics(spark, *seen).collect() == quality_checks(short, long_).collect()


def counted(bars, spark):
    """Bars whose rows are counted each time they are computed."""
    total = spark.sparkContext.accumulator(0)

    def passed(batches):
        for batch in batches:
            total.add(batch.num_rows)
            yield batch

    return bars.mapInArrow(passed, bars.schema), total


@pytest.mark.parametrize("sink", [StagedFilesSink, AtomicFilesSink])
def test_each_table_is_computed_once(spark, tmp_path, make_bars, sink):
    short, first = counted(make_bars(*ALL, *ALL), spark)
    long_, second = counted(make_bars(*ALL), spark)
    assert publish(short, long_, sink(str(tmp_path))) == {"VWAP_1MIN": "loaded", "VWAP_5MIN": "loaded"}
    assert (first.value, second.value) == (50, 25)
    short, first = counted(make_bars(*ALL, {"vwap": None}), spark)
    with pytest.raises(GateClosed):
        publish(short, long_, sink(str(tmp_path)))
    assert first.value == 26


def test_all_tables_change_in_one_step(spark, tmp_path, make_bars, monkeypatch):
    sink = AtomicFilesSink(str(tmp_path))
    with pytest.raises(TableMissing):
        sink.count(spark, "VWAP_1MIN")
    publish(make_bars(*ALL), make_bars(*ALL), sink)
    old = sink.read(spark, "VWAP_1MIN")

    def state():
        return sink.count(spark, "VWAP_1MIN"), sink.count(spark, "VWAP_5MIN")

    def broken(*arguments, **options):
        raise OSError("lost")

    more = make_bars(*ALL, {"ticker": "AAPL"})
    # Cut short in the first write, in the second one, and at the pointer.
    for patched, name, step in ((publishing, "warehouse_rows", 0), (publishing, "warehouse_rows", 1), (warehouse, "put_text", 0)):
        calls = []
        original = getattr(patched, name)

        def once(*arguments, original=original, calls=calls, step=step):
            calls.append(1)
            return broken() if len(calls) > step else original(*arguments)

        with monkeypatch.context() as patch:
            patch.setattr(patched, name, once)
            with pytest.raises(OSError):
                publish(more, more, sink)
        assert state() == (25, 25) and old.count() == 25
    for table in ("VWAP_1MIN", "VWAP_5MIN"):        # nothing is left of broken loads
        assert len(storage.names(spark, f"{tmp_path}/versions/{table}")) == 1
    assert publish(more, make_bars(*ALL), sink) == {"VWAP_1MIN": "loaded", "VWAP_5MIN": "loaded"}
    assert state() == (26, 25) and old.count() == 25        # a reader of the version before
    assert publish(make_bars(), more, sink) == {"VWAP_1MIN": "skipped", "VWAP_5MIN": "loaded"}
    assert state() == (26, 26)
    publish(more, more, sink)
    assert len(storage.names(spark, f"{tmp_path}/versions/VWAP_5MIN")) == 2


def test_a_closed_gate_leaves_the_target(spark, tmp_path, make_bars):
    sink = AtomicFilesSink(str(tmp_path))
    publish(make_bars(*ALL), make_bars(*ALL), sink)
    shown = sink.shown(spark)
    with pytest.raises(GateClosed, match="check 2"):
        publish(make_bars(*ALL, {"vwap": 1e6}), make_bars(*ALL), sink)
    with pytest.raises(GateClosed, match="check 5"):
        publish(make_bars(*ALL), make_bars(*ALL[1:]), sink)
    assert sink.shown(spark) == shown and sink.count(spark, "VWAP_1MIN") == 25
    assert len(storage.names(spark, f"{tmp_path}/versions/VWAP_1MIN")) == 1


def test_files_that_do_not_hold_the_rows_sent_are_not_shown(spark, tmp_path, make_bars, monkeypatch):
    sink = AtomicFilesSink(str(tmp_path))
    publish(make_bars(*ALL), make_bars(*ALL), sink)

    def short_of_one(bars, path, metrics):
        staged = stage(bars, path, metrics)
        return publishing.Staged(staged.path, staged.rows + 1, staged.metrics)

    monkeypatch.setattr(publishing, "stage", short_of_one)
    with pytest.raises(LoadIncomplete, match="sent 26 rows, found 25"):
        publish(make_bars(*ALL), make_bars(*ALL), sink)
    assert sink.count(spark, "VWAP_1MIN") == 25


def test_one_table_on_its_own(spark, tmp_path):
    sink = AtomicFilesSink(str(tmp_path))
    for rows in (3, 5):
        sink.load(spark.range(rows).withColumn("x", F.lit(1)), "T")
        assert sink.count(spark, "T") == rows
