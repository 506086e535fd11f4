import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickerloom.operators.bars import windowed_vwap
from tickerloom.operators.dedup import dedup, duplicate_keys, duplicate_stats, replay_audit
from tickerloom.operators.reconcile import reconcile, reconcile_mismatches, reconcile_summary
from tickerloom.plans.reports import reconciliation_report


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "trade_id string")


def test_duplicate_stats(spark):
    row = duplicate_stats(ids(spark, "a", "a", "b", "c", "c", None, None)).collect()[0]
    assert tuple(row) == (7, 3, True, 4, 3)
    row = duplicate_stats(ids(spark, "a", "a", "a", "b", "b")).collect()[0]
    assert (row.duplicate_ids, row.all_exactly_twice) == (2, False)
    row = duplicate_stats(ids(spark, "a", "b")).collect()[0]
    assert (row.duplicate_ids, row.all_exactly_twice, row.removed_rows) == (0, None, 0)
    assert duplicate_stats(ids(spark)).collect()[0].total_rows == 0


def test_duplicate_keys(spark):
    assert [tuple(r) for r in duplicate_keys(ids(spark, "a", "b", "a")).collect()] == [("a", 2)]


def test_dedup_any_and_ordered(spark):
    rows = spark.createDataFrame(
        [("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", 5, None), (None, 1, "q"),
         (None, 0, "r")],
        "trade_id string, seq int, note string",
    )
    assert dedup(rows).count() == 3
    kept = dedup(rows, order_by=["seq"])
    assert kept.columns == rows.columns
    assert {tuple(r) for r in kept.collect()} == {("a", 1, "y"), ("b", 5, None), (None, 0, "r")}


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3), st.integers(0, 3)),
                min_size=1, max_size=30))
def test_ordered_dedup_is_the_minimum_per_key(spark, rows):
    df = spark.createDataFrame(rows, "k int, a int, b int").repartition(3)
    best = {}
    for k, a, b in rows:
        best[k] = min(best.get(k, (9, 9)), (b, a))
    got = {r.k: (r.b, r.a) for r in dedup(df, "k", ["b"]).collect()}
    assert got == best


def test_replay_audit(spark):
    before = ids(spark, "a", "b", "c")
    after = ids(spark, "a", "a", "b", "d")
    row = replay_audit(before, after).collect()[0]
    assert (row.rows_before, row.rows_after, row.new_rows) == (3, 4, 1)
    assert (row.distinct_ids, row.raw_duplicates, row.lost_ids) == (3, 1, 1)
    assert row.exactly_once_on_write is False
    assert replay_audit(before, before).collect()[0].exactly_once_on_write is True


@pytest.fixture
def hundred(make_trades):
    """One trade in each of 100 minutes."""
    return make_trades([
        (str(i), "AAPL", 100.0, 1, "BUY", f"2024-01-01 {10 + i // 60}:{i % 60:02d}:00")
        for i in range(100)
    ])


def shifted(bars, n, factor=1.01):
    """``bars`` with the VWAP of the first ``n`` minutes changed."""
    minute = (F.unix_seconds("window_start") - F.unix_seconds(F.lit("2024-01-01 10:00:00")
              .cast("timestamp"))) / 60
    return bars.withColumn(
        "vwap", F.when(minute < n, F.col("vwap") * factor).otherwise(F.col("vwap"))
    )


@pytest.mark.parametrize("changed, verdict, pct", [
    (0, "PASSED", 100.0), (1, "PASSED", 99.0), (4, "CLOSE", 96.0), (10, "FAILED", 90.0),
])
def test_verdicts(hundred, changed, verdict, pct):
    bars = shifted(windowed_vwap(hundred), changed)
    row = reconcile_summary(reconcile(hundred, bars)).collect()[0]
    assert (row.verdict, row.match_pct, row.mismatched) == (verdict, pct, changed)
    assert row.total_windows == 100 and row.close_matches == 100 - changed


def test_no_windows_fails(hundred):
    row = reconcile_summary(reconcile(hundred, windowed_vwap(hundred).limit(0))).collect()[0]
    assert (row.total_windows, row.match_pct, row.verdict) == (0, 0.0, "FAILED")


def test_exactly_one_hundredth_percent_is_a_mismatch(spark):
    rows = [("2024-01-01 10:00:00", "A", 0.01), ("2024-01-01 10:00:00", "B", 0.0099)]
    compared = spark.createDataFrame(rows, "window_start string, ticker string, vwap_diff_pct double")
    compared = compared.withColumns({
        "window_start": F.col("window_start").cast("timestamp"),
        "batch_vwap": F.lit(1.0), "stream_vwap": F.lit(1.0),
        "count_match": F.lit(True), "seen_in": F.lit("both"),
    })
    assert reconcile_summary(compared).collect()[0].exact_matches == 1
    assert [r.ticker for r in reconcile_mismatches(compared).collect()] == ["A"]


def test_one_sided_windows(hundred):
    bars = windowed_vwap(hundred).filter("minute(window_start) <> 0")
    inner = reconcile_summary(reconcile(hundred, bars)).collect()[0]
    assert (inner.total_windows, inner.verdict) == (98, "PASSED")
    outer = reconcile_summary(reconcile(hundred, bars, how="full_outer")).collect()[0]
    assert (outer.total_windows, outer.batch_only, outer.stream_only) == (100, 2, 0)
    assert outer.verdict == "CLOSE"


def test_batch_side_drops_replayed_trades(hundred):
    replayed = hundred.unionAll(hundred.limit(3))
    row = reconcile_summary(reconcile(replayed, windowed_vwap(replayed))).collect()[0]
    assert row.count_mismatches == 3 and row.exact_matches == 100


def test_top_mismatches_and_report(hundred):
    report = reconciliation_report(hundred, shifted(windowed_vwap(hundred), 15))
    listed = report["mismatches"].collect()
    assert len(listed) == 10 and listed[0].vwap_diff_pct == 1.0
    assert listed[0].stream_vwap == 101.0
    assert report["summary"].collect()[0].verdict == "FAILED"
    assert report["raw"].collect()[0].total_rows == 100


def test_reconciliation_does_not_depend_on_row_order(spark):
    """Differing payloads of one id: always the same one is compared."""
    from pyspark.sql import functions as F

    from tickerloom.operators.reconcile import batch_bars

    rows = [("x", "A", 10.0, 1), ("x", "A", 20.0, 1), ("y", "A", None, None)]
    seen = set()
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "trade_id string, ticker string, price double, quantity int")
        df = df.withColumn("event_time", F.lit("2024-01-01 10:00:00").cast("timestamp")).coalesce(1)
        seen.add(tuple(r.batch_vwap for r in batch_bars(df).collect()))
    assert seen == {(10.0,)}
