"""The physical plans stay the ones intended for large data."""

import os

import pytest
from pyspark.sql import functions as F

from tickerloom.catalog import feeds
from tickerloom.operators import bars, dedup, market, outliers, quality, reconcile, skew

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no provided tables here")


@pytest.fixture
def no_broadcast(spark):
    """As with tables too large to broadcast."""
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = [spark.conf.get(n, None) for n in names]
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name, value in zip(names, before, strict=True):
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return plan(df).count("Exchange hashpartitioning")


def test_bars_shuffle_once_after_partial_aggregation(spark):
    text = plan(bars.windowed_vwap(feeds.trades(spark, SF), "1 hour"))
    assert text.count("Exchange") == 1
    assert text.index("partial_sum") > text.index("Exchange")


def test_only_needed_columns_are_read(spark):
    by_ticker = feeds.trades(spark, SF).groupBy("ticker").count()
    assert "ReadSchema: struct<event_type:string>" in plan(by_ticker)
    bounds = bars.anomaly_bounds(bars.windowed_vwap(feeds.trades(spark, SF), "1 hour"))
    assert "user_id" not in plan(bounds.select("ticker", "anomaly_upper"))


def test_time_filters_reach_the_scan(spark):
    recent = feeds.trades(spark, SF).filter(F.col("event_time") >= F.lit("2024-01-20").cast("timestamp"))
    assert "GreaterThanOrEqual(ts,2024-01-20" in plan(recent)


def test_a_filter_on_tickers_passes_the_aggregate(spark):
    one = bars.windowed_vwap(feeds.trades(spark, SF), "1 hour").filter("ticker = 'view'")
    assert "EqualTo(event_type,view)" in plan(one)


def test_each_payload_is_parsed_once(spark, tmp_path):
    from tickerloom.operators.trades import enrich
    from tickerloom.operators.vendor import normalize_vendor_batch
    from tickerloom.sources.messages import parse_trades, rejected_messages

    events = feeds.events(spark, SF)
    for make, read in (
        (feeds.trade_messages, lambda m: bars.windowed_vwap(enrich(parse_trades(m)))),
        (feeds.trade_messages, rejected_messages),
        (feeds.vendor_messages, lambda m: normalize_vendor_batch(m, feeds.TICKERS)),
    ):
        path = str(tmp_path / str(len(list(tmp_path.iterdir()))))
        make(events).write.parquet(path)
        assert plan(read(spark.read.parquet(path))).count("from_json") == 1


@pytest.mark.parametrize("grid", ["1 day", None])
def test_outlier_join_is_an_equi_join_on_sliced_keys(spark, no_broadcast, tmp_path, grid):
    trades = feeds.trades(spark, SF)
    path = str(tmp_path / "bounds")
    bars.anomaly_bounds(bars.windowed_vwap(trades, "1 day")).write.parquet(path)
    text = plan(outliers.outlier_trades(trades, spark.read.parquet(path), grid, 86_400))
    assert "SortMergeJoin [ticker" in text and "_slot" in text and "_slice" in text
    assert "NestedLoop" not in text and "Cartesian" not in text
    # The list of hot keys is not hinted: with broadcasts off nothing is broadcast.
    assert "BroadcastExchange" not in text and "TakeOrderedAndProject" not in text


def test_filters_on_outliers_reach_the_trades(spark, tmp_path):
    trades = feeds.trades(spark, SF)
    path = str(tmp_path / "bounds")
    bars.anomaly_bounds(bars.windowed_vwap(trades, "1 day")).write.parquet(path)
    found = outliers.outlier_trades(trades, spark.read.parquet(path), "1 day").filter(
        (F.col("event_time") >= F.lit("2024-01-20").cast("timestamp")) & (F.col("ticker") == "view"))
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    scan = next(x for x in plan(found).splitlines() if "FileScan" in x and "event_type" in x)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(ts,2024-01-20" in scan and "EqualTo(event_type,view)" in scan


def test_reconcile_reuses_the_partitioning_of_its_aggregates(spark, no_broadcast):
    trades = feeds.trades(spark, SF)
    compared = reconcile.reconcile(trades, bars.windowed_vwap(trades, "1 hour"), "1 hour")
    assert "SortMergeJoin" in plan(compared)
    assert exchanges(compared) == 3  # dedup, batch bars, stream bars; none for the join


def test_dedup_collapses_copies_before_the_shuffle(spark):
    for order in (None, ["event_time"]):
        text = plan(dedup.dedup(feeds.trades(spark, SF), order_by=order))
        assert "Window" not in text and text.count("SortAggregate") == 2


def test_duplicate_stats_shuffle_the_ids_once(spark):
    assert exchanges(dedup.duplicate_stats(feeds.trades(spark, SF))) == 1


def test_quality_scans_each_table_once(spark):
    hourly = bars.windowed_vwap(feeds.trades(spark, SF), "1 hour")
    daily = bars.windowed_vwap(feeds.trades(spark, SF), "1 day")
    text = plan(quality.quality_checks(hourly, daily))
    assert text.count("FileScan") == 2 and "NestedLoop" not in text


def test_top_k_never_sorts_everything(spark):
    hourly = bars.windowed_vwap(feeds.trades(spark, SF), "1 hour")
    for board in (market.volume_leaders, market.least_liquid, market.vwap_board):
        text = plan(board(hourly))
        assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_source_breakdown_does_not_expand_rows(spark):
    assert "Expand" not in plan(market.source_breakdown(feeds.trades(spark, SF)))
    trades = feeds.trades(spark, SF)
    summary = market.data_summary(trades, trades.limit(1), trades.limit(1))
    scan_side = plan(summary).split("Expand")
    assert len(scan_side) == 1 or "partial_count(1)" in scan_side[1]


def test_sector_join_has_no_shuffle(spark):
    from tickerloom.operators.trades import with_sector
    from tickerloom.sources.dimensions import sectors

    assert "Exchange hashpartitioning" not in plan(with_sector(feeds.trades(spark, SF), sectors(spark)))


def test_the_size_check_runs_no_job(spark):
    dim = feeds.trades(spark, SF).select("ticker").distinct()
    spark.sparkContext.setJobGroup("size-check", "none expected")
    try:
        skew.broadcast_if_small(dim)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("size-check")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_only_small_dimensions_are_hinted(spark, no_broadcast):
    trades = feeds.trades(spark, SF)
    dim = trades.select("ticker").distinct()
    assert "BroadcastHashJoin" in plan(trades.join(skew.broadcast_if_small(dim), "ticker"))
    assert "SortMergeJoin" in plan(trades.join(skew.broadcast_if_small(dim, 4), "ticker"))


def test_skew_categories_count_tickers_once(spark):
    df = skew.ticker_skew(feeds.trades(spark, SF))
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_no_python_workers_anywhere(spark):
    trades = feeds.trades(spark, SF)
    hourly = bars.windowed_vwap(trades, "1 hour")
    for df in (hourly, outliers.outlier_trades(trades, bars.anomaly_bounds(hourly), "1 hour"),
               quality.quality_checks(hourly, hourly)):
        assert "Python" not in plan(df)
