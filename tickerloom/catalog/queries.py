"""One callable ``(spark, sf_dir) -> DataFrame`` per registered query."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.catalog import feeds
from tickerloom.catalog.feeds import comparable
from tickerloom.functions import measures
from tickerloom.operators import (
    bars,
    dedup,
    health,
    market,
    outliers,
    quality,
    reconcile,
    sketches,
    skew,
    trades,
    vendor,
)
from tickerloom.plans import incremental, publish
from tickerloom.plans.outlier_report import stored_bounds
from tickerloom.session import materialize, scratch_path
from tickerloom.sinks import batchlog, files, versioned, warehouse
from tickerloom.sources import dimensions
from tickerloom.sources.messages import (
    captured_messages,
    keyed_text,
    parse_trades,
    rejected_messages,
)
from tickerloom.sources.tables import read_table, read_tables, read_trade_log
from tickerloom.streaming import boards, late
from tickerloom.streaming import queries as streams

Query = Callable[[SparkSession, str], DataFrame]
# As the operators return it, and with settled digits for comparing.
BUILDERS: dict[str, Query] = {}
REGISTERED: dict[str, Query] = {}

# Wide enough for the provided prices, whose windows vary a lot.
BAND_PCT = 50.0
UNIVERSE = [*feeds.TICKERS, "refund"]
# Where the month of events is cut into three periods.
CUTS = ["2024-01-11", "2024-01-21"]
DEDUP_ORDER = ["event_time", "l_partkey", "l_suppkey", "quantity", "price"]


def query(build: Query) -> Query:
    """Register ``build`` under its name."""
    BUILDERS[build.__name__] = build
    REGISTERED[build.__name__] = lambda spark, sf: comparable(build(spark, sf))
    return build


def _bars(spark: SparkSession, sf: str, duration: str = "1 hour") -> DataFrame:
    return bars.windowed_vwap(feeds.trades(spark, sf), duration)


def _bounds(spark: SparkSession, sf: str, duration: str = "1 day") -> DataFrame:
    return bars.anomaly_bounds(_bars(spark, sf, duration), BAND_PCT)


def _outliers(spark: SparkSession, sf: str, **options) -> DataFrame:
    source = feeds.trades(spark, sf)
    return outliers.outlier_trades(
        source, stored_bounds(source, "1 day", BAND_PCT), **{"grid": "1 day", **options}
    )


# --- parsing and enrichment ---


@query
def parsed_messages(spark, sf):
    """Message bytes -> trades; bad payloads give NULL rows (quantity shown as double)."""
    parsed = trades.enrich(parse_trades(feeds.trade_messages(feeds.events(spark, sf))))
    return parsed.drop("timestamp").withColumns({
        c: F.col(c).cast("double") for c in ("quantity", "is_buy", "buy_volume")
    })


@query
def rejected_payloads(spark, sf):
    bad = rejected_messages(feeds.trade_messages(feeds.events(spark, sf)))
    return bad.select("topic", "partition", "offset", "payload")


@query
def vendor_normalize(spark, sf):
    """Vendor batches -> trades (the hashed id is left out, SQL side has no such hash)."""
    rows = vendor.normalize_vendor_batch(
        feeds.vendor_messages(feeds.events(spark, sf)), ["click", "purchase", "signup", "view"]
    )
    return rows.select(
        "ticker", "price", F.col("quantity").cast("double").alias("quantity"), "side",
        "trade_type", "exchange", "source", "event_time",
    )


@query
def vendor_trade_ids(spark, sf):
    """Ids given to vendor trades are unique and survive a replay unchanged."""
    messages = feeds.vendor_messages(feeds.events(spark, sf))
    ids = vendor.normalize_vendor_batch(messages, feeds.TICKERS).select("trade_id")
    replayed = ids.unionAll(ids)
    return dedup.duplicate_stats(replayed)


@query
def bronze_log(spark, sf):
    messages = feeds.trade_messages(feeds.events(spark, sf))
    log = trades.bronze(trades.enrich(parse_trades(messages)))
    return log.withColumn("quantity", F.col("quantity").cast("double"))


@query
def session_trades(spark, sf):
    flagged = trades.in_session(feeds.trades(spark, sf))
    return flagged.select("trade_id", "ticker", "event_time", "in_session")


@query
def session_trades_holidays(spark, sf):
    """Session flags with two exchange holidays."""
    closed = spark.createDataFrame([("2024-01-01",), ("2024-01-15",)], "day string").select(
        F.to_date("day").alias("holiday"))
    flagged = trades.in_session(feeds.trades(spark, sf), holidays=closed)
    return flagged.select("trade_id", "ticker", "event_time", "in_session")


@query
def sector_enrichment(spark, sf):
    """Left join to a broadcast dimension; five brands have no sector."""
    rows = [
        (f"Brand#{i}", 100 + i, ["Technology", "Finance", "Energy"][i % 3])
        for i in range(1, 21)
    ]
    joined = trades.with_sector(feeds.order_lines(spark, sf), dimensions.sectors(spark, rows))
    return joined.select(
        "trade_id", "l_partkey", "l_suppkey", "event_time", "ticker", "quantity", "price",
        F.coalesce("sector", F.lit("none")).alias("sector"),
        F.col("base_price").cast("double").alias("base_price"),
    )


# --- bars and bounds ---


@query
def vwap_1h(spark, sf):
    return _bars(spark, sf, "1 hour")


@query
def vwap_1d(spark, sf):
    return _bars(spark, sf, "1 day")


@query
def vwap_5min(spark, sf):
    return _bars(spark, sf, "5 minutes")


@query
def vwap_lines_1d(spark, sf):
    """Daily bars of the order lines (25 tickers)."""
    lines = trades.enrich(feeds.order_lines(spark, sf)).withColumns({
        "bid_price": F.lit(None).cast("double"), "ask_price": F.lit(None).cast("double"),
    })
    return bars.windowed_vwap(lines, "1 day").select(
        "window_start", "ticker", "vwap", "low_price", "high_price", "total_volume",
        "total_dollar_volume", "trade_count", "buy_volume", "sell_volume", "buy_pressure",
    )


@query
def vwap_by_ticker(spark, sf):
    return bars.vwap_by_ticker(feeds.order_lines(spark, sf))


@query
def anomaly_bounds_1d(spark, sf):
    return _bounds(spark, sf)


@query
def vwap_unknown_volume(spark, sf):
    """Daily volumes with the part whose side is unknown."""
    daily = bars.windowed_vwap(feeds.trades(spark, sf), "1 day", unknown_volume=True)
    return daily.select(
        "window_start", "ticker", "total_volume", "buy_volume", "sell_volume", "unknown_volume")


def vwap_decimals(spark, sf):
    """The two decimal measures in their own types."""
    return _bars(spark, sf, "1 day").select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), "ticker",
        "buy_pressure", "avg_spread")


# Registered as it is: ``comparable`` would turn the decimals into doubles.
BUILDERS["vwap_decimals"] = REGISTERED["vwap_decimals"] = vwap_decimals


# --- outliers ---


@query
def outlier_trades(spark, sf):
    return _outliers(spark, sf)


@query
def outlier_trades_interval(spark, sf):
    """The same outliers through the join for arbitrary intervals."""
    return _outliers(spark, sf, grid=None, cell_seconds=6 * 3600)


@query
def outlier_trades_sliced(spark, sf):
    """The same outliers with every window above 20 trades split into slices."""
    return _outliers(spark, sf, slice_rows=20)


@query
def outliers_by_ticker(spark, sf):
    return outliers.outliers_by_ticker(_outliers(spark, sf))


@query
def outlier_directions(spark, sf):
    return outliers.outlier_directions(_outliers(spark, sf))


@query
def outlier_summary(spark, sf):
    source = feeds.trades(spark, sf)
    bounds = stored_bounds(source, "1 day", BAND_PCT)
    found = outliers.outlier_trades(source, bounds, "1 day")
    return outliers.outlier_summary(source, bounds, found)


@query
def top_outliers(spark, sf):
    return outliers.top_outliers(_outliers(spark, sf))


@query
def outlier_rate_repeated_bounds(spark, sf):
    """Bounds stored three times and trades delivered twice do not raise the rate."""
    source = feeds.twice_delivered(feeds.trades(spark, sf))
    bounds = stored_bounds(feeds.trades(spark, sf), "1 day", BAND_PCT)
    repeated = bounds.unionAll(bounds).unionAll(bounds)
    found = outliers.outlier_trades(source, repeated, "1 day")
    return outliers.outlier_summary(source, repeated, found)


# --- duplicates ---


@query
def dedup_trades(spark, sf):
    """Deterministic deduplication of ids that repeat with different payloads."""
    return dedup.dedup(feeds.order_lines(spark, sf), order_by=DEDUP_ORDER)


@query
def dedup_copies(spark, sf):
    """Deduplication of exact copies."""
    delivered = feeds.twice_delivered(feeds.trades(spark, sf))
    return dedup.dedup(delivered).select("trade_id", "ticker", "price", "quantity", "event_time")


@query
def duplicate_stats(spark, sf):
    return dedup.duplicate_stats(feeds.twice_delivered(feeds.trades(spark, sf)))


@query
def duplicate_stats_lines(spark, sf):
    return dedup.duplicate_stats(feeds.order_lines(spark, sf))


@query
def duplicate_keys(spark, sf):
    return dedup.duplicate_keys(feeds.order_lines(spark, sf))


@query
def replay_audit(spark, sf):
    """Before: what had happened by the crash. After: everything, some of it twice."""
    source = feeds.trades(spark, sf)
    by_crash = F.col("event_time") < F.lit(CUTS[1]).cast("timestamp")
    return dedup.replay_audit(source.filter(by_crash), feeds.twice_delivered(source))


# --- reconciliation ---


def _compared(spark: SparkSession, sf: str, how: str = "inner") -> DataFrame:
    """Bars that counted re-deliveries, against a batch pass that dropped them.

    For the full outer form the bars saw the quoted trades only.
    """
    delivered = feeds.twice_delivered(feeds.trades(spark, sf))
    streamed = delivered if how == "inner" else delivered.filter("source = 'simulator'")
    return reconcile.reconcile(
        delivered, bars.windowed_vwap(streamed, "1 hour"), "1 hour", how
    )


@query
def reconcile_windows(spark, sf):
    return _compared(spark, sf)


@query
def reconcile_summary(spark, sf):
    return reconcile.reconcile_summary(_compared(spark, sf))


@query
def reconcile_summary_outer(spark, sf):
    return reconcile.reconcile_summary(_compared(spark, sf, "full_outer"))


@query
def reconcile_mismatches(spark, sf):
    return reconcile.reconcile_mismatches(_compared(spark, sf))


@query
def reconcile_lines(spark, sf):
    """Daily bars of order lines whose ids repeat with other payloads."""
    lines = trades.enrich(feeds.order_lines(spark, sf)).withColumns({
        "bid_price": F.lit(None).cast("double"), "ask_price": F.lit(None).cast("double"),
    })
    return reconcile.reconcile(lines, bars.windowed_vwap(lines, "1 day"), "1 day")


def _by_periods(spark: SparkSession, sf: str) -> tuple[str, str, str]:
    """Trades and hourly bars in batches by period, one of each replayed with other rows, and
    the comparison brought up to date after every step; the paths."""
    paths = [scratch_path(spark, f"followed-{name}") for name in ("trades", "bars", "state")]
    source = feeds.twice_delivered(feeds.trades(spark, sf)).drop("event_id", "user_id")
    first, second = (F.col("event_time") >= F.lit(cut).cast("timestamp") for cut in CUTS)
    periods = [~first, first & ~second, second]
    # At first the second period comes without quoted trades; its replay brings all.
    partial = source.filter(periods[1] & (F.col("source") != "simulator"))

    def deliver(batch: int, rows: DataFrame) -> None:
        versioned.write_batch(rows, batch, paths[0])
        streamed = rows.filter("source = 'simulator'")
        versioned.write_batch(bars.windowed_vwap(streamed, "1 hour"), batch, paths[1])

    for batch, rows in ((0, source.filter(periods[0])), (1, partial), (2, source.filter(periods[2])),
                        (1, source.filter(periods[1]))):
        deliver(batch, rows)
        incremental.reconcile_changes(spark, *paths, "1 hour")
    return tuple(paths)


@query
def reconcile_incremental(spark, sf):
    """The summary of a comparison that followed three batches and a replay."""
    *_, state = _by_periods(spark, sf)
    return reconcile.reconcile_summary(incremental.reconciled(spark, state))


# --- quality ---


def _checks(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_checks(
        _bars(spark, sf, "1 hour"), _bars(spark, sf, "1 day"), UNIVERSE, window_seconds=3600
    )


@query
def dq_checks(spark, sf):
    return _checks(spark, sf)


@query
def dq_gate(spark, sf):
    return quality.gate(_checks(spark, sf))


@query
def missing_tickers(spark, sf):
    return quality.missing_tickers(
        _bars(spark, sf, "1 day"), dimensions.universe(spark, UNIVERSE)
    )


@query
def ticker_max_vwap(spark, sf):
    return quality.ticker_max_vwap(_bars(spark, sf))


@query
def contaminated_tickers(spark, sf):
    return quality.contaminated_tickers(_bars(spark, sf), 150.0, ["view", "error"])


@query
def ticker_bars(spark, sf):
    return quality.ticker_bars(_bars(spark, sf), "purchase")


@query
def lateness_audit(spark, sf):
    """Every event tagged as one of the three phases, against hourly bars."""
    phase = F.element_at(
        F.array(*map(F.lit, ("ontime-", "late-within-", "late-beyond-"))),
        (F.col("event_id") % 3 + 1).cast("int"),
    )
    tagged = feeds.trades(spark, sf).withColumns({
        "trade_id": F.concat(phase, "trade_id"), "source": F.lit("late_data_demo"),
    })
    return quality.lateness_audit(
        tagged, _bars(spark, sf), "error", limit=150.0, exempt=["view"]
    )


@query
def lateness_audit_passing(spark, sf):
    """The audit with the limits that this data meets."""
    tagged = feeds.trades(spark, sf).withColumns({
        "trade_id": F.concat(F.lit("ontime-"), "trade_id"), "source": F.lit("late_data_demo"),
    })
    stored = feeds.events(spark, sf).count()
    return quality.lateness_audit(
        tagged, _bars(spark, sf), "error", limit=1e9, phases={"ontime-": stored, "late-": 0}
    )


# --- market reports ---


@query
def window_listing(spark, sf):
    return market.window_listing(_bars(spark, sf))


@query
def volume_leaders(spark, sf):
    return market.volume_leaders(_bars(spark, sf))


@query
def volume_laggards(spark, sf):
    return market.volume_laggards(_bars(spark, sf))


@query
def pressure_bullish(spark, sf):
    return market.bullish(_bars(spark, sf))


@query
def pressure_bearish(spark, sf):
    return market.bearish(_bars(spark, sf))


@query
def liquidity_most(spark, sf):
    return market.most_liquid(_bars(spark, sf))


@query
def liquidity_least(spark, sf):
    return market.least_liquid(_bars(spark, sf))


@query
def liquidity_least_known(spark, sf):
    return market.least_liquid(_bars(spark, sf), known_only=True)


@query
def volatility_most(spark, sf):
    return market.most_volatile(_bars(spark, sf))


@query
def volatility_least(spark, sf):
    return market.least_volatile(_bars(spark, sf))


@query
def volatility_least_known(spark, sf):
    return market.least_volatile(_bars(spark, sf), known_only=True)


@query
def source_breakdown(spark, sf):
    return market.source_breakdown(feeds.trades(spark, sf))


@query
def source_counts(spark, sf):
    return market.source_counts(feeds.trades(spark, sf))


@query
def distinct_sources(spark, sf):
    return market.distinct_values(feeds.trades(spark, sf), "source")


@query
def data_summary(spark, sf):
    return market.data_summary(
        feeds.trades(spark, sf), _bars(spark, sf, "1 hour"), _bars(spark, sf, "1 day")
    )


@query
def latest_window(spark, sf):
    return market.latest_window(_bars(spark, sf, "1 day"))


@query
def latest_window_board(spark, sf):
    return market.vwap_board(_bars(spark, sf, "1 day"))


@query
def latest_bounds_board(spark, sf):
    return market.bounds_board(_bounds(spark, sf))


@query
def health_board(spark, sf):
    return market.health_board(feeds.trades(spark, sf), _bars(spark, sf))


# --- skew ---


@query
def ticker_counts(spark, sf):
    return skew.ticker_counts(feeds.order_lines(spark, sf))


@query
def ticker_skew(spark, sf):
    return skew.ticker_skew(feeds.order_lines(spark, sf))


@query
def skew_summary(spark, sf):
    return skew.skew_summary(feeds.order_lines(spark, sf))


@query
def top_tickers(spark, sf):
    return skew.top_tickers(feeds.order_lines(spark, sf))


@query
def salted_count(spark, sf):
    return skew.salted_count(feeds.order_lines(spark, sf), "ticker", "trade_id")


@query
def key_distribution(spark, sf):
    messages = feeds.trade_messages(feeds.events(spark, sf))
    keyed = messages.withColumn("ticker", F.col("key").cast("string"))
    return skew.key_distribution(keyed, "ticker", feeds.TICKERS)


@query
def placement_balance(spark, sf):
    messages = feeds.trade_messages(feeds.events(spark, sf))
    keyed = messages.withColumn("ticker", F.col("key").cast("string"))
    return skew.placement_balance(skew.key_distribution(keyed, "ticker"))


@query
def hash_placement(spark, sf):
    """What-if: keys per partition under Spark's own hash, over the order lines."""
    placed = skew.placed_by_hash(feeds.order_lines(spark, sf), "ticker", 3)
    return skew.key_distribution(placed, "ticker")


# --- health, exports, versions, warehouse ---


@query
def table_health(spark, sf):
    hourly = _bars(spark, sf, "1 hour")
    return health.table_health(spark, {
        "raw_trades": (feeds.trades(spark, sf), "event_time"),
        "vwap_1min": (hourly, "window_start"),
        "anomaly_alerts": (bars.anomaly_bounds(hourly.filter("vwap < 0")), "window_start"),
    })


@query
def health_verdict(spark, sf):
    rows = health.table_health(spark, {
        "raw_trades": (feeds.trades(spark, sf), "event_time"),
        "vwap_1min": (_bars(spark, sf, "1 hour"), "window_start"),
    })
    return health.health_verdict(rows, symbols=len(feeds.TICKERS))


@query
def column_summary(spark, sf):
    return health.column_summary(_bars(spark, sf))


@query
def sample_rows(spark, sf):
    """Any five trades; no SQL equivalent, which five is open."""
    return health.sample_rows(feeds.trades(spark, sf))


@query
def sample_membership(spark, sf):
    """How many rows a sample has, and how many of them are trades."""
    source = feeds.trades(spark, sf)
    sample = materialize(health.sample_rows(source).select("trade_id"), "sample")
    found = source.select("trade_id", F.lit(1).alias("found")).distinct()
    return sample.join(found, "trade_id", "left").agg(
        F.count("*").alias("sampled"), F.count("found").alias("trades_among_them"))


@query
def csv_export(spark, sf):
    """Daily bars written as CSV and read back."""
    daily = _bars(spark, sf, "1 day").select(
        "ticker", "window_start", "vwap", "total_volume", "trade_count"
    )
    path = scratch_path(spark, "csv")
    files.export_csv(daily, path)
    return spark.read.schema(daily.schema).option("header", True).csv(path)


@query
def warehouse_projection(spark, sf):
    return warehouse.warehouse_rows(_bars(spark, sf)).drop("_LOADED_AT")


def _versions(spark: SparkSession, sf: str) -> str:
    """Trades written as three periods, the second one written again as a replay."""
    path = scratch_path(spark, "versions")
    source = feeds.trades(spark, sf).drop("event_id")
    first, second = (F.col("event_time") >= F.lit(cut).cast("timestamp") for cut in CUTS)
    periods = [~first, first & ~second, second]
    for batch in (0, 1, 2, 1):
        versioned.write_batch(source.filter(periods[batch]), batch, path)
    return path


@query
def version_history(spark, sf):
    log = versioned.history(spark, _versions(spark, sf))
    return log.select(F.col("version").cast("bigint"), "operation", "rows_written")


@query
def asof_version_counts(spark, sf):
    old = versioned.as_of(spark, _versions(spark, sf), 1)
    return old.groupBy("ticker").agg(
        F.count("*").alias("trade_count"), F.sum("quantity").alias("total_volume")
    )


@query
def version_growth(spark, sf):
    return versioned.version_growth(spark, _versions(spark, sf))


@query
def version_empty_replay(spark, sf):
    """The second period replayed without rows: its partition is emptied."""
    path = _versions(spark, sf)
    versioned.write_batch(feeds.trades(spark, sf).drop("event_id").filter("false"), 1, path)
    return versioned.as_of(spark, path).groupBy("ticker").agg(F.count("*").alias("trade_count"))


@query
def version_history_empty(spark, sf):
    """Versions that wrote no rows are in the history."""
    path = _versions(spark, sf)
    nothing = feeds.trades(spark, sf).drop("event_id").filter("false")
    for batch in (1, 3):
        versioned.write_batch(nothing, batch, path)
    return versioned.history(spark, path).select("version", "operation", "rows_written")


@query
def version_history_compacted(spark, sf):
    """The same history after the log was made into checkpoints twice."""
    path = _versions(spark, sf)
    for _ in range(2):
        batchlog.checkpoint(spark, versioned.log_path(path))
    log = versioned.history(spark, path)
    return log.select(F.col("version").cast("bigint"), "operation", "rows_written")


@query
def asof_merged_groups(spark, sf):
    """A version of a table whose old batches were merged and of which one was replayed since."""
    path = scratch_path(spark, "versions")
    source = feeds.trades(spark, sf).drop("event_id")
    first, second = (F.col("event_time") >= F.lit(cut).cast("timestamp") for cut in CUTS)
    periods = {0: ~first, 7: first & ~second, versioned.GROUP_SIZE: second}
    for batch, period in periods.items():
        versioned.write_batch(source.filter(period), batch, path)
    versioned.merge_groups(spark, path)
    versioned.write_batch(source.filter(periods[7]), 7, path)
    return versioned.as_of(spark, path, versioned.GROUP_SIZE - 1).groupBy("ticker").agg(
        F.count("*").alias("trade_count"), F.sum("quantity").alias("total_volume"))


@query
def schema_rejections(spark, sf):
    """What keeps a frame out of a table, and the rows the table still has afterwards."""
    path = scratch_path(spark, "schema")
    source = feeds.trades(spark, sf)
    versioned.write_batch(source.select("trade_id", "price"), 0, path)
    unfit = source.select("trade_id", F.col("price").cast("string").alias("price"), "side")
    problems = versioned.schema_problems(versioned.stored_schema(spark, path), unfit.schema)
    try:
        versioned.write_batch(unfit, 1, path)
        problems.append("written all the same")
    except versioned.SchemaMismatch:
        pass
    return versioned.as_of(spark, path).agg(F.count("*").alias("rows_kept")).select(
        "rows_kept", F.explode(F.array(*map(F.lit, problems))).alias("problem"))


@query
def table_verification(spark, sf):
    """A filled, an empty, an untimed, a missing and an unreadable table."""
    base = scratch_path(spark, "tables")
    hourly = _bars(spark, sf)
    hourly.write.parquet(f"{base}/filled")
    hourly.filter("false").write.parquet(f"{base}/empty")
    hourly.select("ticker").write.parquet(f"{base}/untimed")
    hourly.select("ticker").coalesce(1).write.text(f"{base}/broken")
    names = ("filled", "empty", "untimed", "missing", "broken")
    found = read_tables(spark, {n: f"{base}/{n}" for n in names}, keep_errors=True)
    return health.table_health(spark, {n: (found[n], "window_start") for n in names})


@query
def exported_tables(spark, sf):
    """Three tables and a missing one exported as single CSV files."""
    daily = _bars(spark, sf, "1 day")
    outcome = files.export_tables(
        {"trades": feeds.trades(spark, sf), "bars": daily, "bounds": bars.anomaly_bounds(daily),
         "nowhere": None}, scratch_path(spark, "export"), single_file=True)
    counted = None
    for name, path in outcome.items():
        if path == "missing":
            one = spark.range(1).select(
                F.lit(name).alias("name"), F.lit(0).alias("files"), F.lit(0).cast("bigint").alias("found"))
        else:
            back = spark.read.option("header", True).csv(path)
            one = back.agg(F.count("*").alias("found")).select(
                F.lit(name).alias("name"), F.lit(len(back.inputFiles())).alias("files"), "found")
        counted = one if counted is None else counted.unionAll(one)
    return counted


def _publishable(frame: DataFrame) -> DataFrame:
    return frame.filter("vwap BETWEEN 1 AND 2000 AND total_volume > 0")


@query
def publish_loaded(spark, sf):
    """Hourly and daily bars pass the gate; the hourly ones read back from the target."""
    sink = warehouse.StagedFilesSink(scratch_path(spark, "warehouse"))
    publish.publish(
        _publishable(_bars(spark, sf)), _publishable(_bars(spark, sf, "1 day")), sink,
        feeds.TICKERS, window_seconds=3600)
    return spark.read.parquet(f"{sink.folder}/VWAP_1MIN").drop("_LOADED_AT")


@query
def publish_outcomes(spark, sf):
    """An open gate, an empty source that is skipped, and a gate closed by a missing ticker."""
    sink = warehouse.StagedFilesSink(scratch_path(spark, "warehouse"))
    hourly, daily = _publishable(_bars(spark, sf)), _publishable(_bars(spark, sf, "1 day"))
    rows = []

    def attempt(case: str, short: DataFrame, universe: list[str]) -> None:
        try:
            done = publish.publish(short, daily, sink, universe, window_seconds=3600)
        except publish.GateClosed as closed:
            done = {name: f"check {no}: {why}" for no, name, why in closed.failed}
        rows.extend((case, what, outcome) for what, outcome in done.items())

    attempt("open", hourly, feeds.TICKERS)
    attempt("empty source", hourly.filter("false"), feeds.TICKERS)
    attempt("closed", hourly, UNIVERSE)
    kept = sink.count(spark, "VWAP_1MIN")
    return spark.createDataFrame(rows, "attempt string, subject string, outcome string").withColumn(
        "rows_in_target", F.lit(kept).cast("bigint"))


@query
def publish_atomic(spark, sf):
    """Loads into files behind one pointer: both tables, a load that breaks before the pointer
    is replaced, a closed gate, and a second load."""
    sink = warehouse.AtomicFilesSink(scratch_path(spark, "warehouse"))
    hourly, daily = _publishable(_bars(spark, sf)), _publishable(_bars(spark, sf, "1 day"))
    some = hourly.filter(F.col("ticker") != feeds.TICKERS[0])
    rows = []

    def attempt(case: str, short: DataFrame, target: warehouse.AtomicFilesSink, universe: list[str]) -> None:
        try:
            outcome = publish.publish(short, daily, target, universe, window_seconds=3600)["VWAP_1MIN"]
        except publish.GateClosed:
            outcome = "gate closed"
        except BrokenLoad:
            outcome = "broken"
        rows.append((case, outcome, sink.count(spark, "VWAP_1MIN"), sink.count(spark, "VWAP_5MIN")))

    attempt("first", hourly, sink, feeds.TICKERS)
    attempt("breaks", some, BreakingSink(sink.folder), feeds.TICKERS)
    attempt("closed", some, sink, UNIVERSE)
    attempt("second", some, sink, feeds.TICKERS)
    return spark.createDataFrame(rows, "attempt string, outcome string, short_rows bigint, long_rows bigint")


class BrokenLoad(RuntimeError):
    """Stands for whatever ends a load before its last step."""


class BreakingSink(warehouse.AtomicFilesSink):
    def reveal(self, spark: SparkSession, versions: dict[str, str]) -> None:
        raise BrokenLoad


# --- streams, run over everything available ---


def _streamed(frame: DataFrame, label: str) -> DataFrame:
    spark = frame.sparkSession
    path, checkpoint = (scratch_path(spark, f"{label}-{kind}") for kind in ("out", "state"))
    streams.finish({
        label: streams.write_stream(frame, path, checkpoint, trigger=streams.AVAILABLE_NOW)
    })
    return spark.read.schema(frame.schema).parquet(path)


@query
def stream_vwap_closed_windows(spark, sf):
    live = feeds.events_as_trades(feeds.events_stream(spark, sf))
    return _streamed(bars.windowed_vwap(live, "1 hour", "10 seconds"), "bars")


@query
def stream_bounds_closed_windows(spark, sf):
    live = feeds.events_as_trades(feeds.events_stream(spark, sf))
    daily = bars.windowed_vwap(live, "1 day", "10 seconds")
    return _streamed(bars.anomaly_bounds(daily, BAND_PCT), "bounds")


@query
def stream_outlier_trades(spark, sf):
    """Trades of closed windows outside their bounds, both sides as streams."""
    live = feeds.events_as_trades(feeds.events_stream(spark, sf))
    kept, state = scratch_path(spark, "bounds"), scratch_path(spark, "bounds-state")
    band = bars.anomaly_bounds(bars.windowed_vwap(live, "1 day", "10 seconds"), BAND_PCT)
    streams.finish({"bounds": streams.write_stream(band, kept, state, trigger=streams.AVAILABLE_NOW)})
    known = streams.stored_stream(spark, kept, band.schema)
    again = feeds.events_as_trades(feeds.events_stream(spark, sf))
    return _streamed(outliers.stream_outlier_trades(again, known, "1 day"), "outliers")


@query
def stream_latest_board(spark, sf):
    """The board of the newest closed window, kept by the stream itself."""
    live = feeds.events_as_trades(feeds.events_stream(spark, sf))
    path, state = scratch_path(spark, "board"), scratch_path(spark, "board-state")
    streams.finish({"board": boards.keep_board(
        bars.windowed_vwap(live, "1 day", "10 seconds"), path, state, trigger=streams.AVAILABLE_NOW)})
    return boards.read_board(spark, path)


@query
def stream_latest_bounds(spark, sf):
    """The price bands of the newest closed window, kept by the stream itself."""
    live = feeds.events_as_trades(feeds.events_stream(spark, sf))
    path, state = scratch_path(spark, "bands"), scratch_path(spark, "bands-state")
    bounds = bars.anomaly_bounds(bars.windowed_vwap(live, "1 day", "10 seconds"), BAND_PCT)
    streams.finish({"board": boards.keep_board(
        bounds, path, state, "window_volume", 5, ("window_avg_price", "anomaly_upper", "anomaly_lower"),
        trigger=streams.AVAILABLE_NOW)})
    return boards.read_board(spark, path)


@query
def distinct_over_days(spark, sf):
    """Ranges of days answered from stored sketches, held against exact counts."""
    path = scratch_path(spark, "sketches")
    source = feeds.trades(spark, sf)
    sketches.store_day_sketches(sketches.day_sketches(source, ("ticker", "user_id")), path)
    stored = read_table(spark, path)
    day = measures.utc_date(F.col("event_time"))
    ranges = [(date(2024, 1, 1), date(2024, 1, 31)), (date(2024, 1, 5), date(2024, 1, 11)),
              (date(2024, 1, 9), date(2024, 1, 9)), (date(2023, 1, 1), date(2023, 1, 2))]
    answers = None
    for since, until in ranges:
        known = sketches.distinct_over(stored, since, until)
        exact = source.filter(day.between(F.lit(since), F.lit(until))).agg(
            F.count_distinct("user_id").alias("users"))
        # One row each: a range has one answer.
        off = F.abs(F.col("distinct_user_id") - exact.scalar())
        row = known.select(
            F.lit(since).alias("since"), F.lit(until).alias("until"), F.col("rows").alias("trade_count"),
            F.col("distinct_ticker").alias("tickers"), exact.scalar().alias("users"),
            (off <= 1 + sketches.error_bound() * exact.scalar()).alias("within_bound"))
        answers = row if answers is None else answers.unionByName(row)
    return answers


@query
def clustered_ticker_days(spark, sf):
    """One ticker's days from an event log that was compacted in the order of its tickers."""
    base, small = (scratch_path(spark, f"clustered-{x}") for x in ("log", "days"))
    log = trades.bronze(feeds.trades(spark, sf).withColumn("kafka_ingest_time", F.col("event_time")))
    log.withColumn("event_date", measures.utc_date(F.col("event_time"))).write.partitionBy(
        "event_date").parquet(base)
    streams.compact_days(spark, base, small, datetime(2024, 1, 21).date(), "event_date",
                         cluster_by=("ticker", "event_time"))
    mine = read_table(spark, small).filter(F.col("ticker") == feeds.TICKERS[0])
    return mine.groupBy("event_date").agg(F.count("*").alias("trade_count"),
                                          F.sum("dollar_volume").alias("dollar_volume"))


@query
def stream_bronze(spark, sf):
    messages = feeds.trade_messages(feeds.events_stream(spark, sf))
    log = trades.bronze(trades.enrich(parse_trades(messages)))
    return _streamed(log, "bronze").withColumn("quantity", F.col("quantity").cast("double"))


@query
def stream_vendor_normalize(spark, sf):
    """Vendor batches normalized on the stream."""
    rows = vendor.normalize_vendor_batch(
        feeds.vendor_messages(feeds.events_stream(spark, sf)),
        ["click", "purchase", "signup", "view"],
    )
    return _streamed(rows.select("ticker", "price", "trade_type", "event_time"), "vendor")


@query
def stream_dedup(spark, sf):
    live = feeds.twice_delivered(feeds.events_as_trades(feeds.events_stream(spark, sf)))
    kept = dedup.dedup_stream(live, "10 seconds")
    return _streamed(kept.select("trade_id", "ticker", "price", "event_time"), "dedup")


@query
def stream_versions(spark, sf):
    """The stream written as replay-safe batches, from two fresh checkpoints in turn."""
    live = feeds.events_as_trades(feeds.events_stream(spark, sf))
    path = scratch_path(spark, "versions")
    for attempt in ("first", "replay"):
        state = scratch_path(spark, f"versions-{attempt}")
        streams.finish({attempt: versioned.stream_batches(live, path, state)})
    return versioned.as_of(spark, path).groupBy("ticker").agg(
        F.count("*").alias("trade_count")
    )


@query
def stream_fan_out_health(spark, sf):
    """All four tables filled by one fan-out run, then inspected."""
    base, state = scratch_path(spark, "fan-out"), scratch_path(spark, "fan-out-state")
    streams.finish(streams.start_fan_out(
        feeds.trade_messages(feeds.events_stream(spark, sf)), base, state,
        durations=("1 hour", "1 day"), trigger=streams.AVAILABLE_NOW,
    ))
    fresh = {"raw_trades": "event_time", "vwap_1min": "window_start",
             "vwap_5min": "window_start", "anomaly_alerts": "window_start"}
    stored = read_tables(spark, {name: f"{base}/{name}" for name in fresh})
    return health.table_health(spark, {n: (stored[n], c) for n, c in fresh.items()})


@query
def stream_reconcile_summary(spark, sf):
    """Closed windows of the stream against a batch pass over the same trades."""
    live = feeds.events_as_trades(feeds.events_stream(spark, sf))
    closed = _streamed(bars.windowed_vwap(live, "1 hour", "10 seconds"), "bars")
    compared = reconcile.reconcile(feeds.trades(spark, sf), closed, "1 hour", "full_outer")
    return reconcile.reconcile_summary(materialize(compared, "compared"))


def _delivered_files(spark: SparkSession, sf: str, folder: str, periods: list[int]) -> None:
    """Message files of these periods, written in this order; every 50th event of the first
    period is held back and comes with the third.

    The messages of a period are dealt over tasks, however few files or row groups the table has.
    """
    first, second = (F.col("ts") >= F.lit(cut).cast("timestamp") for cut in CUTS)
    period = first.cast("int") + second.cast("int")
    held_back = (period == 0) & (F.col("event_id") % 50 == 7)
    tagged = feeds.events(spark, sf).withColumn("_file", F.when(held_back, 2).otherwise(period))
    for number in periods:
        part = tagged.filter(F.col("_file") == number).drop("_file")
        feeds.trade_messages(part.repartition("event_id")).write.mode("append").parquet(folder)


def _one_by_one(spark: SparkSession, sf: str, folder: str, run: Callable[[], None]) -> None:
    """The three periods delivered in turn, each worked off before the next one comes: its files
    are one micro-batch, and the watermark it leaves holds for the next one's rows."""
    for number in range(len(CUTS) + 1):
        _delivered_files(spark, sf, folder, [number])
        run()


@query
def keyed_messages(spark, sf):
    """Keys and payloads of captured messages, counted by key."""
    folder = scratch_path(spark, "messages")
    _delivered_files(spark, sf, folder, [0, 1, 2])
    shown = keyed_text(captured_messages(spark, folder))
    return _streamed(shown, "keyed").groupBy("message_key").agg(
        F.count("*").alias("messages"),
        F.count_if(F.col("payload") == "partition_test").alias("not_json"))


@query
def stream_late_windows(spark, sf):
    """Hourly windows of delayed files: what was kept and what the watermark dropped.

    The engine drops rows by the watermark that the micro-batch before began with. A run ends
    with an empty micro-batch under its own watermark, so the next period meets that one.
    """
    folder, path, state = (scratch_path(spark, f"late-{x}") for x in ("messages", "out", "state"))

    def run() -> None:
        live = trades.enrich(parse_trades(captured_messages(spark, folder)))
        streams.finish({"late": streams.write_stream(
            bars.windowed_vwap(live, "1 hour", "10 seconds"), path, state, trigger=streams.AVAILABLE_NOW)})

    _one_by_one(spark, sf, folder, run)
    everything = bars.windowed_vwap(
        trades.enrich(parse_trades(spark.read.parquet(folder))), "1 hour")
    kept = spark.read.schema(everything.schema).parquet(path)
    return kept.join(
        everything.select("window_start", "ticker", F.col("trade_count").alias("sent")),
        ["window_start", "ticker"],
    ).select("window_start", "ticker", "trade_count",
             (F.col("sent") - F.col("trade_count")).alias("dropped_late"))


@query
def late_rows_side_table(spark, sf):
    """The same windows from the rows themselves: those accepted and those kept aside as late."""
    folder, path, state = (scratch_path(spark, f"late-{x}") for x in ("messages", "rows", "state"))

    def run() -> None:
        live = trades.enrich(parse_trades(captured_messages(spark, folder)))
        streams.finish({"late": late.split_late(live, path, state, "1 hour")})

    _one_by_one(spark, sf, folder, run)
    rows = versioned.as_of(spark, path).filter("trade_id IS NOT NULL").withColumn(
        "window_start", measures.window_start(F.col("event_time"), "1 hour"))
    last = rows.agg(F.max("event_time") - F.expr("INTERVAL 10 SECONDS")).scalar()
    return rows.filter(measures.window_end(F.col("window_start"), "1 hour") <= last).groupBy(
        "window_start", "ticker").agg(
        F.count_if(~F.col("late")).alias("trade_count"), F.count_if("late").alias("dropped_late"),
    ).filter("trade_count > 0")


@query
def stream_rollup_bars(spark, sf):
    """Daily bars made from stored hourly ones by the fan-out."""
    base, state = scratch_path(spark, "fan-out"), scratch_path(spark, "fan-out-state")
    streams.finish(streams.start_fan_out(
        feeds.trade_messages(feeds.events_stream(spark, sf)), base, state,
        durations=("1 hour", "1 day"), trigger=streams.AVAILABLE_NOW, roll_up=True,
    ))
    return read_table(spark, f"{base}/vwap_5min").drop("window_date")


@query
def rollup_bars_1d(spark, sf):
    """Daily bars from hourly ones in batch."""
    return bars.rollup_bars(bars.mergeable_bars(feeds.trades(spark, sf), "1 hour"), "1 day").drop(
        *bars.PART_COLUMNS)


@query
def stream_restart_audit(spark, sf):
    """Two periods, each a micro-batch, a stop, a third one, a restart from the same checkpoint;
    then the audit."""
    folder, path, state = (scratch_path(spark, f"restart-{x}") for x in ("in", "out", "state"))

    def run() -> None:
        messages = captured_messages(spark, folder)
        log = trades.bronze(trades.enrich(parse_trades(messages)))
        streams.finish({"log": streams.write_stream(
            log, path, state, trigger=streams.AVAILABLE_NOW)})

    for number in (0, 1):
        _delivered_files(spark, sf, folder, [number])
        run()
    before = materialize(spark.read.parquet(path).filter("trade_id IS NOT NULL"), "before")
    _delivered_files(spark, sf, folder, [2])
    run()
    after = spark.read.parquet(path).filter("trade_id IS NOT NULL")
    return dedup.replay_audit(before, after)


@query
def bronze_log_by_day(spark, sf):
    """The fan-out's event log, two days of it read back."""
    base, state = scratch_path(spark, "fan-out"), scratch_path(spark, "fan-out-state")
    streams.finish(streams.start_fan_out(
        feeds.trade_messages(feeds.events_stream(spark, sf)), base, state,
        durations=("1 hour", "1 day"), trigger=streams.AVAILABLE_NOW,
    ))
    log = read_trade_log(
        spark, f"{base}/raw_trades", datetime(2024, 1, 10), datetime(2024, 1, 12))
    return log.withColumn("quantity", F.col("quantity").cast("double"))
