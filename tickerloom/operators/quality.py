"""The seven-check quality gate and the late-data check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.fixed_values import (
    CONTAMINATION_VWAP,
    HIGH_PRICED,
    LATE_PHASES,
    LATE_SOURCE,
    UNIVERSE,
    VWAP_MAX,
    VWAP_MIN,
)

CHECKED = [
    "ticker", "vwap", "buy_pressure", "total_volume", "low_price", "high_price",
    "window_start", "window_end",
]


def missing_tickers(bars: DataFrame, universe: DataFrame) -> DataFrame:
    """Universe symbols that have no bar."""
    return universe.join(bars.select("ticker").distinct(), "ticker", "left_anti")


def _check_row(no: int, name: str, tables: str, violations: Column, detail: Column) -> Column:
    return F.struct(
        F.lit(no).alias("check_no"),
        F.lit(name).alias("check_name"),
        F.lit(tables).alias("tables"),
        violations.cast("bigint").alias("violations"),
        (violations == 0).alias("passed"),
        detail.alias("detail"),
    )


def _metrics(is_short: Column, is_long: Column, window_seconds: int) -> list[Column]:
    """The conditional counts behind all checks but the fifth."""
    width = F.unix_micros("window_end") - F.unix_micros("window_start")
    return [
        F.count_if(is_short & F.col("vwap").isNull()).alias("null_short"),
        F.count_if(is_long & F.col("vwap").isNull()).alias("null_long"),
        F.count_if((F.col("vwap") < VWAP_MIN) | (F.col("vwap") > VWAP_MAX)).alias("range"),
        F.count_if((F.col("buy_pressure") < 0) | (F.col("buy_pressure") > 100)).alias("pressure"),
        F.count_if(F.col("total_volume") <= 0).alias("volume"),
        F.count_if(
            is_short & ~width.eqNullSafe(F.lit(window_seconds * 1_000_000))
        ).alias("width"),
        F.count_if(F.col("high_price") < F.col("low_price")).alias("high_low"),
    ]


def _checks_of(counts: DataFrame, tickers: list[str], window_seconds: int) -> DataFrame:
    """Seven rows from one row of counts and the list ``absent``."""
    def said(column: str, what: str) -> Column:
        return F.concat(F.col(column).cast("string"), F.lit(f" {what}"))

    rows = [
        _check_row(1, "vwap not null", "both", F.col("null_short") + F.col("null_long"),
                   F.concat(said("null_short", "short, "), said("null_long", "long"))),
        _check_row(2, f"vwap in [{VWAP_MIN}, {VWAP_MAX}]", "both", F.col("range"),
                   said("range", "out of range")),
        _check_row(3, "buy pressure in [0, 100]", "both", F.col("pressure"),
                   said("pressure", "invalid")),
        _check_row(4, "volume positive", "both", F.col("volume"),
                   said("volume", "not positive")),
        _check_row(5, "all tickers present", "long", F.size("absent"),
                   F.when(F.size("absent") == 0, F.lit(f"all {len(tickers)} present"))
                   .otherwise(F.concat(F.lit("missing: "), F.array_join("absent", ", ")))),
        _check_row(6, f"window spans {window_seconds} s", "short", F.col("width"),
                   said("width", "wrong")),
        _check_row(7, "high >= low", "both", F.col("high_low"),
                   said("high_low", "violated")),
    ]
    return counts.select(F.inline(F.array(*rows)))


def quality_checks(
    short_bars: DataFrame,
    long_bars: DataFrame,
    universe: list[str] | None = None,
    window_seconds: int = 60,
) -> DataFrame:
    """Seven rows, one per check, from one scan of each table.

    A NULL measure violates only check 1 (vwap) and check 6 (window bounds); other
    comparisons with NULL are not counted. Completeness is checked on the long
    bars. The one collected set holds universe symbols only, so it stays small.
    """
    tickers = sorted(universe if universe is not None else UNIVERSE)
    both = short_bars.select(*CHECKED, F.lit("short").alias("bars")).unionAll(
        long_bars.select(*CHECKED, F.lit("long").alias("bars"))
    )
    is_short, is_long = F.col("bars") == "short", F.col("bars") == "long"
    known = F.when(is_long & F.col("ticker").isin(*tickers), F.col("ticker"))
    counts = both.agg(*_metrics(is_short, is_long, window_seconds), F.array_sort(
        F.array_except(F.array(*map(F.lit, tickers)), F.collect_set(known))).alias("absent"))
    return _checks_of(counts, tickers, window_seconds)


def write_metrics(short: bool, universe: list[str] | None = None, window_seconds: int = 60) -> list[Column]:
    """What a write of one bar table has to observe for the checks: counts, and per symbol
    whether it occurs."""
    tickers = sorted(universe if universe is not None else UNIVERSE)
    seen = [] if short else [F.bool_or(F.col("ticker") == name).alias(f"seen_{at}")
                             for at, name in enumerate(tickers)]
    return [*_metrics(F.lit(short), F.lit(not short), window_seconds), *seen]


def checks_from_metrics(
    spark: SparkSession,
    short: dict,
    long_: dict,
    universe: list[str] | None = None,
    window_seconds: int = 60,
) -> DataFrame:
    """The rows of ``quality_checks`` from what two writes observed."""
    tickers = sorted(universe if universe is not None else UNIVERSE)
    names = ["null_short", "null_long", "range", "pressure", "volume", "width", "high_low"]
    absent = [name for at, name in enumerate(tickers) if not long_[f"seen_{at}"]]
    counts = spark.createDataFrame(
        [(*(short[n] + long_[n] for n in names), absent)],
        ", ".join(f"`{n}` bigint" for n in names) + ", absent array<string>")
    return _checks_of(counts, tickers, window_seconds)


def gate(checks: DataFrame) -> DataFrame:
    """One row: checks passed, checks run, failed check numbers, and ``ok``."""
    failed = F.array_sort(F.collect_list(F.when(~F.col("passed"), F.col("check_no"))))
    return checks.agg(
        F.count_if("passed").alias("passed_checks"),
        F.count("*").alias("total_checks"),
        F.array_join(failed.cast("array<string>"), ", ").alias("failed_checks"),
    ).withColumn("ok", F.col("passed_checks") == F.col("total_checks"))


def contaminated_tickers(
    bars: DataFrame, limit: float = CONTAMINATION_VWAP, exempt: list[str] | None = None
) -> DataFrame:
    """Tickers not known as high priced that have a bar with VWAP above ``limit``."""
    exempt = exempt if exempt is not None else HIGH_PRICED
    return (
        bars.filter((F.col("vwap") > limit) & ~F.col("ticker").isin(*exempt))
        .groupBy("ticker")
        .agg(F.count("*").alias("bars"), F.max("vwap").alias("max_vwap"))
    )


def ticker_max_vwap(bars: DataFrame) -> DataFrame:
    return bars.groupBy("ticker").agg(F.max("vwap").alias("max_vwap"))


def ticker_bars(bars: DataFrame, ticker: str) -> DataFrame:
    """All bars of one ticker in time order."""
    return bars.filter(F.col("ticker") == ticker).orderBy("window_start").select(
        "ticker", "vwap", "total_volume", "trade_count", "window_start", "window_end"
    )


def lateness_audit(
    trades: DataFrame,
    bars: DataFrame,
    ticker: str,
    limit: float = CONTAMINATION_VWAP,
    exempt: list[str] | None = None,
    phases: dict[str, int] | None = None,
    source: str = LATE_SOURCE,
) -> DataFrame:
    """Did late rows stay in the event log and out of the closed windows?

    One row per check. ``on-time window emitted`` guards against passing on no
    output at all: the ticker needs a bar covering its earliest on-time trade.
    """
    phases = phases if phases is not None else LATE_PHASES
    exempt = exempt if exempt is not None else HIGH_PRICED
    first_phase = next(iter(phases))
    is_phase = {p: F.col("trade_id").startswith(p) for p in phases}
    late = trades.filter(F.col("source") == source)
    seen = late.agg(
        *[F.count_if(is_phase[p]).alias(f"n{i}") for i, p in enumerate(phases)],
        F.min(F.when(is_phase[first_phase], F.col("event_time"))).alias("anchor"),
    )
    # Scalar subqueries over one aggregate, which Spark computes together in one scan.
    found = {name: seen.select(name).scalar() for name in seen.columns}
    mine = F.col("ticker") == ticker
    state = bars.agg(
        F.count_if(
            mine & (F.col("window_start") <= found["anchor"])
            & (found["anchor"] < F.col("window_end"))
        ).alias("emitted"),
        F.count_if(mine & (F.col("vwap") > limit)).alias("poisoned"),
        F.count_if((F.col("vwap") > limit) & ~F.col("ticker").isin(*exempt)).alias("others"),
    )

    def row(name: str, expected: str, actual: Column, passed: Column) -> Column:
        return F.struct(
            F.lit(name).alias("check_name"), F.lit(expected).alias("expected"),
            actual.cast("bigint").alias("actual"), passed.alias("passed"),
        )

    stored = [
        row(f"{p} stored", str(n), found[f"n{i}"], found[f"n{i}"] == n)
        for i, (p, n) in enumerate(phases.items())
    ]
    judged = [
        row("on-time window emitted", "at least 1", F.col("emitted"), F.col("emitted") >= 1),
        row(f"{ticker} vwap within limit", "0", F.col("poisoned"), F.col("poisoned") == 0),
        row("other tickers within limit", "0", F.col("others"), F.col("others") == 0),
    ]
    return state.select(F.inline(F.array(*stored, *judged)))
