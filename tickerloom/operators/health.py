"""Table statistics and the health verdict."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.fixed_values import UNIVERSE

SUMMARY_COLUMNS = ["vwap", "total_volume", "trade_count", "buy_pressure"]


def table_health(
    spark: SparkSession, tables: dict[str, tuple[DataFrame | Exception | None, str]]
) -> DataFrame:
    """One row per table: rows, columns, newest timestamp, status.

    ``tables`` maps a name to (frame, time column). The frame is ``None`` for a missing
    table, and an exception for one that could not be read; its status is ``Error``. A table
    without its time column is ``No time column``: how fresh it is cannot be said. Each
    frame is scanned once, for its time column only.
    """
    stats = []
    for name, (df, time) in tables.items():
        readable = isinstance(df, DataFrame)
        width = len(df.columns) if readable else None
        if not readable:
            one = spark.range(1).select(
                F.lit(None).cast("bigint").alias("row_count"),
                F.lit(None).cast("timestamp").alias("latest"),
            )
        else:
            timed = time in df.columns
            newest = F.max(time) if timed else F.lit(None)
            one = df.agg(
                F.count("*").alias("row_count"), newest.cast("timestamp").alias("latest")
            )
        status = (
            F.lit("Error") if isinstance(df, Exception)
            else F.lit("Missing") if df is None
            else F.when(F.col("row_count") == 0, "Empty").otherwise(
                "OK" if timed else "No time column")
        )
        stats.append(one.select(
            F.lit(name).alias("table_name"), "row_count",
            F.lit(width).cast("int").alias("column_count"), "latest", status.alias("status"),
        ))
    return reduce(DataFrame.unionAll, stats)


def health_verdict(
    health: DataFrame,
    trades_table: str = "raw_trades",
    bars_table: str = "vwap_1min",
    symbols: int = len(UNIVERSE),
) -> DataFrame:
    """One row: are all tables filled, and how many windows long was the run.

    The run length is windows per symbol, at least 1, NULL while either table is
    empty.
    """
    named = {
        "trades": F.max(F.when(F.col("table_name") == trades_table, F.col("row_count"))),
        "windows": F.max(F.when(F.col("table_name") == bars_table, F.col("row_count"))),
    }
    length = F.greatest(F.expr(f"windows div {symbols}"), F.lit(1))
    return health.agg(
        F.bool_and(F.col("status") == "OK").alias("healthy"),
        F.count_if(F.col("status") != "OK").alias("tables_not_ok"),
        *[c.alias(n) for n, c in named.items()],
    ).withColumn(
        "approx_windows_per_symbol",
        F.when((F.col("trades") > 0) & (F.col("windows") > 0), length),
    )


def sample_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """Any ``n`` rows, to look at."""
    return df.limit(n)


def column_summary(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Minimum, maximum and mean per numeric column, one row each, in one pass."""
    columns = columns or SUMMARY_COLUMNS
    stats = {"min_value": F.min, "max_value": F.max, "mean_value": F.avg}
    wide = df.agg(*[
        fn(F.col(c).cast("double")).alias(f"{c}__{name}")
        for c in columns for name, fn in stats.items()
    ])
    rows = [
        F.struct(F.lit(c).alias("column_name"),
                 *[F.col(f"{c}__{name}").alias(name) for name in stats])
        for c in columns
    ]
    return wide.select(F.inline(F.array(*rows)))


def column_summary_text(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The same statistics as text, one row per statistic."""
    return df.select(*(columns or SUMMARY_COLUMNS)).summary("min", "max", "mean")
