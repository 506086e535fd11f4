"""Stored tables."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EPOCH = datetime(1970, 1, 1, tzinfo=UTC)

NOTHING_STORED = {
    "PATH_NOT_FOUND",
    "UNABLE_TO_INFER_SCHEMA",  # a folder without files
    "_LEGACY_ERROR_TEMP_1134",  # the same of a streamed table without rows
    "DELTA_TABLE_NOT_FOUND",
    "DELTA_PATH_DOES_NOT_EXIST",
}


class TableMissing(Exception):
    """No table is stored at the given path."""

    def __init__(self, path: str, reason: str = "") -> None:
        super().__init__(f"no table at {path}" + (f": {reason}" if reason else ""))
        self.path = path


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None
) -> DataFrame:
    """Latest contents of a table. Works for any file system Spark can list.

    With an explicit ``schema`` no footer is read up front, and zone-less
    timestamps can be read as ``timestamp`` directly, which keeps time filters
    pushable (a cast on top of the scan would hide them from it).
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.load(path)
    except AnalysisException as error:
        condition = error.getCondition() or ""
        if condition in NOTHING_STORED:
            raise TableMissing(path, condition) from error
        raise


def read_tables(
    spark: SparkSession, paths: dict[str, str], fmt: str = "parquet", keep_errors: bool = False
) -> dict[str, DataFrame | Exception | None]:
    """Every table that exists; ``None`` for the missing ones.

    ``keep_errors`` puts the error of a table that exists but cannot be read in its place,
    for reports; otherwise it is raised.
    """
    found: dict[str, DataFrame | Exception | None] = {}
    for name, path in paths.items():
        try:
            found[name] = read_table(spark, path, fmt)
        except TableMissing:
            found[name] = None
        except Exception as error:
            if not keep_errors:
                raise
            found[name] = error
    return found


def require_tables(
    spark: SparkSession, paths: dict[str, str], fmt: str = "parquet"
) -> dict[str, DataFrame]:
    """All tables or one error that lists every missing name."""
    found = read_tables(spark, paths, fmt)
    missing = sorted(name for name, df in found.items() if df is None)
    if missing:
        raise TableMissing(", ".join(missing))
    return found


def read_trade_log(
    spark: SparkSession,
    path: str,
    start: datetime | None = None,
    end: datetime | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """The date-partitioned event log, from ``start`` up to but not including ``end``.

    Bounds without a zone are UTC, others are converted. They also select the date
    partitions, which a filter on ``event_time`` alone would not do. A day more is listed on
    either side, so a log whose dates were cut in another zone is read right as well.
    Without bounds, rows without an event time are included.
    """
    log = read_table(spark, path, fmt)
    if start is not None:
        log = log.filter(
            (F.col("event_date") >= F.lit(_utc(start).date() - timedelta(days=1)))
            & (F.col("event_time") >= _instant(start))
        )
    if end is not None:
        log = log.filter(
            (F.col("event_date") <= F.lit(_utc(end).date() + timedelta(days=1)))
            & (F.col("event_time") < _instant(end))
        )
    return log.drop("event_date")


def _utc(moment: datetime) -> datetime:
    return moment.replace(tzinfo=UTC) if moment.tzinfo is None else moment.astimezone(UTC)


def _instant(moment: datetime) -> Column:
    return F.timestamp_micros(F.lit((_utc(moment) - EPOCH) // timedelta(microseconds=1)))
