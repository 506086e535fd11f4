"""Gated publishing: nothing is loaded unless every quality check passes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickerloom.operators.quality import checks_from_metrics, write_metrics
from tickerloom.session import scratch_path
from tickerloom.sinks.storage import delete
from tickerloom.sinks.warehouse import AtomicFilesSink, Sink, warehouse_rows


class GateClosed(RuntimeError):
    """At least one quality check failed."""

    def __init__(self, failed: list[tuple[int, str, str]]) -> None:
        super().__init__("; ".join(f"check {no} ({name}): {why}" for no, name, why in failed))
        self.failed = failed


def require_quality(checks: DataFrame) -> None:
    """Raise ``GateClosed`` listing the failed checks. Brings at most seven rows here."""
    failed = [
        (r["check_no"], r["check_name"], r["detail"])
        for r in checks.filter("not passed").orderBy("check_no").collect()
    ]
    if failed:
        raise GateClosed(failed)


class LoadIncomplete(RuntimeError):
    """The target does not hold the rows that were sent; load again."""


@dataclass(frozen=True)
class Staged:
    """Warehouse rows written once: where, how many, and what the write observed."""

    path: str
    rows: int
    metrics: dict


def stage(bars: DataFrame, path: str, metrics: list[Column]) -> Staged:
    """Write the warehouse rows of ``bars`` to ``path``; the write itself collects ``metrics``."""
    seen = Observation()
    watched = bars.observe(seen, F.count(F.lit(1)).alias("rows"), *metrics)
    warehouse_rows(watched).write.parquet(path)
    return Staged(path, seen.get["rows"], seen.get)


def load_staged(spark: SparkSession, staged: Staged, table: str, sink: Sink) -> str:
    """Replace one warehouse table; an empty source leaves the target as it is.

    The target is counted afterwards. A mismatch, as a task repeated after an
    executor was lost can leave it, is an error; the load is safe to repeat.
    """
    if staged.rows == 0:
        return "skipped"
    sink.load(spark.read.parquet(staged.path), table)
    found = sink.count(spark, table)
    if found != staged.rows:
        raise LoadIncomplete(f"{table}: sent {staged.rows} rows, found {found}")
    return "loaded"


def publish(
    short_bars: DataFrame,
    long_bars: DataFrame,
    sink: Sink,
    universe: list[str] | None = None,
    window_seconds: int = 60,
    tables: tuple[str, str] = ("VWAP_1MIN", "VWAP_5MIN"),
) -> dict[str, str]:
    """Check both bar tables, then load both. Returns table -> loaded or skipped.

    Each table is computed once: its rows are staged, and the write that stages them collects
    the counts the checks need. A closed gate leaves the target untouched. A sink with
    ``reveal`` takes the staged files over as they are and shows all tables in one step; a load
    cut short before it leaves the old rows readable. Any other sink is loaded from the staged
    files, table by table; that is not atomic but safe to repeat, since it replaces the target.
    """
    spark = short_bars.sparkSession
    atomic = isinstance(sink, AtomicFilesSink)
    staged: dict[str, Staged] = {}
    try:
        for name, bars, short in zip(tables, (short_bars, long_bars), (True, False), strict=True):
            path = sink.staging(name) if atomic else scratch_path(spark, f"staged-{name}")
            staged[name] = Staged(path, 0, {})      # to be cleared, however far the write comes
            staged[name] = stage(bars, path, write_metrics(short, universe, window_seconds))
        metrics = [one.metrics for one in staged.values()]
        require_quality(checks_from_metrics(spark, *metrics, universe, window_seconds))
        if not atomic:
            return {name: load_staged(spark, one, name, sink) for name, one in staged.items()}
        for name, one in staged.items():
            found = spark.read.parquet(one.path).count()        # from the files' footers
            if found != one.rows:
                raise LoadIncomplete(f"{name}: sent {one.rows} rows, found {found}")
        sink.reveal(spark, {name: one.path for name, one in staged.items() if one.rows})
        return {name: "loaded" if one.rows else "skipped" for name, one in staged.items()}
    finally:
        shown = sink.shown(spark).values() if atomic else ()
        for one in staged.values():
            if one.path not in shown:
                delete(spark, one.path)
