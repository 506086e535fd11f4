"""Outlier detection over stored or derived bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickerloom.fixed_values import THRESHOLD_PCT
from tickerloom.operators.bars import anomaly_bounds, windowed_vwap
from tickerloom.operators.outliers import (
    outlier_directions,
    outlier_summary,
    outlier_trades,
    outliers_by_ticker,
    top_outliers,
)
from tickerloom.session import materialize


def stored_bounds(
    trades: DataFrame, duration: str = "1 minute", threshold_pct: float = THRESHOLD_PCT
) -> DataFrame:
    """Bounds computed from the trades and written once.

    The outlier join looks at the bounds twice (busy windows, then the join), and
    they are far smaller than the trades; stored, the trades are aggregated once.
    """
    return materialize(
        anomaly_bounds(windowed_vwap(trades, duration), threshold_pct), "bounds"
    )


def outlier_report(
    trades: DataFrame, bounds: DataFrame, grid: str | None = "1 minute", n: int = 20
) -> dict[str, DataFrame]:
    """Detail and all summaries; the outliers are computed once and stored."""
    found = materialize(outlier_trades(trades, bounds, grid), "outliers")
    return {
        "outliers": found,
        "summary": outlier_summary(trades, bounds, found),
        "by_ticker": outliers_by_ticker(found),
        "directions": outlier_directions(found),
        "top": top_outliers(found, n),
    }
