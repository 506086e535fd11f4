"""File exports."""

from __future__ import annotations

from pyspark.sql import DataFrame


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Overwrite ``path`` with CSV files that carry a header.

    ``single_file`` gathers the frame in one write task; use it for small tables.
    """
    if single_file:
        df = df.coalesce(1)
    df.write.mode("overwrite").option("header", True).csv(path)


def export_tables(
    tables: dict[str, DataFrame | None], folder: str, single_file: bool = False
) -> dict[str, str]:
    """Export every table that exists; returns name -> path or ``"missing"``."""
    outcome = {}
    for name, df in tables.items():
        if df is None:
            outcome[name] = "missing"
            continue
        outcome[name] = f"{folder.rstrip('/')}/{name}"
        export_csv(df, outcome[name], single_file)
    return outcome
