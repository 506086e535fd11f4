"""A scheduled run in one application: work off the stream, check, publish."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickerloom.plans.publish import publish
from tickerloom.sinks.warehouse import Sink
from tickerloom.sources.tables import require_tables
from tickerloom.streaming.queries import AVAILABLE_NOW, finish, start_fan_out


def run_once(
    messages: DataFrame, base_path: str, checkpoint_base: str, sink: Sink, **publish_options
) -> dict[str, str]:
    """Process what is available, then publish if the quality gate is open."""
    spark = messages.sparkSession
    finish(start_fan_out(messages, base_path, checkpoint_base, trigger=AVAILABLE_NOW))
    bars = require_tables(
        spark, {n: f"{base_path}/{n}" for n in ("vwap_1min", "vwap_5min")}
    )
    return publish(bars["vwap_1min"], bars["vwap_5min"], sink, **publish_options)
