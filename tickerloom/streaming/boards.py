"""Top-k boards of the newest window, kept up to date by every micro-batch."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickerloom.operators.market import TIES, latest_top
from tickerloom.sinks.storage import delete, get_text, put_text
from tickerloom.streaming.queries import EVERY_TRIGGER

_FRESH = "_fresh"


def _pointer(path: str) -> str:
    return f"{path.rstrip('/')}/shown.json"


def _shown(spark: SparkSession, path: str) -> dict:
    text = get_text(spark, _pointer(path))
    return {"folder": None, "before": None} if text is None else json.loads(text)


def keep_board(
    bars: DataFrame, path: str, checkpoint: str, volume: str = "total_volume", n: int = 15,
    columns: tuple[str, ...] = ("vwap", "total_volume", "trade_count"), trigger: dict | None = None,
    output_mode: str = "append",
) -> StreamingQuery:
    """Merge each micro-batch of a stream of bars into a stored board of ``n`` rows.

    The board equals ``market.vwap_board`` of all bars so far, without another look at them:
    a micro-batch adds its own top rows of its newest window to the ``n`` that are stored, and
    the newest window among these decides. That is exact since a bar that is not among the
    first ``n`` comes in again only with more volume: bars are final in append mode, and grow
    in update mode, where the newer row of a window and ticker replaces the older one.

    State is the board. It is shown by one pointer file, so a reader sees the board before or
    after a micro-batch; one that is repeated after a crash changes nothing. The folder shown
    before is kept for readers that have just opened it. Extra columns of ``bars`` are dropped.
    """
    wanted = [*TIES, *dict.fromkeys((*columns, volume))]
    board = bars.select(*wanted)
    schema = board.schema

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        shown = _shown(spark, path)
        rows = latest_top(batch, volume, n).withColumn(_FRESH, F.lit(1))
        if shown["folder"] is not None:
            stored = spark.read.schema(schema).parquet(shown["folder"])
            rows = rows.unionByName(stored.withColumn(_FRESH, F.lit(0)))
            others = F.struct(*[name for name in wanted if name not in TIES])
            rows = rows.groupBy(*TIES).agg(F.max_by(others, _FRESH).alias("_row")).select(*TIES, "_row.*")
        folder = f"{path.rstrip('/')}/board-{batch_id}-{uuid.uuid4().hex}"
        latest_top(rows.select(*wanted), volume, n).coalesce(1).write.parquet(folder)
        put_text(spark, _pointer(path), json.dumps({"folder": folder, "before": shown["folder"]}))
        if shown["before"] is not None:
            delete(spark, shown["before"])

    return (
        board.writeStream.foreachBatch(merge).outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_TRIGGER))
        .start()
    )


def read_board(spark: SparkSession, path: str) -> DataFrame | None:
    """The board shown now; ``None`` before the first micro-batch."""
    folder = _shown(spark, path)["folder"]
    return None if folder is None else spark.read.parquet(folder)
