"""Warehouse rows and the truncate-and-load writers."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, TimestampType

from tickerloom.fixed_values import WAREHOUSE_COLUMNS
from tickerloom.sinks.storage import delete, get_text, put_text
from tickerloom.sources.tables import TableMissing

TEXT_TIME = "yyyy-MM-dd HH:mm:ss"


def warehouse_rows(bars: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Bars in the warehouse's shape.

    Upper-case names, no window duration, times as UTC text without a fraction,
    decimals as doubles, and ``_LOADED_AT``.
    """
    if bars.sparkSession.conf.get("spark.sql.session.timeZone") != "UTC":
        raise ValueError("warehouse times are UTC text; set the session zone to UTC")

    def shaped(name: str) -> Column:
        column, kind = F.col(name), bars.schema[name].dataType
        if isinstance(kind, TimestampType):
            column = F.date_format(column, TEXT_TIME)
        elif isinstance(kind, DecimalType):
            column = column.cast("double")
        return column.alias(name.upper())

    stamp = loaded_at if loaded_at is not None else F.current_timestamp()
    return bars.select(*[shaped(n.lower()) for n in WAREHOUSE_COLUMNS], stamp.alias("_LOADED_AT"))


class Sink(Protocol):
    """A place for warehouse tables."""

    def load(self, df: DataFrame, table: str) -> None:
        """Replace the contents of ``table``."""

    def count(self, spark: SparkSession, table: str) -> int:
        """Rows in ``table`` now."""


@dataclass(frozen=True)
class JdbcSink:
    """Truncate-and-load through JDBC, straight from the executors.

    ``connections`` limits parallel sessions on the warehouse. ``truncate`` keeps
    the target's own column types and grants. Each partition is one transaction,
    but a task that is run again after its commit inserts its rows again; compare
    ``count`` with what was sent.
    """

    url: str
    properties: dict[str, str] = field(default_factory=dict)
    connections: int = 16

    def _options(self) -> dict[str, str]:
        return {"url": self.url, **self.properties}

    def load(self, df: DataFrame, table: str) -> None:
        (
            df.write.format("jdbc")
            .options(**self._options())
            .option("dbtable", table)
            .option("truncate", True)
            .option("numPartitions", self.connections)
            .option("batchsize", 10_000)
            .mode("overwrite")
            .save()
        )

    def count(self, spark: SparkSession, table: str) -> int:
        """Counted by the warehouse."""
        reader = spark.read.format("jdbc").options(**self._options())
        asked = reader.option("query", f"SELECT count(*) AS n FROM {table}")
        return int(asked.load().collect()[0][0])


@dataclass(frozen=True)
class StagedFilesSink:
    """Replace ``folder/table`` with files for the warehouse's own bulk load."""

    folder: str
    fmt: str = "parquet"

    def _path(self, table: str) -> str:
        return f"{self.folder.rstrip('/')}/{table}"

    def load(self, df: DataFrame, table: str) -> None:
        df.write.format(self.fmt).mode("overwrite").save(self._path(table))

    def count(self, spark: SparkSession, table: str) -> int:
        return spark.read.format(self.fmt).load(self._path(table)).count()


@dataclass(frozen=True)
class AtomicFilesSink:
    """Tables as versioned folders below ``folder``, all shown by one small pointer file.

    A load writes new folders and then replaces the pointer by one rename. Readers follow the
    pointer: they see all tables of one load or all of the load before, whatever breaks. The
    previous version of a table stays until the next load, for readers that opened it.
    """

    folder: str

    def _pointer(self) -> str:
        return f"{self.folder.rstrip('/')}/current.json"

    def staging(self, table: str) -> str:
        """A fresh folder for a new version of ``table``."""
        return f"{self.folder.rstrip('/')}/versions/{table}/{uuid.uuid4().hex}"

    def _state(self, spark: SparkSession) -> dict[str, dict[str, str]]:
        text = get_text(spark, self._pointer())
        return json.loads(text) if text else {"shown": {}, "before": {}}

    def shown(self, spark: SparkSession) -> dict[str, str]:
        """Path of the version that readers of each table see."""
        return self._state(spark)["shown"]

    def reveal(self, spark: SparkSession, versions: dict[str, str]) -> None:
        """Show these versions from now on; other tables stay as they are."""
        state = self._state(spark)
        kept = {**state["shown"], **versions}
        before = {**state["before"], **{t: p for t, p in state["shown"].items() if t in versions}}
        put_text(spark, self._pointer(), json.dumps({"shown": kept, "before": before}))
        for table in versions:
            if table in state["before"]:
                delete(spark, state["before"][table])

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        shown = self.shown(spark)
        if table not in shown:
            raise TableMissing(f"{table} was never loaded into {self.folder}")
        return spark.read.parquet(shown[table])

    def load(self, df: DataFrame, table: str) -> None:
        """Replace one table on its own."""
        path = self.staging(table)
        df.write.parquet(path)
        self.reveal(df.sparkSession, {table: path})

    def count(self, spark: SparkSession, table: str) -> int:
        return self.read(spark, table).count()
