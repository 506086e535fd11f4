"""Small fixed dimension tables, as local relations whose size Spark knows."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tickerloom.fixed_values import SECTOR_ROWS, UNIVERSE

_SECTORS = pa.schema([("ticker", pa.string()), ("base_price", pa.int64()), ("sector", pa.string())])
_TICKERS = pa.schema([("ticker", pa.string())])


def _local(spark: SparkSession, rows: list[tuple], schema: pa.Schema) -> DataFrame:
    columns = list(zip(*rows)) or [()] * len(schema)
    return spark.createDataFrame(pa.table(
        [pa.array(column, field.type) for column, field in zip(columns, schema)], schema=schema))


def sectors(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    """(ticker, base_price, sector); 25 rows unless others are given."""
    return _local(spark, rows if rows is not None else SECTOR_ROWS, _SECTORS)


def universe(spark: SparkSession, tickers: list[str] | None = None) -> DataFrame:
    tickers = tickers if tickers is not None else UNIVERSE
    return _local(spark, [(ticker,) for ticker in tickers], _TICKERS)
