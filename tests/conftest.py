import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "3")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tickerloom-tests-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_trades(spark):
    """Enriched trades from (trade_id, ticker, price, quantity, side, event_time) rows."""
    from pyspark.sql import functions as F

    from tickerloom.operators.trades import enrich

    def build(rows, **extra):
        df = spark.createDataFrame(
            rows,
            "trade_id string, ticker string, price double, quantity int, side string, "
            "event_time string",
        ).withColumns({
            "event_time": F.col("event_time").cast("timestamp"),
            "trade_type": F.lit("round_lot"),
            "bid_price": F.col("price") - 0.01,
            "ask_price": F.col("price") + 0.01,
            "exchange": F.lit("ARCA"),
            "source": F.lit("simulator"),
        })
        return enrich(df.withColumns({k: F.lit(v) for k, v in extra.items()}))

    return build


@pytest.fixture
def make_bars(spark):
    """Bars from dicts; anything not given takes a clean value."""
    from datetime import datetime

    schema = (
        "ticker string, vwap double, low_price double, high_price double, avg_price double, "
        "total_volume bigint, total_dollar_volume double, trade_count bigint, "
        "buy_volume bigint, avg_bid double, avg_ask double, sell_volume bigint, "
        "buy_pressure decimal(5,2), avg_spread decimal(10,4), window_start timestamp, "
        "window_end timestamp, window_duration string"
    )
    clean = {
        "ticker": "AAPL", "vwap": 100.0, "low_price": 99.0, "high_price": 101.0,
        "avg_price": 100.0, "total_volume": 10, "total_dollar_volume": 1000.0,
        "trade_count": 2, "buy_volume": 5, "avg_bid": 99.9, "avg_ask": 100.1,
        "sell_volume": 5, "buy_pressure": "50.00", "avg_spread": "0.2000",
        "window_start": "2024-01-01 10:00:00", "window_end": "2024-01-01 10:01:00",
        "window_duration": "1 minute",
    }

    def build(*changes):
        from decimal import Decimal

        rows = []
        for change in changes:
            row = {**clean, **change}
            for name in ("buy_pressure", "avg_spread"):
                if row[name] is not None:
                    row[name] = Decimal(row[name])
            for name in ("window_start", "window_end"):
                if row[name] is not None:
                    row[name] = datetime.fromisoformat(row[name])
            rows.append(tuple(row[name] for name in clean))
        return spark.createDataFrame(rows, schema)

    return build
