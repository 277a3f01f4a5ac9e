"""Shared session and small builders for candle, metric and ranking rows."""

from __future__ import annotations

import sys
import tempfile
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark import specs  # noqa: E402
from tidemark.session import configure  # noqa: E402

START = datetime(2024, 1, 1)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


def candle(ts, symbol="BTCUSDT", interval="4h", **changes):
    """A plausible candle row; ``changes`` override single fields."""
    row = {
        "exchange": "binance",
        "symbol": symbol,
        "interval": interval,
        "timestamp": ts,
        "open": 100.0,
        "high": 101.0,
        "low": 99.0,
        "close": 100.5,
        "volume": 100.0,
        "quote_volume": 10_000.0,
        "trades_count": 10,
        "taker_buy_base_volume": 50.0,
        "taker_buy_quote_volume": 5_000.0,
    }
    row.update(changes)
    return tuple(row[name] for name in specs.CANDLE_SCHEMA.fieldNames())


def nullable(schema):
    """The same columns without the NOT NULL marks, so that faulty rows can be built."""
    from pyspark.sql import types as T

    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


@pytest.fixture(scope="session")
def candles(spark):
    def build(rows):
        return spark.createDataFrame(rows, nullable(specs.CANDLE_SCHEMA))

    return build


@pytest.fixture(scope="session")
def metrics(spark):
    def build(table, rows):
        full = [("binance", symbol, ts, value) for symbol, ts, value in rows]
        return spark.createDataFrame(full, nullable(specs.table_spec(table).schema))

    return build


@pytest.fixture(scope="session")
def ranking(spark):
    def build(rows):
        """Rows of (date, symbol, rank, market_cap, tags, provider_id)."""
        full = [
            (
                "coinmarketcap", pid, day, symbol, symbol.title(), symbol.lower(), rank, cap,
                None, None, None, tags, None, None,
            )
            for day, symbol, rank, cap, tags, pid in rows
        ]
        return spark.createDataFrame(full, nullable(specs.UNIVERSE_SCHEMA))

    return build


def every(hours, n, start=START):
    return [start + timedelta(hours=hours * i) for i in range(n)]


def day(text):
    return date.fromisoformat(text)
