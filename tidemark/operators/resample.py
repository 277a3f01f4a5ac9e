"""Coarser candles and the usual reports over them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import specs
from tidemark.functions import blocks, ordered
from tidemark.functions.ordered import time_slice, with_previous, with_trailing
from tidemark.functions.scalars import (
    as_column,
    cadence_seconds,
    epoch_seconds,
    ntz_from_seconds,
    positive,
)
from tidemark.session import discard, materialise

# Offset of Monday 1970-01-05 from the epoch, for weekly and three-day buckets alike.
MONDAY_OFFSET = 4 * specs.DAY_SECONDS


def just_before(ts: Column | str) -> Column:
    """One second before a close boundary: inside the period the candle closes."""
    return as_column(ts) - F.expr("interval 1 second")


def bucket_close(ts: Column | str, interval: str) -> Column:
    """Close boundary of the coarser candle that a close time falls into."""
    inside = just_before(ts)
    if interval == "1M":
        return F.add_months(F.trunc(inside, "MM"), 1).cast("timestamp_ntz")
    if interval not in specs.INTERVAL_SECONDS:
        raise ValueError(f"unknown interval {interval!r}")
    width = specs.INTERVAL_SECONDS[interval]
    shift = MONDAY_OFFSET if interval == "1w" else 0
    number = F.floor((epoch_seconds(inside) - shift) / width).cast("bigint") + 1
    return ntz_from_seconds(number * width + shift)


def resample(df: DataFrame, interval: str, source: str) -> DataFrame:
    """Candles of a coarser interval made of those of ``source``; other intervals are left alone.

    The key is the close boundary of the bucket. Among copies of a time the smallest open and the
    largest close count. A sum of trades beyond 32 bits, which the column cannot hold, is NULL.
    """
    return (
        df.where(F.col("interval") == source)
        .withColumn("_close", bucket_close("timestamp", interval))
        .groupBy("exchange", "symbol", "_close")
        .agg(
            F.min_by("open", F.struct("timestamp", "open")).alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", F.struct("timestamp", "close")).alias("close"),
            F.sum("volume").alias("volume"),
            F.sum("quote_volume").alias("quote_volume"),
            F.sum("trades_count").try_cast("int").alias("trades_count"),
            F.sum("taker_buy_base_volume").alias("taker_buy_base_volume"),
            F.sum("taker_buy_quote_volume").alias("taker_buy_quote_volume"),
        )
        .withColumnRenamed("_close", "timestamp")
        .withColumn("interval", F.lit(interval))
        .select(*specs.CANDLE_SCHEMA.fieldNames())
    )


def daily_vwap(df: DataFrame) -> DataFrame:
    """Volume-weighted average price per series (exchange, symbol, interval) and trading day."""
    series = ("exchange", "symbol", "interval")
    return (
        df.groupBy(*series, F.to_date(just_before("timestamp")).alias("day"))
        .agg(F.sum("quote_volume").alias("_quote"), F.sum("volume").alias("_base"))
        .select(*series, "day", F.try_divide("_quote", "_base").alias("vwap"))
    )


def rolling_volatility(df: DataFrame, candles: int) -> DataFrame:
    """Sample deviation of log returns over the last ``candles`` rows of each series.

    Copies of a time are ordered by their close, in both passes alike. Windows wider than a slice
    are put together from blocks (``blocks.rolling_deviation``), so no task holds a series.
    """
    order = ["timestamp", "close"]
    keys = ["exchange", "symbol", "interval"]
    rows = df.where(positive("close")).select(*keys, "timestamp", "close")
    step = cadence_seconds("interval")
    change = F.ln(F.col("close") / F.col("prev_close"))
    if candles > ordered.SLICE_STEPS:
        stored = materialise(rows, "closes")
        placed = blocks.with_positions_and_previous(stored, keys, order, step, "close")
        discard(stored)
        returns = placed.withColumn("log_return", change).drop("prev_close")
        return blocks.rolling_deviation(returns, keys, "log_return", candles, "volatility").drop(blocks.POSITION)
    slices = time_slice("timestamp", step)
    returns = with_previous(rows, keys, order, ["close"], slices).withColumn("log_return", change)
    return with_trailing(
        returns,
        keys,
        order,
        candles - 1,
        {
            "volatility": lambda w: F.stddev_samp("log_return").over(
                w.rowsBetween(-(candles - 1), 0)
            )
        },
        slices,
    )


def symbol_counts(df: DataFrame, interval: str) -> DataFrame:
    """Rows per symbol of one interval, largest first."""
    return (
        df.where((F.col("exchange") == specs.EXCHANGE) & (F.col("interval") == interval))
        .groupBy("symbol")
        .agg(F.count("*").alias("nb_rows"))
        .orderBy(F.col("nb_rows").desc(), "symbol")
    )


def price_history(df: DataFrame, symbol: str, interval: str, since: str) -> DataFrame:
    """Candles of one symbol from a date on, in time order."""
    wanted = (
        (F.col("exchange") == specs.EXCHANGE)
        & (F.col("symbol") == symbol)
        & (F.col("interval") == interval)
        & (F.col("timestamp") >= F.lit(since).cast("timestamp_ntz"))
    )
    columns = ("timestamp", "open", "high", "low", "close", "volume")
    return df.where(wanted).select(*columns).orderBy("timestamp")


def interval_summary(
    df: DataFrame, intervals: Sequence[str], symbol: str | None = None
) -> DataFrame:
    """Candle count and first and last close per interval."""
    rows = df.where(
        (F.col("exchange") == specs.EXCHANGE) & F.col("interval").isin(*intervals)
    )
    if symbol is not None:
        rows = rows.where(F.col("symbol") == symbol)
    return rows.groupBy("interval").agg(
        F.count("*").alias("nb_candles"),
        F.min("timestamp").alias("first_date"),
        F.max("timestamp").alias("last_date"),
    )


def top_by_volume(
    df: DataFrame, interval: str, hours: int = 24, n: int = 10, now: Column | None = None
) -> DataFrame:
    """Symbols with the largest volume in the last hours before ``now`` (default: newest row)."""
    rows = df.where((F.col("exchange") == specs.EXCHANGE) & (F.col("interval") == interval))
    if now is None:
        newest = rows.agg(F.max("timestamp")).first()[0]
        now = F.lit(newest).cast("timestamp_ntz")
    return (
        rows.where(F.col("timestamp") >= now - F.expr(f"interval {hours} hours"))
        .groupBy("symbol")
        .agg(F.sum("volume").alias("volume_24h"), F.avg("close").alias("avg_price"))
        .orderBy(F.col("volume_24h").desc(), "symbol")
        .limit(n)
    )


def traded_symbols(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Distinct symbols over several tables."""
    parts = [df.select("symbol") for df in tables.values()]
    result = parts[0]
    for part in parts[1:]:
        result = result.union(part)
    return result.distinct()
