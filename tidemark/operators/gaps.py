"""Gap enumeration: holes between two observed rows of a regular series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import specs
from tidemark.functions.ordered import time_slice, with_previous
from tidemark.functions.scalars import (
    cadence_seconds,
    epoch_micros,
    ntz_from_micros,
    seconds_between,
)

GAP_COLUMNS = ("table", "symbol", "interval", "prev_close", "next_close", "expected_seconds")


def scan(
    df: DataFrame,
    symbols: Sequence[str] | None = None,
    intervals: Sequence[str] | None = None,
    exchange: str | None = None,
) -> DataFrame:
    """Filtered table scan; every filter is optional and reaches the parquet reader."""
    if exchange is not None:
        df = df.where(F.col("exchange") == exchange)
    if symbols:
        df = df.where(F.col("symbol").isin(*symbols))
    if intervals:
        df = df.where(F.col("interval").isin(*intervals))
    return df


def distinct_times(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct timestamps of every series with their number of copies.

    Copies are combined before the shuffle, so a timestamp stored a billion times costs
    one row per task.
    """
    return df.groupBy(*keys, "timestamp").agg(F.count("*").alias("copies"))


def gaps_between(
    times: DataFrame, keys: Sequence[str], expected: Column
) -> DataFrame:
    """Neighbouring timestamps further apart than the cadence."""
    timed = times.withColumn("expected_seconds", expected.cast("bigint")).where(
        F.col("expected_seconds").isNotNull() & F.col("timestamp").isNotNull()
    )
    ordered = with_previous(
        timed,
        keys,
        ["timestamp"],
        ["timestamp"],
        time_slice("timestamp", F.col("expected_seconds")),
    )
    return ordered.where(
        seconds_between("prev_timestamp", "timestamp") > F.col("expected_seconds")
    )


def candle_gaps(
    df: DataFrame,
    table: str = "spot",
    symbols: Sequence[str] | None = None,
    intervals: Sequence[str] | None = None,
) -> DataFrame:
    """Every gap of a candle table; intervals of variable length are left out."""
    spec = specs.table_spec(table)
    if spec.kind != "kline":
        raise ValueError(f"candle gaps need a candle table, got {table!r}")
    rows = scan(df, symbols, intervals, specs.EXCHANGE)
    keys = spec.series_keys
    return gaps_between(
        distinct_times(rows, keys), keys, cadence_seconds("interval")
    ).select(
        F.lit(table).alias("table"),
        "symbol",
        "interval",
        F.col("prev_timestamp").alias("prev_close"),
        F.col("timestamp").alias("next_close"),
        "expected_seconds",
    )


def metric_gaps(
    df: DataFrame,
    table: str,
    expected_seconds: int | None = None,
    symbols: Sequence[str] | None = None,
) -> DataFrame:
    """Every gap of a single-cadence metric table."""
    spec = specs.table_spec(table)
    if spec.kind != "metric":
        raise ValueError(f"metric gaps need a metric table, got {table!r}")
    cadence = expected_seconds or spec.cadence_seconds
    keys = spec.series_keys
    rows = scan(df, symbols, None, specs.EXCHANGE)
    return gaps_between(distinct_times(rows, keys), keys, F.lit(cadence)).select(
        F.lit(table).alias("table"),
        "symbol",
        F.lit(None).cast("string").alias("interval"),
        F.col("prev_timestamp").alias("prev_close"),
        F.col("timestamp").alias("next_close"),
        "expected_seconds",
    )


def expected_count(gap_start: Column, gap_end: Column, step: Column) -> Column:
    """How many keys lie on the grid strictly inside a gap, one step off either border."""
    first = epoch_micros(gap_start) + step * 1_000_000
    last = epoch_micros(gap_end) - step * 1_000_000
    inside = F.floor((last - first) / (step * 1_000_000)).cast("bigint") + 1
    return F.when(first > last, F.lit(0).cast("bigint")).otherwise(inside)


def missing_keys(gaps: DataFrame) -> DataFrame:
    """One row per key missing inside a gap, from previous + step up to next - step.

    Steps are generated in blocks so that a gap of any length stays a bounded array per row.
    """
    block = 10_000
    step = F.col("expected_seconds")
    counted = gaps.withColumn(
        "_n", expected_count(F.col("prev_close"), F.col("next_close"), step)
    ).where(F.col("_n") > 0)
    blocks = counted.withColumn(
        "_block",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_n") - 1) / block).cast("bigint"))),
    )
    numbered = blocks.withColumn(
        "_i",
        F.explode(
            F.sequence(
                F.col("_block") * block + 1,
                F.least(F.col("_block") * block + block, F.col("_n")),
            )
        ),
    )
    return numbered.withColumn(
        "timestamp",
        ntz_from_micros(epoch_micros("prev_close") + F.col("_i") * step * 1_000_000),
    ).drop("_n", "_block", "_i")
