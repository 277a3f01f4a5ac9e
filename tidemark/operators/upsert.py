"""Deduplication, idempotent inserts and replacements, as DataFrames.

Copies of a key are reduced by aggregation, which combines on the map side; a window over the
key would send every copy of a hot key to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import specs

COPIES = "_copies"


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the first in ``order``, with the number of copies in ``_copies``."""
    others = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(
            F.min_by(F.struct(*others), F.struct(*order)).alias("_row"),
            F.count("*").alias(COPIES),
        )
        .select(*[c if c in keys else F.col("_row")[c].alias(c) for c in df.columns], COPIES)
    )


def dedupe_incoming(incoming: DataFrame, table: str) -> DataFrame:
    """One row per primary key; among copies the smallest row wins, so reruns agree."""
    spec = specs.table_spec(table)
    others = [c for c in spec.columns if c not in spec.primary_key]
    return keep_first(incoming.select(*spec.columns), spec.primary_key, others).drop(COPIES)


def dedupe_snapshot(rows: DataFrame) -> DataFrame:
    """One row per provider id and date: best rank, then largest market cap, nulls last."""
    order = [
        F.col("rank").isNull().alias("_no_rank"),
        F.col("rank").alias("_rank"),
        F.col("market_cap").isNull().alias("_no_cap"),
        (-F.col("market_cap")).alias("_cap"),
    ]
    return keep_first(rows, specs.TABLES["crypto_universe"].primary_key, order).drop(COPIES)


def new_rows(incoming: DataFrame, existing: DataFrame, table: str) -> DataFrame:
    """One row for each primary key of ``incoming`` that is not stored yet."""
    return absent_rows(dedupe_incoming(incoming, table), existing, table)


def absent_rows(unique: DataFrame, existing: DataFrame, table: str) -> DataFrame:
    """Rows, one for each key, whose key is not among the existing rows."""
    keys = list(specs.table_spec(table).primary_key)
    return unique.join(existing.select(*keys), keys, "left_anti")


def close_day(ts: Column | str) -> Column:
    """Calendar day a candle belongs to: the day of the instant before its close."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.to_date(ts - F.expr("interval 1 microsecond"))


def replace_days(existing: DataFrame, incoming: DataFrame, days: DataFrame) -> DataFrame:
    """Candles after every (symbol, interval, day) of ``days`` is replaced by ``incoming``."""
    gone = days.select("symbol", "interval", F.col("day").alias("_day")).distinct()
    own = F.col("exchange") == specs.EXCHANGE
    kept = (
        existing.withColumn("_day", F.when(own, close_day("timestamp")))
        .join(gone, ["symbol", "interval", "_day"], "left_anti")
        .drop("_day")
    )
    return kept.select(*existing.columns).unionByName(incoming.select(*existing.columns))


def replace_dates(existing: DataFrame, incoming: DataFrame, dates: DataFrame) -> DataFrame:
    """Snapshots after every date of ``dates`` is replaced; a date without rows ends empty."""
    gone = dates.select("date").distinct()
    kept = existing.join(gone, "date", "left_anti")
    return kept.select(*existing.columns).unionByName(incoming.select(*existing.columns))


def accepted_files(rows: DataFrame, violations: DataFrame, file: str = "file") -> DataFrame:
    """Rows of files without any violation: a file is taken as a whole or not at all."""
    return rows.join(violations.select(file).distinct(), file, "left_anti")


def prune_to_window(
    df: DataFrame,
    symbols: Sequence[str],
    interval: str,
    start: Column,
    end: Column,
) -> DataFrame:
    """Drop the given symbols' candles of one interval outside ``(start, end]``."""
    own = (
        (F.col("exchange") == specs.EXCHANGE)
        & F.col("symbol").isin(*symbols)
        & (F.col("interval") == interval)
    )
    outside = (F.col("timestamp") <= start) | (F.col("timestamp") > end)
    return df.where(~F.coalesce(own & outside, F.lit(False)))


def close_window(start: Column, end: Column) -> tuple[Column, Column]:
    """Close times of a day range: after midnight of ``start`` to midnight after ``end``."""
    return start.cast("timestamp_ntz"), F.date_add(end, 1).cast("timestamp_ntz")


def in_close_window(df: DataFrame, start: Column, end: Column) -> DataFrame:
    low, high = close_window(start, end)
    return df.where((F.col("timestamp") > low) & (F.col("timestamp") <= high))
