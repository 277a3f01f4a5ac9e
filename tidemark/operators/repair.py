"""Gap repair from a second source of the same rows.

All gaps of a table are handled in one job: gaps and source rows meet on (series, time slice),
guards and validation are columns, and only absent keys are left to insert.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import specs
from tidemark.functions.scalars import (
    cadence_seconds,
    epoch_micros,
    epoch_seconds,
    holds,
    prefixed_symbol,
)
from tidemark.operators import upsert, validate
from tidemark.operators.gaps import candle_gaps, expected_count, metric_gaps

# Steps per join slice: small, so that a slice holds few gaps and few rows.
JOIN_STEPS = 64
GAP_KEYS = ["table", "symbol", "interval", "prev_close", "next_close"]


@dataclass(frozen=True)
class Repair:
    """Rows to insert and the outcome of every gap."""

    rows: DataFrame
    outcomes: DataFrame


def table_gaps(
    df: DataFrame,
    table: str,
    symbols: Sequence[str] | None = None,
    intervals: Sequence[str] | None = None,
) -> DataFrame:
    """Gaps of a repairable table."""
    if table not in specs.REPAIRABLE_TABLES:
        raise ValueError(
            f"table {table!r} cannot be repaired; repairable: {', '.join(specs.REPAIRABLE_TABLES)}"
        )
    if specs.table_spec(table).kind == "kline":
        return candle_gaps(df, table, symbols, intervals)
    return metric_gaps(df, table, symbols=symbols)


def with_guards(gaps: DataFrame, row_limits: Mapping[str, int] | None = None) -> DataFrame:
    """Add the number of missing keys and the reasons that make a gap unrecoverable.

    ``row_limits`` gives the rows that a table's source hands out at once, such as the page of a
    network API (``specs.REPAIR_ROW_LIMITS``). By default a source has no such limit.
    """
    step_us = F.col("expected_seconds") * 1_000_000
    start, end = epoch_micros("prev_close"), epoch_micros("next_close")
    missing = expected_count(F.col("prev_close"), F.col("next_close"), F.col("expected_seconds"))
    candle = F.col("table") != "funding_rates"
    limit = F.lit(None).cast("bigint")
    for name, rows in (row_limits or {}).items():
        limit = F.when(F.col("table") == name, F.lit(rows)).otherwise(limit)
    # Whole milliseconds decide, as in the sources the keys come from.
    off_grid = (F.floor(start / 1_000) % (F.col("expected_seconds") * 1_000) != 0) | (
        F.floor(end / 1_000) % (F.col("expected_seconds") * 1_000) != 0
    )
    span_ms = F.floor(end / 1_000) - 1 - F.floor(start / 1_000) - F.col("expected_seconds") * 1_000
    too_wide = span_ms >= limit * F.col("expected_seconds") * 1_000
    return gaps.withColumns(
        {
            "expected_missing": missing,
            "off_grid": candle & off_grid,
            "too_large": F.coalesce(
                F.when(candle, ~off_grid & (missing > limit)).otherwise(too_wide), F.lit(False)
            ),
        }
    )


def _join_slice(ts: Column, step: Column) -> Column:
    return F.floor(epoch_seconds(ts) / (step * JOIN_STEPS)).cast("bigint")


def source_symbols(gaps: DataFrame, backfill: DataFrame, table: str) -> DataFrame:
    """Name under which the source knows each gap's symbol, with the 1000-prefix fallback."""
    if table == "spot":
        return gaps.withColumn("source_symbol", F.col("symbol"))
    known = backfill.select("symbol").distinct()
    unknown = (
        gaps.select("symbol")
        .distinct()
        .where(~F.col("symbol").startswith(specs.PREFIX))
        .join(known, "symbol", "left_anti")
        .withColumn("_prefixed", prefixed_symbol("symbol"))
    )
    found = unknown.join(
        known.withColumnRenamed("symbol", "_prefixed"), "_prefixed", "left_semi"
    )
    return (
        gaps.join(found, "symbol", "left")
        .withColumn("source_symbol", F.coalesce("_prefixed", "symbol"))
        .drop("_prefixed")
    )


def rows_in_gaps(gaps: DataFrame, backfill: DataFrame, table: str) -> DataFrame:
    """Source rows strictly inside a gap, each with its gap, meeting on (series, time slice)."""
    spec = specs.table_spec(table)
    step = F.col("expected_seconds")
    cut = gaps.select(
        *[F.col(c).alias(f"gap_{c}") for c in GAP_KEYS],
        "expected_seconds",
        "source_symbol",
        F.explode(
            F.sequence(
                _join_slice(F.col("prev_close"), step), _join_slice(F.col("next_close"), step)
            )
        ).alias("_slice"),
    )
    source = upsert.dedupe_incoming(
        backfill.where(F.col("exchange") == specs.EXCHANGE), table
    ).withColumnRenamed("symbol", "_source")
    if spec.kind == "kline":
        # The step comes from the interval on both sides, so the slices agree.
        own_step = cadence_seconds("interval")
        same_series = (F.col("_source") == F.col("source_symbol")) & (
            F.col("interval") == F.col("gap_interval")
        )
    else:
        own_step = F.lit(spec.cadence_seconds)
        same_series = F.col("_source") == F.col("source_symbol")
    source = source.withColumn("_at", _join_slice(F.col("timestamp"), own_step))
    inside = (F.col("timestamp") > F.col("gap_prev_close")) & (
        F.col("timestamp") < F.col("gap_next_close")
    )
    return (
        source.join(cut, same_series & (F.col("_at") == F.col("_slice")) & inside)
        .drop("_at", "_slice", "source_symbol")
        .withColumnRenamed("_source", "symbol")
    )


def repair(
    target: DataFrame,
    backfill: DataFrame,
    table: str,
    symbols: Sequence[str] | None = None,
    intervals: Sequence[str] | None = None,
    row_limits: Mapping[str, int] | None = None,
) -> Repair:
    """Fill the gaps of ``target`` from ``backfill``; nothing is written."""
    spec = specs.table_spec(table)
    gaps = with_guards(table_gaps(target, table, symbols, intervals), row_limits)
    named = source_symbols(gaps, backfill, table)
    fetched = rows_in_gaps(named.where(~F.col("off_grid") & ~F.col("too_large")), backfill, table)
    # One row of a gap that breaks the contract rejects what was found for that gap.
    broken = validate.breaks_any_rule(table)
    gap_columns = [f"gap_{c}" for c in GAP_KEYS]
    on_grid = (
        (
            (epoch_micros("timestamp") - epoch_micros("gap_prev_close"))
            % (F.col("expected_seconds") * 1_000_000)
            == 0
        )
        & (
            epoch_micros("timestamp") + F.col("expected_seconds") * 1_000_000
            <= epoch_micros("gap_next_close")
        )
        & (F.col("symbol") == F.col("gap_symbol"))
    )
    per_gap = fetched.groupBy(*gap_columns).agg(
        F.bool_or(broken).alias("_broken"), F.count_if(on_grid).alias("_filled")
    )
    summary = per_gap.select(
        *[F.col(f"gap_{c}").alias(c) for c in GAP_KEYS if c != "interval"],
        F.coalesce("gap_interval", F.lit("")).alias("_interval"),
        "_broken",
        "_filled",
    )
    failed = F.col("off_grid") | F.col("too_large") | F.coalesce("_broken", F.lit(False))
    filled = F.coalesce("_filled", F.lit(0))
    outcomes = (
        gaps.withColumn("_interval", F.coalesce("interval", F.lit("")))
        .join(summary, ["table", "symbol", "_interval", "prev_close", "next_close"], "left")
        .withColumn(
            "missing_count",
            F.when(failed, F.col("expected_missing")).otherwise(F.col("expected_missing") - filled),
        )
        .withColumn(
            "outcome",
            F.when(failed, "network_error")
            .when(F.col("missing_count") == 0, "repaired")
            .otherwise("partial_fill"),
        )
        .select(*GAP_KEYS, "expected_seconds", "expected_missing", "missing_count", "outcome")
    )
    # Metric gaps carry no interval, which an equality join would not match.
    series = [c for c in gap_columns if spec.kind == "kline" or c != "gap_interval"]
    accepted = fetched.join(per_gap.where("_broken").select(*series), series, "left_anti")
    rows = upsert.new_rows(accepted.select(*spec.columns), target, table)
    return Repair(rows, outcomes)


def repair_report(outcomes: DataFrame, inserted: DataFrame | None = None) -> DataFrame:
    """Per table: gaps processed, repaired, left over, and rows inserted if given."""
    totals = outcomes.groupBy("table").agg(
        F.count("*").alias("gaps_processed"),
        F.count_if(F.col("outcome") == "repaired").alias("gaps_fully_repaired"),
        F.count_if(F.col("outcome") == "partial_fill").alias("gaps_partial"),
        F.count_if(F.col("outcome") == "network_error").alias("gaps_failed"),
        F.sum("missing_count").alias("rows_still_missing"),
    )
    return totals if inserted is None else totals.join(inserted, "table", "left").fillna(
        0, ["inserted_rows"]
    )


def unrecoverable(outcomes: DataFrame) -> DataFrame:
    """Gaps not fully repaired, with reason and number of keys still missing."""
    return outcomes.where(F.col("outcome") != "repaired").select(
        *GAP_KEYS, "missing_count", F.col("outcome").alias("reason")
    )


def trailing_rows(
    source: DataFrame, target: DataFrame, table: str, days: int = 3, now: Column | None = None
) -> DataFrame:
    """Closed rows of the last ``days`` of a source that the target lacks.

    ``now`` defaults to the newest source row, one number read on the driver.
    """
    if now is None:
        newest = source.agg(F.max("timestamp")).first()[0]
        now = F.lit(newest).cast("timestamp_ntz")
    recent = holds(
        (F.col("timestamp") > now - F.expr(f"interval {days} days")) & (F.col("timestamp") <= now)
    )
    return upsert.new_rows(source.where(recent), target.where(recent), table)
