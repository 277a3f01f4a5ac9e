"""Quality checks of open-interest and funding-rate tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import specs
from tidemark.functions.quantiles import (
    join_group_stats,
    quantiles,
)
from tidemark.functions.scalars import positive, present
from tidemark.operators.audit_candles import changes_of, duplicate_keys, gap_message, time_gaps
from tidemark.operators.findings import counted, to_findings
from tidemark.operators.gaps import scan
from tidemark.session import materialise

SERIES = ("exchange", "symbol")
REPORT = ("symbol",)


def metric_duplicates(df: DataFrame) -> DataFrame:
    return duplicate_keys(df, SERIES)


def metric_time_gaps(df: DataFrame, table: str) -> DataFrame:
    return time_gaps(df, SERIES, F.lit(specs.table_spec(table).cadence_seconds))


def metric_value_errors(df: DataFrame, value: str, must_be_positive: bool) -> DataFrame:
    """Missing or non-finite values; open interest must also be above zero."""
    good = positive(value) if must_be_positive else present(value)
    return (
        df.where(F.col("timestamp").isNull() | ~good)
        .groupBy(*REPORT)
        .agg(
            F.count("*").alias("bad_count"),
            F.min("timestamp").alias("first_timestamp"),
            F.max("timestamp").alias("last_timestamp"),
        )
    )


def open_interest_changes(df: DataFrame, config: specs.AuditConfig | None = None) -> DataFrame:
    """Relative changes far above the upper quartile of the series."""
    config = config or specs.AuditConfig()
    changes = changes_of(
        df, "open_interest", SERIES, F.lit(specs.OPEN_INTEREST_SECONDS)
    ).withColumn("relative_change", F.abs("relative_return"))
    # Stored once, narrow: the quantiles and the comparison below read them.
    changes = materialise(
        changes.select(*REPORT, "timestamp", "relative_change", "weight"), "open-interest-changes"
    )
    iqr = F.col("q3") - F.col("q1")
    quartiles = quantiles(changes, REPORT, "relative_change", {"q1": 0.25, "q3": 0.75}, "weight")
    far = F.col("relative_change") > F.col("q3") + config.open_interest_change_iqr_multiplier * iqr
    return (
        join_group_stats(changes, quartiles, REPORT, ["timestamp"], size="n")
        .where((F.col("n") >= config.min_outlier_observations) & (iqr > 0) & far)
        .groupBy(*REPORT)
        .agg(
            F.sum("weight").alias("bad_count"),
            F.min("timestamp").alias("first_timestamp"),
            F.max("timestamp").alias("last_timestamp"),
            F.max("relative_change").alias("max_relative_change"),
        )
    )


def funding_extremes(df: DataFrame, config: specs.AuditConfig | None = None) -> DataFrame:
    config = config or specs.AuditConfig()
    size = F.abs("funding_rate")
    return (
        df.where(size > config.funding_rate_abs_warn)
        .groupBy(*REPORT)
        .agg(
            F.count("*").alias("bad_count"),
            F.min("timestamp").alias("first_timestamp"),
            F.max("timestamp").alias("last_timestamp"),
            F.max(size).alias("max_abs_funding_rate"),
        )
    )


def funding_distribution(df: DataFrame, config: specs.AuditConfig | None = None) -> DataFrame:
    config = config or specs.AuditConfig()
    return (
        df.where(present("funding_rate"))
        .groupBy(*REPORT)
        .agg(
            F.count("*").alias("bad_count"),
            F.min("timestamp").alias("first_timestamp"),
            F.max("timestamp").alias("last_timestamp"),
            F.avg("funding_rate").alias("mean_funding_rate"),
            F.stddev_samp("funding_rate").alias("std_funding_rate"),
        )
        .where(
            (F.col("bad_count") >= config.min_outlier_observations)
            & (
                (F.abs("mean_funding_rate") > config.funding_rate_mean_abs_warn)
                | (F.col("std_funding_rate") > config.funding_rate_std_warn)
            )
        )
    )


def _shared(rows: DataFrame, table: str, value: str, must_be_positive: bool) -> DataFrame:
    return (
        to_findings(
            metric_duplicates(rows),
            table,
            "duplicate_primary_key",
            "ERROR",
            counted("duplicate rows on primary key"),
            ["max_occurrences"],
        )
        .unionByName(
            to_findings(
                metric_time_gaps(rows, table),
                table,
                "time_gaps",
                "ERROR",
                gap_message(),
                ["max_delta_seconds", "expected_seconds"],
            )
        )
        .unionByName(
            to_findings(
                metric_value_errors(rows, value, must_be_positive),
                table,
                "invalid_values",
                "ERROR",
                counted("rows contain null, infinite, or out-of-range values"),
            )
        )
    )


def audit_open_interest(
    df: DataFrame,
    config: specs.AuditConfig | None = None,
    symbols: Sequence[str] | None = None,
) -> DataFrame:
    config = config or specs.AuditConfig()
    rows = scan(df, symbols)
    return _shared(rows, "open_interest", "open_interest", True).unionByName(
        to_findings(
            open_interest_changes(rows, config),
            "open_interest",
            "open_interest_change_outliers",
            "WARN",
            counted("relative-change outliers detected by IQR"),
            ["max_relative_change"],
        )
    )


def audit_funding_rates(
    df: DataFrame,
    config: specs.AuditConfig | None = None,
    symbols: Sequence[str] | None = None,
) -> DataFrame:
    config = config or specs.AuditConfig()
    rows = scan(df, symbols)
    extremes = funding_extremes(rows, config).withColumn(
        "threshold", F.lit(config.funding_rate_abs_warn)
    )
    return (
        _shared(rows, "funding_rates", "funding_rate", False)
        .unionByName(
            to_findings(
                extremes,
                "funding_rates",
                "funding_rate_extremes",
                "WARN",
                counted("funding rates exceed absolute threshold"),
                ["threshold", "max_abs_funding_rate"],
            )
        )
        .unionByName(
            to_findings(
                funding_distribution(rows, config),
                "funding_rates",
                "funding_rate_distribution",
                "WARN",
                F.lit("funding rate distribution mean or standard deviation exceeds threshold"),
                ["mean_funding_rate", "std_funding_rate"],
            )
        )
    )
