"""Quality checks of candle tables.

``candle_flags`` holds every row-level rule once. The checks that only look at single rows
share one aggregation; the ordered and statistical checks add one pass each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import specs
from tidemark.functions.ordered import runs_of, time_slice, with_previous
from tidemark.functions.quantiles import (
    join_group_stats,
    quantiles,
)
from tidemark.functions.scalars import (
    cadence_seconds,
    epoch_seconds_rounded,
    finite_sql,
    interval_label,
    positive,
    positive_sql,
    seconds_between,
)
from tidemark.operators.findings import counted, to_findings
from tidemark.operators.gaps import distinct_times, gaps_between, scan
from tidemark.session import materialise

SERIES = ("exchange", "symbol", "interval")
REPORT = ("symbol", "interval")
# Names of the volume checks in reports (fixed values).
VOLUME_FLAGS = (
    "positive_volume_zero_quote",
    "positive_quote_zero_volume",
    "zero_trades_positive_volume",
    "quote_volume_price_band",
    "taker_base_exceeds_volume",
    "taker_quote_exceeds_quote_volume",
)
# Normal-consistency factor of the median absolute deviation (fixed value).
MAD_SCALE = 1.4826


# ---------------------------------------------------------------------------
# Row-level rules, as SQL text: one parsed expression each
# ---------------------------------------------------------------------------
_PRICES = ("open", "high", "low", "close")
_BROKEN_SHAPE = (
    "coalesce(high < low OR high < open OR high < close OR low > open OR low > close, false)"
)
_WELL_FORMED = " AND ".join(positive_sql(name) for name in _PRICES) + f" AND NOT {_BROKEN_SHAPE}"


def invalid_values() -> Column:
    """Missing, non-finite or out-of-range numbers."""
    bad = ["timestamp IS NULL", "coalesce(trades_count < 0, false)"]
    bad += [f"NOT {positive_sql(name)}" for name in _PRICES]
    for name in ("volume", "quote_volume"):
        bad.append(f"NOT {finite_sql(name)} OR coalesce({name} < 0, false)")
    for name in ("taker_buy_base_volume", "taker_buy_quote_volume"):
        bad.append(f"{name} IS NOT NULL AND (NOT {finite_sql(name)} OR {name} < 0)")
    return F.expr(" OR ".join(f"({condition})" for condition in bad))


def invalid_ohlc() -> Column:
    """High below or low above another price of the candle."""
    return F.expr(_BROKEN_SHAPE)


def volume_flags(tolerance: float) -> dict[str, Column]:
    """Six ways in which volume, quote volume, price band and taker volume disagree."""
    volume, quote = positive_sql("volume"), positive_sql("quote_volume")
    low, high = f"(1 - {tolerance}D)", f"(1 + {tolerance}D)"
    rules = {
        "positive_volume_zero_quote": f"{volume} AND coalesce(quote_volume = 0, false)",
        "positive_quote_zero_volume": f"{quote} AND coalesce(volume = 0, false)",
        "zero_trades_positive_volume": f"coalesce(trades_count = 0, false) AND ({volume} OR {quote})",
        "quote_volume_price_band": f"{volume} AND {quote} AND {positive_sql('low')} "
        f"AND {finite_sql('high')} AND high >= low AND (quote_volume < low * volume * {low} "
        f"OR quote_volume > high * volume * {high})",
        "taker_base_exceeds_volume": f"{finite_sql('taker_buy_base_volume')} "
        f"AND {finite_sql('volume')} AND taker_buy_base_volume > volume * {high}",
        "taker_quote_exceeds_quote_volume": f"{finite_sql('taker_buy_quote_volume')} "
        f"AND {finite_sql('quote_volume')} AND taker_buy_quote_volume > quote_volume * {high}",
    }
    return {name: F.expr(rule) for name, rule in rules.items()}


def is_stale() -> Column:
    """Flat candle without any trading."""
    return F.expr(
        " AND ".join(finite_sql(name) for name in _PRICES)
        + " AND open = high AND high = low AND low = close AND coalesce(volume = 0, false)"
        + " AND coalesce(quote_volume = 0, false) AND coalesce(trades_count, 0) = 0"
    )


def candle_flags(df: DataFrame, config: specs.AuditConfig | None = None) -> DataFrame:
    """Add every row-level measure and flag to candles."""
    config = config or specs.AuditConfig()
    tolerance = config.timestamp_alignment_tolerance_seconds
    shares = {
        "range_pct": "(high - low) / close",
        "upper_wick_pct": "(high - greatest(open, close)) / close",
        "lower_wick_pct": "(least(open, close) - low) / close",
    }
    side = config.wick_side_pct_warn
    checked_step = F.expr(f"if(expected_seconds <= {specs.DAY_SECONDS}, expected_seconds, NULL)")
    return (
        df.withColumns(
            {
                "expected_seconds": cadence_seconds("interval"),
                "invalid_values": invalid_values(),
                "invalid_ohlc": invalid_ohlc(),
                **volume_flags(config.quote_volume_price_band_tolerance),
                **{n: F.expr(f"if({_WELL_FORMED}, {share}, NULL)") for n, share in shares.items()},
                "is_stale": is_stale(),
            }
        )
        .withColumn("_offset", epoch_seconds_rounded("timestamp") % checked_step)
        .withColumns(
            {
                "timestamp_distance_seconds": F.expr("least(_offset, expected_seconds - _offset)"),
                "timestamp_alignment": F.expr(
                    f"coalesce(_offset > {tolerance} AND expected_seconds - _offset > {tolerance}, false)"
                ),
                "volume_price_inconsistency": F.expr(" OR ".join(VOLUME_FLAGS)),
                "wick_outliers": F.expr(
                    f"coalesce(range_pct > {config.wick_range_pct_warn}D OR upper_wick_pct > {side}D "
                    f"OR lower_wick_pct > {side}D, false)"
                ),
            }
        )
        .drop("_offset")
    )


def row_level_totals(df: DataFrame, config: specs.AuditConfig | None = None) -> DataFrame:
    """All single-row checks of a table in one scan and one small shuffle."""
    totals = []
    for flag in ROW_CHECKS:
        totals += [
            f"count_if({flag}) AS {flag}_count",
            f"min(if({flag}, timestamp, NULL)) AS {flag}_first",
            f"max(if({flag}, timestamp, NULL)) AS {flag}_last",
        ]
    totals += [f"count_if({name}) AS {name}_count" for name in VOLUME_FLAGS]
    totals.append(
        "max(if(timestamp_alignment, timestamp_distance_seconds, NULL)) AS max_distance_seconds"
    )
    totals += [
        f"max(if(wick_outliers, {share}, NULL)) AS max_{share}"
        for share in ("range_pct", "upper_wick_pct", "lower_wick_pct")
    ]
    return candle_flags(df, config).groupBy(*REPORT).agg(*[F.expr(total) for total in totals])


def _row_check(totals: DataFrame, flag: str, extras: Sequence[str] = ()) -> DataFrame:
    return totals.where(F.col(f"{flag}_count") > 0).select(
        *REPORT,
        F.col(f"{flag}_count").alias("bad_count"),
        F.col(f"{flag}_first").alias("first_timestamp"),
        F.col(f"{flag}_last").alias("last_timestamp"),
        *extras,
    )


def row_check(df: DataFrame, flag: str, config: specs.AuditConfig | None = None) -> DataFrame:
    """Typed rows of one single-row check; see ``ROW_CHECKS`` for the names."""
    return _row_check(row_level_totals(df, config), flag, ROW_CHECKS[flag][2])


# ---------------------------------------------------------------------------
# Key checks over distinct timestamps; gaps are those of one exchange
# ---------------------------------------------------------------------------
def duplicate_keys(df: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """Surplus rows per series on the primary key."""
    report = [key for key in keys if key != "exchange"]
    return (
        distinct_times(df, keys)
        .where(F.col("copies") > 1)
        .groupBy(*report)
        .agg(
            F.sum(F.col("copies") - 1).alias("bad_count"),
            F.min("timestamp").alias("first_timestamp"),
            F.max("timestamp").alias("last_timestamp"),
            F.max("copies").alias("max_occurrences"),
        )
    )


def time_gaps(
    df: DataFrame, keys: Sequence[str] = SERIES, expected: Column | None = None
) -> DataFrame:
    """Gaps per series with the largest distance."""
    report = [key for key in keys if key != "exchange"]
    expected = cadence_seconds("interval") if expected is None else expected
    rows = scan(df, exchange=specs.EXCHANGE)
    return (
        gaps_between(distinct_times(rows, keys), keys, expected)
        .groupBy(*report)
        .agg(
            F.count("*").alias("bad_count"),
            F.min("timestamp").alias("first_timestamp"),
            F.max("timestamp").alias("last_timestamp"),
            F.max(seconds_between("prev_timestamp", "timestamp")).alias("max_delta_seconds"),
            F.max("expected_seconds").alias("expected_seconds"),
        )
    )


# ---------------------------------------------------------------------------
# Change-based checks
# ---------------------------------------------------------------------------
def changes_of(
    df: DataFrame, value: str, keys: Sequence[str], step: Column
) -> DataFrame:
    """Step-to-step ratios of a positive value over valid rows only.

    Copies of a row are collapsed first; the ``weight - 1`` repeats of a copied row have the
    ratio one and are kept as one weighted row, so no row is lost and none is sorted twice.
    """
    collapsed = (
        df.where(positive(value))
        .groupBy(*keys, "timestamp", value)
        .agg(F.count("*").alias("copies"))
        .withColumn("_step", step)
    )
    ordered = with_previous(
        collapsed,
        keys,
        ["timestamp", value],
        [value],
        time_slice("timestamp", F.col("_step")),
    )
    ratio = F.col(value) / F.col(f"prev_{value}")
    return (
        ordered.withColumn(
            "_pair",
            F.explode(
                F.array(
                    F.struct(ratio.alias("ratio"), F.lit(1).cast("bigint").alias("weight")),
                    F.struct(F.lit(1.0).alias("ratio"), (F.col("copies") - 1).alias("weight")),
                )
            ),
        )
        .where(F.col("_pair.ratio").isNotNull() & (F.col("_pair.weight") > 0))
        .select(
            *keys,
            "timestamp",
            (F.col("_pair.ratio") - 1).alias("relative_return"),
            F.ln("_pair.ratio").alias("log_return"),
            F.col("_pair.weight").alias("weight"),
        )
    )


def close_returns(df: DataFrame) -> DataFrame:
    return changes_of(df, "close", SERIES, cadence_seconds("interval"))


def weighted_moments(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """n, mean and sample deviation where rows of weight above one all carry zero."""
    single = F.col("weight") == 1
    parts = rows.groupBy(*keys).agg(
        F.count_if(single).alias("_n1"),
        F.coalesce(F.avg(F.when(single, F.col(value))), F.lit(0.0)).alias("_mean1"),
        F.coalesce(F.var_samp(F.when(single, F.col(value))), F.lit(0.0)).alias("_var1"),
        F.coalesce(F.sum(F.when(~single, F.col("weight"))), F.lit(0)).alias("_n0"),
    )
    n = F.col("_n1") + F.col("_n0")
    spread = F.col("_var1") * (F.col("_n1") - 1) + F.col("_mean1") * F.col("_mean1") * (
        F.col("_n1") * F.col("_n0") / n
    )
    return parts.select(
        *keys,
        n.alias("n"),
        (F.col("_mean1") * F.col("_n1") / n).alias("mean"),
        F.when(n > 1, F.sqrt(spread / (n - 1))).alias("std"),
    )


def return_outliers(
    df: DataFrame, config: specs.AuditConfig | None = None, returns: DataFrame | None = None
) -> DataFrame:
    """Log returns further than ``price_return_sigma`` deviations from the series mean.

    The returns are stored once, narrow: the moments and the comparison read them.
    """
    config = config or specs.AuditConfig()
    if returns is None:
        returns = materialise(close_returns(df), "close-returns")
    stats = weighted_moments(returns, REPORT, "log_return").where(
        (F.col("n") >= config.min_outlier_observations) & (F.col("std") > 0)
    )
    far = F.abs(F.col("log_return") - F.col("mean")) > config.price_return_sigma * F.col("std")
    return (
        join_group_stats(returns, stats, REPORT, ["timestamp"], size="n")
        .where(far)
        .groupBy(*REPORT)
        .agg(
            F.sum("weight").alias("bad_count"),
            F.min("timestamp").alias("first_timestamp"),
            F.max("timestamp").alias("last_timestamp"),
            F.max(F.abs("log_return")).alias("max_abs_log_return"),
        )
    )


def with_robust_stats(rows: DataFrame, returns: DataFrame, how: str = "inner") -> DataFrame:
    """Add each series' number of log returns, their median and the median distance from it."""
    medians = quantiles(returns, REPORT, "log_return", {"median": 0.5}, "weight")
    deviations = join_group_stats(returns, medians, REPORT, ["timestamp"], size="n").withColumn(
        "abs_deviation", F.abs(F.col("log_return") - F.col("median"))
    )
    mads = quantiles(deviations.drop("n"), REPORT, "abs_deviation", {"mad": 0.5}, "weight")
    found = join_group_stats(rows, medians, REPORT, ["timestamp"], how, size="n").drop("n")
    return join_group_stats(found, mads, REPORT, ["timestamp"], how, size="n")


def is_robust_jump(config: specs.AuditConfig) -> Column:
    """Relative jump that is also far out in units of the series' own median deviation."""
    limit = config.price_jump_mad_multiplier * MAD_SCALE * F.col("mad")
    distance = F.abs(F.col("log_return") - F.col("median"))
    return (
        (F.col("n") >= config.min_outlier_observations)
        & (F.abs("relative_return") > config.price_jump_abs_return_warn)
        & (
            ((F.col("mad") > 0) & (distance > limit))
            | ((F.col("mad") == 0) & (distance > 0))
        )
    )


def robust_jumps(
    df: DataFrame,
    config: specs.AuditConfig | None = None,
    returns: DataFrame | None = None,
) -> DataFrame:
    """Price jumps judged by the median absolute deviation of the series' log returns.

    The returns are stored once, narrow, since the quantiles read them repeatedly.
    """
    config = config or specs.AuditConfig()
    if returns is None:
        returns = materialise(close_returns(df), "close-returns")
    return (
        with_robust_stats(returns, returns)
        .where(is_robust_jump(config))
        .groupBy(*REPORT)
        .agg(
            F.sum("weight").alias("bad_count"),
            F.min("timestamp").alias("first_timestamp"),
            F.max("timestamp").alias("last_timestamp"),
            F.max(F.abs("relative_return")).alias("max_abs_relative_return"),
            F.max(F.abs("log_return")).alias("max_abs_log_return"),
        )
    )


def with_volume_bounds(rows: DataFrame, volumes: DataFrame, config: specs.AuditConfig, how: str = "inner") -> DataFrame:
    """Add the accepted volume range per series, NULL unless the quartiles carry information."""
    iqr = F.col("q3") - F.col("q1")
    margin = config.volume_iqr_multiplier * iqr
    told = (F.col("n") >= config.min_outlier_observations) & (iqr > 0)
    quartiles = quantiles(volumes, REPORT, "volume", {"q1": 0.25, "q3": 0.75})
    return (
        join_group_stats(rows, quartiles, REPORT, ["timestamp"], how, size="n")
        .withColumns(
            {
                "volume_floor": F.when(told, F.col("q1") - margin),
                "volume_ceiling": F.when(told, F.col("q3") + margin),
            }
        )
        .drop("n", "q1", "q3")
    )


def volume_outliers(df: DataFrame, config: specs.AuditConfig | None = None) -> DataFrame:
    config = config or specs.AuditConfig()
    # Stored once, narrow: the quartiles and the comparison below read them.
    rows = materialise(df.where(positive("volume")).select(*REPORT, "timestamp", "volume"), "volumes")
    outside = (F.col("volume") < F.col("volume_floor")) | (
        F.col("volume") > F.col("volume_ceiling")
    )
    return (
        with_volume_bounds(rows, rows, config)
        .where(outside)
        .groupBy(*REPORT)
        .agg(
            F.count("*").alias("bad_count"),
            F.min("timestamp").alias("first_timestamp"),
            F.max("timestamp").alias("last_timestamp"),
            F.max("volume").alias("max_volume"),
        )
    )


# ---------------------------------------------------------------------------
# Stale runs
# ---------------------------------------------------------------------------
def stale_runs(df: DataFrame, config: specs.AuditConfig | None = None) -> DataFrame:
    """Long runs of flat, inactive candles exactly one step apart; one row per run.

    A timestamp stored twice breaks a run: its first copy ends one, its last copy starts the
    next, copies in between stand alone.
    """
    config = config or specs.AuditConfig()
    judged = df if "is_stale" in df.columns else df.withColumn("is_stale", is_stale())
    rows = (
        judged.withColumn("expected_seconds", cadence_seconds("interval"))
        .where(F.col("expected_seconds").isNotNull())
        .groupBy(*REPORT, "expected_seconds", "timestamp", "is_stale")
        .agg(F.count("*").alias("copies"))
    )
    parts = F.when(F.col("copies") > 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    step = F.col("expected_seconds")
    runs = runs_of(
        rows.withColumn("opens_on_copy", F.explode(parts)),
        [*REPORT, "expected_seconds"],
        ["timestamp", "is_stale", "opens_on_copy"],
        "is_stale",
        step,
        time_slice("timestamp", step),
        ["opens_on_copy"],
    ).withColumn("runs", F.lit(1).cast("bigint"))
    alone = rows.where(F.col("is_stale") & (F.col("copies") > 2)).select(
        *REPORT,
        "expected_seconds",
        F.col("timestamp").alias("first_timestamp"),
        F.col("timestamp").alias("last_timestamp"),
        F.lit(1).cast("bigint").alias("observations"),
        F.lit(1).alias("opens_on_copy"),
        (F.col("copies") - 2).alias("runs"),
    )
    duration = seconds_between("first_timestamp", "last_timestamp") + F.col("expected_seconds")
    return (
        runs.unionByName(alone)
        .withColumn("duration_seconds", duration)
        .where(
            (F.col("observations") >= config.stale_run_min_observations)
            & (F.col("duration_seconds") >= config.stale_run_min_duration_seconds)
        )
    )


def stale_price_runs(df: DataFrame, config: specs.AuditConfig | None = None) -> DataFrame:
    return (
        stale_runs(df, config)
        .groupBy(*REPORT)
        .agg(
            F.sum("runs").alias("bad_count"),
            F.min("first_timestamp").alias("first_timestamp"),
            F.max("last_timestamp").alias("last_timestamp"),
            F.max("observations").alias("max_observations"),
            F.max("duration_seconds").alias("max_duration_seconds"),
        )
    )


# ---------------------------------------------------------------------------
# Findings
# ---------------------------------------------------------------------------
def gap_message() -> Column:
    return F.concat(
        F.col("bad_count").cast("string"),
        F.lit(" gaps detected; max gap "),
        interval_label(F.col("max_delta_seconds")),
        F.lit(" vs expected "),
        interval_label(F.col("expected_seconds")),
    )


# flag: (severity, message, metadata columns). The texts are fixed values of the report.
ROW_CHECKS = {
    "timestamp_alignment": (
        "WARN",
        "kline timestamps are not aligned to their interval boundary",
        ["max_distance_seconds"],
    ),
    "invalid_values": (
        "ERROR",
        "rows contain null, infinite, or out-of-range values",
        [],
    ),
    "invalid_ohlc": ("ERROR", "rows violate OHLC relationships", []),
    "volume_price_inconsistency": (
        "WARN",
        "rows have inconsistent volume, quote volume, or taker volume",
        [f"{name}_count" for name in VOLUME_FLAGS],
    ),
    "wick_outliers": (
        "WARN",
        "candles have unusually large range or wick",
        ["max_range_pct", "max_upper_wick_pct", "max_lower_wick_pct"],
    ),
}


def row_level_findings(totals: DataFrame, table: str) -> DataFrame:
    """Unpivot the shared totals into findings: five checks, one scan."""
    lines = [
        F.struct(
            F.lit(severity).alias("severity"),
            F.lit(table).alias("table"),
            F.lit(flag).alias("check_name"),
            F.concat(F.col(f"{flag}_count").cast("string"), F.lit(f" {text}")).alias("message"),
            F.col(f"{flag}_count").alias("count"),
            F.col("symbol"),
            F.col("interval"),
            F.col(f"{flag}_first").cast("timestamp_ntz").alias("first_timestamp"),
            F.col(f"{flag}_last").cast("timestamp_ntz").alias("last_timestamp"),
            (F.to_json(F.struct(*extras)) if extras else F.lit("{}")).alias("metadata"),
        )
        for flag, (severity, text, extras) in ROW_CHECKS.items()
    ]
    return totals.select(F.inline(F.array(*lines))).where(F.col("count") > 0)


def audit_candles(
    df: DataFrame,
    table: str = "spot",
    config: specs.AuditConfig | None = None,
    symbols: Sequence[str] | None = None,
    intervals: Sequence[str] | None = None,
) -> DataFrame:
    """Findings of all candle checks for one table.

    The table is read twice: for the single-row checks, which need all of its columns, and for the
    few columns that the ordered and statistical checks share, which are stored.
    """
    config = config or specs.AuditConfig()
    table_rows = scan(df, symbols, intervals)
    rows = materialise(table_rows.select(*SERIES, "timestamp", "close", "volume", is_stale().alias("is_stale")), "audit-rows")
    # Ordered once and stored narrow; the two return checks read them.
    returns = materialise(close_returns(rows), "close-returns")
    limits = {
        "absolute_return_threshold": F.lit(config.price_jump_abs_return_warn),
        "mad_multiplier": F.lit(config.price_jump_mad_multiplier),
        "min_observations": F.lit(config.stale_run_min_observations),
        "min_duration_seconds": F.lit(config.stale_run_min_duration_seconds),
    }
    parts = [
        to_findings(
            duplicate_keys(rows),
            table,
            "duplicate_primary_key",
            "ERROR",
            counted("duplicate rows on primary key"),
            ["max_occurrences"],
        ),
        to_findings(
            time_gaps(rows),
            table,
            "time_gaps",
            "ERROR",
            gap_message(),
            ["max_delta_seconds", "expected_seconds"],
        ),
        row_level_findings(row_level_totals(table_rows, config), table),
        to_findings(
            return_outliers(rows, config, returns),
            table,
            "price_return_outliers",
            "WARN",
            counted("extreme log-return outliers detected"),
            ["max_abs_log_return"],
        ),
        to_findings(
            robust_jumps(rows, config, returns).withColumns(
                {k: limits[k] for k in ("absolute_return_threshold", "mad_multiplier")}
            ),
            table,
            "robust_price_jumps",
            "WARN",
            counted("robust price jump outliers detected"),
            [
                "max_abs_relative_return",
                "max_abs_log_return",
                "absolute_return_threshold",
                "mad_multiplier",
            ],
        ),
        to_findings(
            volume_outliers(rows, config),
            table,
            "volume_outliers",
            "WARN",
            counted("volume outliers detected by IQR"),
            ["max_volume"],
        ),
        to_findings(
            stale_price_runs(rows, config).withColumns(
                {k: limits[k] for k in ("min_observations", "min_duration_seconds")}
            ),
            table,
            "stale_price_runs",
            "WARN",
            counted("long flat inactive price runs detected"),
            ["max_observations", "max_duration_seconds", "min_observations", "min_duration_seconds"],
        ),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
