"""Row-level diagnostics: every flag of every candle, and the list of anomalous rows.

Copies of a candle are one output row with ``copies`` set; the repeats of a copied row
(distance zero, return zero) come as one more row flagged ``repeat``. Summed by ``copies`` the
flags give exactly the totals of the audit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import specs
from tidemark.functions.ordered import time_slice, with_trailing
from tidemark.functions.quantiles import join_group_stats
from tidemark.functions.scalars import holds, positive, seconds_between
from tidemark.operators.audit_candles import (
    MAD_SCALE,
    REPORT,
    SERIES,
    VOLUME_FLAGS,
    candle_flags,
    stale_runs,
    weighted_moments,
    with_robust_stats,
    with_volume_bounds,
)
from tidemark.session import materialise


def candle_diagnostics(df: DataFrame, config: specs.AuditConfig | None = None) -> DataFrame:
    """Candles with previous time, distance, returns, shape, alignment and all outlier flags."""
    config = config or specs.AuditConfig()
    columns = specs.CANDLE_SCHEMA.fieldNames()
    distinct = df.select(*columns).groupBy(*columns).agg(F.count("*").alias("copies"))
    flagged = candle_flags(distinct, config)
    order = ["timestamp", "close", *[c for c in columns if c not in (*SERIES, "timestamp", "close")]]
    # Previous valid close: the last one among the preceding rows, however far back.
    ordered = _with_previous_valid(
        flagged, order, time_slice("timestamp", F.col("expected_seconds"))
    )
    first = F.struct(F.col("prev_timestamp"), F.col("prev_close"), F.lit(1).cast("bigint").alias("copies"), F.lit(False).alias("repeat"))
    again = F.struct(
        F.col("timestamp").alias("prev_timestamp"),
        F.when(positive("close"), F.col("close")).alias("prev_close"),
        (F.col("copies") - 1).alias("copies"),
        F.lit(True).alias("repeat"),
    )
    kinds = F.when(F.col("copies") > 1, F.array(first, again)).otherwise(F.array(first))
    rows = (
        ordered.withColumn("_kind", F.explode(kinds))
        .drop("prev_timestamp", "prev_close", "copies")
        .select("*", "_kind.*")
        .drop("_kind")
    )
    ratio = F.when(
        positive("close") & (F.col("prev_close") > 0), F.col("close") / F.col("prev_close")
    )
    rows = rows.withColumns(
        {
            "delta_seconds": seconds_between("prev_timestamp", "timestamp"),
            "relative_return": ratio - 1,
            "log_return": F.ln(ratio),
            "is_up": F.col("close") >= F.col("open"),
            "body_top": F.greatest("open", "close"),
            "body_bottom": F.least("open", "close"),
            "quote_price": F.when(
                F.col("volume") > 0, F.col("quote_volume") / F.col("volume")
            ),
        }
    ).withColumn(
        "time_gaps",
        holds((F.col("delta_seconds") > F.col("expected_seconds")) & (F.col("exchange") == specs.EXCHANGE)),
    )
    # Stored once: the statistics below read the ordered rows several times.
    rows = materialise(rows, "candle-diagnostics")
    with_stats = _with_return_stats(rows, df, config)
    return _with_stale_runs(with_stats, df, config)


def _with_previous_valid(rows: DataFrame, order: list[str], slices: Column) -> DataFrame:
    """Previous row's time over all rows, previous close over valid rows only.

    Valid and other rows are ordered apart, so that the close looks back exactly one row.
    """
    valid = positive("close")
    outputs = {
        "prev_timestamp": lambda w: F.lag("timestamp").over(w),
    }
    timed = with_trailing(rows, SERIES, order, 1, outputs, slices)
    closes = with_trailing(
        timed.withColumn("_valid", valid),
        [*SERIES, "_valid"],
        order,
        1,
        {"prev_close": lambda w: F.lag("close").over(w)},
        slices,
    )
    return closes.withColumn(
        "prev_close", F.when(F.col("_valid"), F.col("prev_close"))
    ).drop("_valid")


def _with_return_stats(
    rows: DataFrame, df: DataFrame, config: specs.AuditConfig
) -> DataFrame:
    returns = rows.where(F.col("log_return").isNotNull()).select(
        *REPORT, "timestamp", "log_return", F.col("copies").alias("weight")
    )
    moments = weighted_moments(returns, REPORT, "log_return").withColumnRenamed("n", "n_returns")
    found = join_group_stats(rows, moments, REPORT, ["timestamp"], "left", size="n_returns")
    found = with_robust_stats(found, returns, "left").drop("n")
    found = with_volume_bounds(found, df.where(positive("volume")), config, "left")
    far = F.abs(F.col("log_return") - F.col("mean")) > config.price_return_sigma * F.col("std")
    enough = F.col("n_returns") >= config.min_outlier_observations
    distance = F.abs(F.col("log_return") - F.col("median"))
    robust = (
        (F.col("mad") > 0)
        & (distance > config.price_jump_mad_multiplier * MAD_SCALE * F.col("mad"))
    ) | ((F.col("mad") == 0) & (distance > 0))
    return (
        found.withColumns(
            {
                "price_return_outliers": holds(enough & (F.col("std") > 0) & far),
                "robust_price_jumps": holds(
                    enough
                    & (F.abs("relative_return") > config.price_jump_abs_return_warn)
                    & robust
                ),
                "volume_outliers": positive("volume")
                & holds(
                    (F.col("volume") < F.col("volume_floor"))
                    | (F.col("volume") > F.col("volume_ceiling"))
                ),
            }
        )
        .drop("n_returns", "mean", "std", "median", "mad", "volume_floor", "volume_ceiling")
    )


def _with_stale_runs(
    rows: DataFrame, df: DataFrame, config: specs.AuditConfig
) -> DataFrame:
    """Mark rows of long stale runs: runs meet rows on (series, time slice)."""
    steps = 256
    width = F.col("expected_seconds") * steps

    def at(ts: str) -> Column:
        return F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / width).cast("bigint")

    runs = stale_runs(df, config).select(
        *REPORT,
        F.col("first_timestamp").alias("stale_start"),
        F.col("last_timestamp").alias("stale_end"),
        (F.col("opens_on_copy") == 1).alias("_on_copy"),
        F.explode(F.sequence(at("first_timestamp"), at("last_timestamp"))).alias("_slice"),
    )
    sliced = rows.withColumn("_slice", at("timestamp"))
    # A run opened by the last copy of a timestamp owns the repeat row there, not the first.
    at_start = F.col("timestamp") == F.col("stale_start")
    inside = (
        F.col("is_stale")
        & (F.col("timestamp") >= F.col("stale_start"))
        & (F.col("timestamp") <= F.col("stale_end"))
        & (F.col("repeat") == (F.col("_on_copy") & at_start))
    )
    left, right = sliced.alias("l"), runs.alias("r")
    same = (
        (F.col("l.symbol") == F.col("r.symbol"))
        & (F.col("l.interval") == F.col("r.interval"))
        & (F.col("l._slice") == F.col("r._slice"))
    )
    joined = left.join(right, same & inside, "left").select(
        "l.*", "r.stale_start", "r.stale_end"
    )
    return joined.withColumn("stale_price_runs", F.col("stale_start").isNotNull()).drop("_slice")


def funding_diagnostics(df: DataFrame, config: specs.AuditConfig | None = None) -> DataFrame:
    """Funding rows with the distance to the previous one, gap and extreme flags."""
    config = config or specs.AuditConfig()
    keys = ["exchange", "symbol"]
    rows = df.groupBy(*keys, "timestamp", "funding_rate").agg(F.count("*").alias("copies"))
    ordered = with_trailing(
        rows,
        keys,
        ["timestamp", "funding_rate"],
        1,
        {"prev_timestamp": lambda w: F.lag("timestamp").over(w)},
        time_slice("timestamp", specs.FUNDING_SECONDS),
    )
    delta = seconds_between("prev_timestamp", "timestamp")
    return ordered.withColumns(
        {
            "delta_seconds": delta,
            "time_gaps": holds(delta > specs.FUNDING_SECONDS),
            "funding_rate_extremes": holds(F.abs("funding_rate") > config.funding_rate_abs_warn),
        }
    )


ANOMALY_COLUMNS = (
    "severity",
    "table",
    "symbol",
    "interval",
    "check_name",
    "timestamp",
    "end_timestamp",
    "prev_timestamp",
    "close",
    "marker_y",
    "value",
    "detail",
)


def _percent(value: str) -> Column:
    return F.format_string("%.2f%%", F.col(value) * 100)


def _point(check: str, value: Column, detail: Column, marker: str = "close") -> Column:
    return F.struct(
        F.lit(check).alias("check_name"),
        F.col(marker).alias("marker_y"),
        value.cast("double").alias("value"),
        detail.alias("detail"),
    )


def _hours(seconds: Column) -> Column:
    return F.format_string("%.2f", seconds / 3_600)


def candle_anomalies(
    diagnostics: DataFrame, findings: DataFrame, table: str
) -> DataFrame:
    """One row per flagged candle and check, one per stale run, and report findings without rows."""
    diagnostics = materialise(diagnostics, "diagnostics")
    flags = F.concat_ws(", ", *[F.when(F.col(name), F.lit(name)) for name in VOLUME_FLAGS])
    points = {
        "time_gaps": _point(
            "time_gaps",
            F.col("delta_seconds"),
            F.concat(
                F.lit("gap="),
                _hours(F.col("delta_seconds")),
                F.lit("h expected="),
                _hours(F.col("expected_seconds")),
                F.lit("h"),
            ),
        ),
        "timestamp_alignment": _point(
            "timestamp_alignment",
            F.col("timestamp_distance_seconds"),
            F.concat(
                F.lit("distance="), F.col("timestamp_distance_seconds").cast("string"), F.lit("s")
            ),
        ),
        "volume_price_inconsistency": _point(
            "volume_price_inconsistency", F.col("quote_price"), flags
        ),
        "price_return_outliers": _point(
            "price_return_outliers",
            F.col("log_return"),
            F.format_string("log_return=%.4f", F.col("log_return")),
        ),
        "robust_price_jumps": _point(
            "robust_price_jumps",
            F.col("relative_return"),
            F.concat(F.lit("relative_return="), _percent("relative_return")),
        ),
        "wick_outliers": _point(
            "wick_outliers",
            F.col("range_pct"),
            F.concat(
                F.lit("range="),
                _percent("range_pct"),
                F.lit(", upper="),
                _percent("upper_wick_pct"),
                F.lit(", lower="),
                _percent("lower_wick_pct"),
            ),
            "high",
        ),
        "volume_outliers": _point(
            "volume_outliers",
            F.col("volume"),
            F.concat(F.lit("volume="), F.col("volume").cast("string")),
        ),
    }
    hits = F.filter(
        F.array(*[F.when(F.col(flag), point) for flag, point in points.items()]),
        lambda p: p.isNotNull(),
    )
    single = diagnostics.withColumn("_p", F.explode(hits)).select(
        "symbol",
        "interval",
        "_p.check_name",
        "timestamp",
        F.col("timestamp").alias("end_timestamp"),
        "prev_timestamp",
        "close",
        "_p.marker_y",
        "_p.value",
        "_p.detail",
    )
    runs = (
        diagnostics.where("stale_price_runs")
        .groupBy("symbol", "interval", "stale_start", "stale_end")
        .agg(
            F.min_by("close", "timestamp").alias("close"),
            F.sum("copies").alias("_n"),
        )
        .select(
            "symbol",
            "interval",
            F.lit("stale_price_runs").alias("check_name"),
            F.col("stale_start").alias("timestamp"),
            F.col("stale_end").alias("end_timestamp"),
            F.lit(None).cast("timestamp_ntz").alias("prev_timestamp"),
            "close",
            F.col("close").alias("marker_y"),
            F.col("_n").cast("double").alias("value"),
            F.concat(F.lit("observations="), F.col("_n").cast("string")).alias("detail"),
        )
    )
    return _with_report(single.unionByName(runs), findings, table)


def funding_anomalies(diagnostics: DataFrame, findings: DataFrame) -> DataFrame:
    """One row per flagged funding rate and check, and report findings without rows."""
    points = {
        "time_gaps": _point(
            "time_gaps",
            F.col("delta_seconds"),
            F.concat(F.lit("gap="), _hours(F.col("delta_seconds")), F.lit("h expected=8.00h")),
            "funding_rate",
        ),
        "funding_rate_extremes": _point(
            "funding_rate_extremes",
            F.col("funding_rate"),
            F.format_string("funding_rate=%.6f", F.col("funding_rate")),
            "funding_rate",
        ),
    }
    hits = F.filter(
        F.array(*[F.when(F.col(flag), point) for flag, point in points.items()]),
        lambda p: p.isNotNull(),
    )
    rows = diagnostics.withColumn("_p", F.explode(hits)).select(
        "symbol",
        F.lit(None).cast("string").alias("interval"),
        "_p.check_name",
        "timestamp",
        F.col("timestamp").alias("end_timestamp"),
        "prev_timestamp",
        F.col("funding_rate").alias("close"),
        "_p.marker_y",
        "_p.value",
        "_p.detail",
    )
    return _with_report(rows, findings, "funding_rates")


def _with_report(rows: DataFrame, findings: DataFrame, table: str) -> DataFrame:
    """Take severities from the report and add its findings that no row stands for."""
    scope = ["symbol", "check_name"]
    rows, findings = materialise(rows, "anomaly-rows"), materialise(findings, "findings")
    own = findings.where((F.col("table") == table) & F.col("symbol").isNotNull())
    errors = (
        own.where(F.col("severity") == "ERROR")
        .select("symbol", "check_name", F.col("interval").alias("_scope"))
        .distinct()
    )
    # A finding without interval speaks for every interval of its symbol.
    anywhere = errors.where(F.col("_scope").isNull()).select(*scope, F.lit(True).alias("_any"))
    exact = errors.where(F.col("_scope").isNotNull()).select(
        *scope, F.col("_scope").alias("interval"), F.lit(True).alias("_same")
    )
    keyed = rows.withColumn("_interval", F.coalesce("interval", F.lit("")))
    exact = exact.withColumn("_interval", F.coalesce("interval", F.lit(""))).drop("interval")
    rated = (
        keyed.join(anywhere, scope, "left")
        .join(exact, [*scope, "_interval"], "left")
        .withColumn(
            "severity",
            F.when(F.coalesce("_any", "_same", F.lit(False)), "ERROR").otherwise("WARN"),
        )
    )
    shown = keyed.select(*scope, "_interval").distinct()
    unshown = (
        own.withColumn("_interval", F.coalesce("interval", F.lit("")))
        .join(shown, [*scope, "_interval"], "left_anti")
        .select(
            "severity",
            "table",
            "symbol",
            "interval",
            "check_name",
            F.col("first_timestamp").alias("timestamp"),
            F.col("last_timestamp").alias("end_timestamp"),
            F.lit(None).cast("timestamp_ntz").alias("prev_timestamp"),
            F.lit(None).cast("double").alias("close"),
            F.lit(None).cast("double").alias("marker_y"),
            F.col("count").cast("double").alias("value"),
            F.col("message").alias("detail"),
        )
    )
    return (
        rated.withColumn("table", F.lit(table))
        .select(*ANOMALY_COLUMNS)
        .unionByName(unshown.select(*ANOMALY_COLUMNS))
    )
