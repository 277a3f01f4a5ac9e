"""Queries over the quality checks, the diagnostics and the validation contracts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import audit_candles as ac
from tidemark.operators import audit_metrics as am
from tidemark.operators import audit_universe as au
from tidemark.operators import diagnostics as dg
from tidemark.operators import findings as fd
from tidemark.operators import validate as va
from tidemark.plans import views
from tidemark.plans.query import Registry, rounded
from tidemark.plans.view_sql import with_views
from tidemark.session import materialise
from tidemark.specs import AuditConfig

REGISTRY = Registry()
add = REGISTRY.add

# Sensitive enough to find something in the derived views.
CONFIG = AuditConfig(price_return_sigma=4.0)
UNIVERSE_CONFIG = AuditConfig(universe_frequency="monthly", universe_top_n=20)

SPAN = 'min("timestamp") AS first_timestamp, max("timestamp") AS last_timestamp'
FINITE = "(NOT isnan({0}) AND NOT isinf({0}))"


def fin(name: str) -> str:
    return f"({name} IS NOT NULL AND NOT isnan({name}) AND NOT isinf({name}))"


def pos(name: str) -> str:
    return f"({fin(name)} AND {name} > 0)"


# ---------------------------------------------------------------------------
# Candle checks
# ---------------------------------------------------------------------------
DUPLICATES_SQL = """
SELECT symbol, "interval", CAST(sum(n - 1) AS BIGINT) AS bad_count,
       min("timestamp") AS first_timestamp, max("timestamp") AS last_timestamp,
       max(n) AS max_occurrences
FROM (SELECT exchange, symbol, "interval", "timestamp", count(*) AS n FROM dirty GROUP BY ALL)
WHERE n > 1 GROUP BY 1, 2
"""


@add("audit_duplicates", with_views(DUPLICATES_SQL, "dirty"))
def audit_duplicates(spark, folder):
    return ac.duplicate_keys(views.dirty_candles(spark, folder))


GAP_ROWS = """
SELECT o.symbol, o."interval", prev, "timestamp", expected_seconds,
       date_diff('second', prev, "timestamp") AS delta
FROM (SELECT *, lag("timestamp") OVER (PARTITION BY exchange, symbol, "interval"
                                       ORDER BY "timestamp") AS prev
      FROM {table} WHERE exchange = 'binance') AS o
JOIN cadence USING ("interval")
WHERE date_diff('second', prev, "timestamp") > expected_seconds
"""
GAPS_SQL = f"""
SELECT symbol, "interval", count(*) AS bad_count, {SPAN}, max(delta) AS max_delta_seconds,
       CAST(max(expected_seconds) AS BIGINT) AS expected_seconds
FROM ({GAP_ROWS.format(table="dirty")}) GROUP BY 1, 2
"""


@add("audit_time_gaps", with_views(GAPS_SQL, "dirty", "cadence"))
def audit_time_gaps(spark, folder):
    return ac.time_gaps(views.dirty_candles(spark, folder))


ALIGNMENT_SQL = f"""
SELECT symbol, "interval", count(*) AS bad_count, {SPAN},
       max(least(off, expected_seconds - off)) AS max_distance_seconds
FROM (SELECT *, CAST(epoch("timestamp") AS BIGINT) % expected_seconds AS off
      FROM dirty JOIN cadence USING ("interval") WHERE expected_seconds <= 86400)
WHERE off > 0 AND expected_seconds - off > 0 GROUP BY 1, 2
"""


@add("audit_alignment", with_views(ALIGNMENT_SQL, "dirty", "cadence"))
def audit_alignment(spark, folder):
    return ac.row_check(views.dirty_candles(spark, folder), "timestamp_alignment")


_PRICES = " OR ".join(f"NOT {pos(c)}" for c in ("open", "high", "low", "close"))
_VOLUMES = " OR ".join(f"NOT {fin(c)} OR {c} < 0" for c in ("volume", "quote_volume"))
_TAKERS = " OR ".join(
    f"({c} IS NOT NULL AND (NOT {fin(c)} OR {c} < 0))"
    for c in ("taker_buy_base_volume", "taker_buy_quote_volume")
)
INVALID = f'"timestamp" IS NULL OR {_PRICES} OR {_VOLUMES} OR trades_count < 0 OR {_TAKERS}'
INVALID_SQL = f"""
SELECT symbol, "interval", count(*) AS bad_count, {SPAN} FROM dirty WHERE {INVALID} GROUP BY 1, 2
"""


@add("audit_invalid_values", with_views(INVALID_SQL, "dirty"))
def audit_invalid_values(spark, folder):
    return ac.row_check(views.dirty_candles(spark, folder), "invalid_values")


BAD_OHLC = "high < low OR high < open OR high < close OR low > open OR low > close"
OHLC_SQL = f"""
SELECT symbol, "interval", count(*) AS bad_count, {SPAN} FROM dirty WHERE {BAD_OHLC} GROUP BY 1, 2
"""


@add("audit_ohlc", with_views(OHLC_SQL, "dirty"))
def audit_ohlc(spark, folder):
    return ac.row_check(views.dirty_candles(spark, folder), "invalid_ohlc")


# Each flag from its rule, over numbers in which everything that is not finite is NULL: NULL makes a
# comparison unknown, and an unknown flag is not raised.
FLAG_INPUTS = ", ".join(
    f"CASE WHEN isfinite({c}) THEN {c} END AS n_{c}"
    for c in ("low", "high", "volume", "quote_volume", "taker_buy_base_volume", "taker_buy_quote_volume")
)
FLAG_SQL = {
    "positive_volume_zero_quote": "n_quote_volume = 0 AND n_volume > 0",
    "positive_quote_zero_volume": "n_volume = 0 AND n_quote_volume > 0",
    "zero_trades_positive_volume": "trades_count = 0 AND greatest(coalesce(n_volume, 0), coalesce(n_quote_volume, 0)) > 0",
    "quote_volume_price_band": "n_low > 0 AND n_low <= n_high AND least(n_volume, n_quote_volume) > 0 "
    "AND n_volume IS NOT NULL AND n_quote_volume IS NOT NULL "
    "AND NOT (n_quote_volume BETWEEN 0.999 * (n_low * n_volume) AND 1.001 * (n_high * n_volume))",
    "taker_base_exceeds_volume": "n_taker_buy_base_volume > 1.001 * n_volume",
    "taker_quote_exceeds_quote_volume": "n_taker_buy_quote_volume > 1.001 * n_quote_volume",
}
FLAGS = ", ".join(f"coalesce({sql}, FALSE) AS {name}" for name, sql in FLAG_SQL.items())
ANY_FLAG = " OR ".join(FLAG_SQL)
FLAG_COUNTS = ", ".join(f"count(*) FILTER (WHERE {n}) AS {n}_count" for n in FLAG_SQL)
VOLUME_PRICE_SQL = f"""
SELECT symbol, "interval", count(*) FILTER (WHERE {ANY_FLAG}) AS bad_count,
       min("timestamp") FILTER (WHERE {ANY_FLAG}) AS first_timestamp,
       max("timestamp") FILTER (WHERE {ANY_FLAG}) AS last_timestamp, {FLAG_COUNTS}
FROM (SELECT *, {FLAGS} FROM (SELECT *, {FLAG_INPUTS} FROM dirty)) GROUP BY 1, 2 HAVING count(*) FILTER (WHERE {ANY_FLAG}) > 0
"""


@add("audit_volume_price", with_views(VOLUME_PRICE_SQL, "dirty"))
def audit_volume_price(spark, folder):
    return ac.row_check(views.dirty_candles(spark, folder), "volume_price_inconsistency")


RETURNS = f"""
SELECT symbol, "interval", "timestamp", close / prev - 1 AS relative_return,
       ln(close / prev) AS log_return
FROM (SELECT *, lag(close) OVER (PARTITION BY exchange, symbol, "interval"
                                 ORDER BY "timestamp", close) AS prev
      FROM dirty WHERE {pos('close')}) WHERE prev > 0
"""
RETURN_STATS = """
SELECT symbol, "interval", count(*) AS n, avg(log_return) AS mean, stddev_samp(log_return) AS std
FROM returns GROUP BY 1, 2
"""
RETURN_OUTLIERS_SQL = f"""
SELECT symbol, "interval", count(*) AS bad_count, {SPAN},
       round(max(abs(log_return)), 6) AS max_abs_log_return
FROM returns JOIN stats USING (symbol, "interval")
WHERE n >= 20 AND std > 0 AND abs(log_return - mean) > 4 * std GROUP BY 1, 2
"""


@add(
    "audit_return_outliers",
    with_views(RETURN_OUTLIERS_SQL, "dirty", extra={"returns": RETURNS, "stats": RETURN_STATS}),
)
def audit_return_outliers(spark, folder):
    found = ac.return_outliers(views.dirty_candles(spark, folder), CONFIG)
    return rounded(found, "max_abs_log_return")


DEVIATIONS = """
SELECT *, abs(log_return - median) AS abs_deviation FROM returns JOIN (
    SELECT symbol, "interval", count(*) AS n, quantile_cont(log_return, 0.5) AS median
    FROM returns GROUP BY 1, 2) USING (symbol, "interval")
"""
MADS = """
SELECT symbol, "interval", quantile_cont(abs_deviation, 0.5) AS mad FROM deviations GROUP BY 1, 2
"""
IS_JUMP = """n >= 20 AND abs(relative_return) > 0.5 AND
    ((mad > 0 AND abs_deviation > 15 * 1.4826 * mad) OR (mad = 0 AND abs_deviation > 0))"""
JUMP_CTES = {"returns": RETURNS, "deviations": DEVIATIONS, "mads": MADS}
ROBUST_SQL = f"""
SELECT symbol, "interval", count(*) AS bad_count, {SPAN},
       round(max(abs(relative_return)), 6) AS max_abs_relative_return,
       round(max(abs(log_return)), 6) AS max_abs_log_return
FROM deviations JOIN mads USING (symbol, "interval") WHERE {IS_JUMP} GROUP BY 1, 2
"""


@add("audit_robust_jumps", with_views(ROBUST_SQL, "dirty", extra=JUMP_CTES))
def audit_robust_jumps(spark, folder):
    found = ac.robust_jumps(views.dirty_candles(spark, folder))
    return rounded(found, "max_abs_relative_return", "max_abs_log_return")


@add("audit_robust_jumps_large_groups", with_views(ROBUST_SQL, "dirty", extra=JUMP_CTES))
def audit_robust_jumps_large_groups(spark, folder):
    """The same check with the returns made by the caller and read by both sides of it."""
    dirty = views.dirty_candles(spark, folder)
    found = ac.robust_jumps(dirty, returns=materialise(ac.close_returns(dirty), "returns"))
    return rounded(found, "max_abs_relative_return", "max_abs_log_return")


WELL_FORMED = f"{' AND '.join(pos(c) for c in ('open', 'high', 'low', 'close'))} AND NOT ({BAD_OHLC})"
SHAPES = f"""
SELECT *, (high - low) / close AS range_pct,
       (high - greatest(open, close)) / close AS upper_wick_pct,
       (least(open, close) - low) / close AS lower_wick_pct FROM dirty WHERE {WELL_FORMED}
"""
WICKS_SQL = f"""
SELECT symbol, "interval", count(*) AS bad_count, {SPAN},
       round(max(range_pct), 6) AS max_range_pct, round(max(upper_wick_pct), 6) AS max_upper_wick_pct,
       round(max(lower_wick_pct), 6) AS max_lower_wick_pct
FROM ({SHAPES}) WHERE range_pct > 1 OR upper_wick_pct > 0.75 OR lower_wick_pct > 0.75 GROUP BY 1, 2
"""


@add("audit_wicks", with_views(WICKS_SQL, "dirty"))
def audit_wicks(spark, folder):
    found = ac.row_check(views.dirty_candles(spark, folder), "wick_outliers")
    return rounded(found, "max_range_pct", "max_upper_wick_pct", "max_lower_wick_pct")


def volume_sql(multiplier: int, least: int = 20) -> str:
    return f"""
SELECT symbol, "interval", count(*) AS bad_count, {SPAN}, max(volume) AS max_volume
FROM dirty JOIN (
    SELECT symbol, "interval", count(*) AS n, quantile_cont(volume, 0.25) AS q1,
           quantile_cont(volume, 0.75) AS q3
    FROM dirty WHERE {pos('volume')} GROUP BY 1, 2) USING (symbol, "interval")
WHERE {pos('volume')} AND n >= {least} AND q3 - q1 > 0
  AND (volume < q1 - {multiplier} * (q3 - q1) OR volume > q3 + {multiplier} * (q3 - q1))
GROUP BY 1, 2
"""


@add("audit_volume_iqr", with_views(volume_sql(20), "dirty"))
def audit_volume_iqr(spark, folder):
    return ac.volume_outliers(views.dirty_candles(spark, folder))


@add("audit_volume_iqr_large_groups", with_views(volume_sql(20), "dirty"))
def audit_volume_iqr_large_groups(spark, folder):
    """The same check over rows dealt out at random, so that every task holds every series."""
    return ac.volume_outliers(views.dirty_candles(spark, folder).repartition(16))


STALE = f"""
SELECT *, ({fin('open')} AND {fin('high')} AND {fin('low')} AND {fin('close')} AND open = high
    AND high = low AND low = close AND {fin('volume')} AND volume = 0 AND {fin('quote_volume')}
    AND quote_volume = 0 AND coalesce(trades_count, 0) = 0) AS is_stale
FROM dirty JOIN cadence USING ("interval")
"""
# Islands: distinct stale times with one offset within the step are consecutive exactly while
# (time / step - place among them) stays the same. The view holds no copies of a stale time.
STALE_RUNS = """
SELECT symbol, "interval", island AS segment, min("timestamp") AS first_timestamp,
       max("timestamp") AS last_timestamp, count(*) AS observations,
       date_diff('second', min("timestamp"), max("timestamp")) + max(expected_seconds) AS duration
FROM (
    SELECT *, sec // expected_seconds - row_number() OVER (
               PARTITION BY symbol, "interval", sec % expected_seconds ORDER BY sec) AS island
    FROM (SELECT *, CAST(epoch("timestamp") AS BIGINT) AS sec FROM stale WHERE is_stale))
GROUP BY symbol, "interval", island, sec % expected_seconds
"""
STALE_SQL = """
SELECT symbol, "interval", count(*) AS bad_count, min(first_timestamp) AS first_timestamp,
       max(last_timestamp) AS last_timestamp, max(observations) AS max_observations,
       CAST(max(duration) AS BIGINT) AS max_duration_seconds
FROM runs WHERE observations >= 6 AND duration >= {seconds} GROUP BY 1, 2
"""
STALE_CTES = {"stale": STALE, "runs": STALE_RUNS}


@add(
    "audit_stale_runs",
    with_views(STALE_SQL.format(seconds=86_400), "dirty", "cadence", extra=STALE_CTES),
)
def audit_stale_runs(spark, folder):
    return ac.stale_price_runs(views.dirty_candles(spark, folder))


@add(
    "audit_stale_runs_quarter_day",
    with_views(STALE_SQL.format(seconds=21_600), "dirty", "cadence", extra=STALE_CTES),
)
def audit_stale_runs_quarter_day(spark, folder):
    config = AuditConfig(stale_run_min_duration_seconds=21_600)
    return ac.stale_price_runs(views.dirty_candles(spark, folder), config)


# ---------------------------------------------------------------------------
# Whole report
# ---------------------------------------------------------------------------
def _label(seconds: str) -> str:
    return (
        f"CASE WHEN {seconds} % 86400 = 0 THEN ({seconds} // 86400) || 'd' "
        f"WHEN {seconds} % 3600 = 0 THEN ({seconds} // 3600) || 'h' "
        f"WHEN {seconds} % 60 = 0 THEN ({seconds} // 60) || 'm' ELSE {seconds} || 's' END"
    )


def _part(check: str, severity: str, sql: str, message: str) -> str:
    return (
        f"SELECT '{severity}' AS severity, 'spot' AS \"table\", '{check}' AS check_name, "
        f"{message} AS message, CAST(bad_count AS BIGINT) AS count, symbol, \"interval\", "
        f"first_timestamp, last_timestamp FROM ({sql})"
    )


_GAP_TEXT = (
    f"bad_count || ' gaps detected; max gap ' || {_label('max_delta_seconds')} || "
    f"' vs expected ' || {_label('expected_seconds')}"
)
FINDING_SQL = " UNION ALL ".join(
    [
        _part("duplicate_primary_key", "ERROR", DUPLICATES_SQL, "bad_count || ' duplicate rows on primary key'"),
        _part("time_gaps", "ERROR", GAPS_SQL, _GAP_TEXT),
        _part(
            "timestamp_alignment",
            "WARN",
            ALIGNMENT_SQL,
            "bad_count || ' kline timestamps are not aligned to their interval boundary'",
        ),
        _part(
            "invalid_values",
            "ERROR",
            INVALID_SQL,
            "bad_count || ' rows contain null, infinite, or out-of-range values'",
        ),
        _part("invalid_ohlc", "ERROR", OHLC_SQL, "bad_count || ' rows violate OHLC relationships'"),
        _part(
            "volume_price_inconsistency",
            "WARN",
            VOLUME_PRICE_SQL,
            "bad_count || ' rows have inconsistent volume, quote volume, or taker volume'",
        ),
        _part(
            "price_return_outliers",
            "WARN",
            RETURN_OUTLIERS_SQL,
            "bad_count || ' extreme log-return outliers detected'",
        ),
        _part(
            "robust_price_jumps",
            "WARN",
            ROBUST_SQL,
            "bad_count || ' robust price jump outliers detected'",
        ),
        _part(
            "wick_outliers",
            "WARN",
            WICKS_SQL,
            "bad_count || ' candles have unusually large range or wick'",
        ),
        _part(
            "volume_outliers",
            "WARN",
            volume_sql(20),
            "bad_count || ' volume outliers detected by IQR'",
        ),
        _part(
            "stale_price_runs",
            "WARN",
            STALE_SQL.format(seconds=86_400),
            "bad_count || ' long flat inactive price runs detected'",
        ),
    ]
)


def stored_report(spark, folder):
    """The whole audit, over candles stored first as a warehouse would hold them."""
    stored = materialise(views.dirty_candles(spark, folder), "dirty-candles")
    return ac.audit_candles(stored, "spot", CONFIG)


REPORT_CTES = {**JUMP_CTES, "stats": RETURN_STATS, **STALE_CTES, "findings": FINDING_SQL}


@add("audit_candle_report", with_views("SELECT * FROM findings", "dirty", "cadence", extra=REPORT_CTES))
def audit_candle_report(spark, folder):
    return stored_report(spark, folder).drop("metadata")


@add(
    "audit_report_lines",
    with_views(
        "SELECT '[' || severity || '] ' || \"table\" || ' ' || symbol || ' ' || \"interval\" || ' ' "
        "|| check_name || ': ' || message || ' (count=' || count || ')' AS line FROM findings",
        "dirty",
        "cadence",
        extra=REPORT_CTES,
    ),
)
def audit_report_lines(spark, folder):
    return fd.report_lines(stored_report(spark, folder))


@add(
    "audit_severity_counts",
    with_views(
        "SELECT count(*) FILTER (WHERE severity = 'ERROR') AS errors, "
        "count(*) FILTER (WHERE severity = 'WARN') AS warnings, "
        "count(*) FILTER (WHERE severity = 'ERROR') = 0 AS passed FROM findings",
        "dirty",
        "cadence",
        extra=REPORT_CTES,
    ),
)
def audit_severity_counts(spark, folder):
    return fd.severity_counts(stored_report(spark, folder))


@add(
    "findings_rollup",
    with_views(
        'SELECT severity, "table", check_name, count(*) AS findings, CAST(sum(count) AS BIGINT) AS rows '
        "FROM findings GROUP BY 1, 2, 3",
        "dirty",
        "cadence",
        extra=REPORT_CTES,
    ),
)
def findings_rollup(spark, folder):
    return fd.rollup(stored_report(spark, folder))


# ---------------------------------------------------------------------------
# Diagnostics
# ---------------------------------------------------------------------------
_NAMES = (
    'exchange, symbol, "interval", "timestamp", open, high, low, close, volume, quote_volume, '
    "trades_count, taker_buy_base_volume, taker_buy_quote_volume"
)
_ORDER = (
    '"timestamp", close NULLS FIRST, open, high, low, volume, quote_volume, trades_count, '
    "taker_buy_base_volume, taker_buy_quote_volume"
)
DIAGNOSTIC_CTES = {
    **STALE_CTES,
    "long_runs": "SELECT * FROM runs WHERE observations >= 6 AND duration >= 86400",
    "ordered": f"""
SELECT *, CASE WHEN {pos('close')} THEN lag(CASE WHEN {pos('close')} THEN close END IGNORE NULLS)
              OVER w END AS prev_close, lag("timestamp") OVER w AS prev_timestamp
FROM stale WINDOW w AS (PARTITION BY exchange, symbol, "interval" ORDER BY {_ORDER})""",
    "measured": """
SELECT *, date_diff('second', prev_timestamp, "timestamp") AS delta_seconds,
       close / prev_close - 1 AS relative_return, ln(close / prev_close) AS log_return
FROM ordered""",
    "medians": """
SELECT symbol, "interval", count(log_return) AS n, avg(log_return) AS mean,
       stddev_samp(log_return) AS std, quantile_cont(log_return, 0.5) AS median
FROM measured GROUP BY 1, 2""",
    "devs": """
SELECT symbol, "interval", quantile_cont(abs(log_return - median), 0.5) AS mad
FROM measured JOIN medians USING (symbol, "interval") GROUP BY 1, 2""",
    "bounds": f"""
SELECT symbol, "interval", q1 - 20 * (q3 - q1) AS lo, q3 + 20 * (q3 - q1) AS hi FROM (
    SELECT symbol, "interval", count(*) AS m, quantile_cont(volume, 0.25) AS q1,
           quantile_cont(volume, 0.75) AS q3
    FROM dirty WHERE {pos('volume')} GROUP BY 1, 2) WHERE m >= 20 AND q3 > q1""",
    "shaped": f"""
SELECT *, CASE WHEN {WELL_FORMED} THEN (high - low) / close END AS range_pct,
       CASE WHEN {WELL_FORMED} THEN (high - greatest(open, close)) / close END AS upper_wick_pct,
       CASE WHEN {WELL_FORMED} THEN (least(open, close) - low) / close END AS lower_wick_pct,
       CASE WHEN expected_seconds <= 86400
            THEN CAST(epoch("timestamp") AS BIGINT) % expected_seconds END AS off, {FLAGS}
FROM (SELECT *, {FLAG_INPUTS} FROM measured)""",
    "diagnosed": f"""
SELECT s.*, coalesce(delta_seconds > s.expected_seconds, FALSE) AS time_gaps,
       coalesce(off > 0, FALSE) AS timestamp_alignment, {ANY_FLAG} AS volume_price_inconsistency,
       coalesce(n >= 20 AND std > 0 AND abs(log_return - mean) > 4 * std, FALSE)
           AS price_return_outliers,
       coalesce(n >= 20 AND abs(relative_return) > 0.5 AND (
           (mad > 0 AND abs(log_return - median) > 15 * 1.4826 * mad)
           OR (mad = 0 AND abs(log_return - median) > 0)), FALSE) AS robust_price_jumps,
       coalesce(range_pct > 1 OR upper_wick_pct > 0.75 OR lower_wick_pct > 0.75, FALSE)
           AS wick_outliers,
       coalesce({pos('volume')} AND (volume < lo OR volume > hi), FALSE) AS volume_outliers,
       least(off, s.expected_seconds - off) AS distance,
       CASE WHEN volume > 0 THEN quote_volume / volume END AS quote_price
FROM shaped AS s LEFT JOIN medians USING (symbol, "interval")
LEFT JOIN devs USING (symbol, "interval") LEFT JOIN bounds USING (symbol, "interval")""",
}
DIAGNOSTIC_FLAGS = (
    "time_gaps",
    "timestamp_alignment",
    "volume_price_inconsistency",
    "price_return_outliers",
    "robust_price_jumps",
    "wick_outliers",
    "volume_outliers",
)
DIAGNOSTICS_SQL = f"""
SELECT symbol, "interval", "timestamp", CAST(count(*) AS BIGINT) AS stored_rows,
       max(delta_seconds) AS delta_seconds, round(max(abs(log_return)), 6) AS log_return,
       {', '.join(f'bool_or({f}) AS {f}' for f in DIAGNOSTIC_FLAGS)},
       bool_or(is_stale AND EXISTS (
           SELECT 1 FROM long_runs AS r WHERE r.symbol = d.symbol AND r."interval" = d."interval"
             AND d."timestamp" BETWEEN r.first_timestamp AND r.last_timestamp)) AS stale_price_runs
FROM diagnosed AS d GROUP BY 1, 2, 3
"""


@add(
    "candle_diagnostics",
    with_views(DIAGNOSTICS_SQL, "dirty", "cadence", extra=DIAGNOSTIC_CTES),
)
def candle_diagnostics(spark, folder):
    rows = dg.candle_diagnostics(views.dirty_candles(spark, folder), CONFIG)
    flags = [F.bool_or(f).alias(f) for f in (*DIAGNOSTIC_FLAGS, "stale_price_runs")]
    return rows.groupBy("symbol", "interval", "timestamp").agg(
        F.sum("copies").alias("stored_rows"),
        F.max("delta_seconds").alias("delta_seconds"),
        F.round(F.max(F.abs("log_return")), 6).alias("log_return"),
        *flags,
    )


_VALUES = {
    "time_gaps": ("CAST(delta_seconds AS DOUBLE)", "close"),
    "timestamp_alignment": ("CAST(distance AS DOUBLE)", "close"),
    "volume_price_inconsistency": ("quote_price", "close"),
    "price_return_outliers": ("log_return", "close"),
    "robust_price_jumps": ("relative_return", "close"),
    "wick_outliers": ("range_pct", "high"),
    "volume_outliers": ("volume", "close"),
}
ANOMALIES_SQL = """
SELECT severity, "table", symbol, "interval", check_name, "timestamp", end_timestamp,
       round(marker_y, 6) AS marker_y, round(value, 6) AS value, count(*) AS n FROM (
""" + " UNION ALL ".join(
    f"SELECT '{'ERROR' if check == 'time_gaps' else 'WARN'}' AS severity, 'spot' AS \"table\", symbol, "
    f"\"interval\", '{check}' AS check_name, \"timestamp\", \"timestamp\" AS end_timestamp, "
    f"{marker} AS marker_y, {value} AS value FROM diagnosed WHERE {check}"
    for check, (value, marker) in _VALUES.items()
) + """
UNION ALL SELECT 'WARN', 'spot', symbol, "interval", 'stale_price_runs', first_timestamp,
       last_timestamp, 10.0, CAST(observations AS DOUBLE) FROM long_runs
UNION ALL SELECT severity, "table", symbol, "interval", check_name, first_timestamp, last_timestamp,
       NULL, CAST(count AS DOUBLE) FROM findings
       WHERE check_name IN ('duplicate_primary_key', 'invalid_values', 'invalid_ohlc')) GROUP BY ALL
"""


@add(
    "candle_anomalies",
    with_views(
        ANOMALIES_SQL, "dirty", "cadence", extra={**DIAGNOSTIC_CTES, **REPORT_CTES}
    ),
)
def candle_anomalies(spark, folder):
    stored = materialise(views.dirty_candles(spark, folder), "dirty-candles")
    report = ac.audit_candles(stored, "spot", CONFIG)
    found = dg.candle_anomalies(dg.candle_diagnostics(stored, CONFIG), report, "spot")
    # Copies of one candle are one listed row here and several in the comparison.
    return (
        rounded(found, "marker_y", "value")
        .groupBy(
            "severity", "table", "symbol", "interval", "check_name", "timestamp", "end_timestamp",
            "marker_y", "value",
        )
        .agg(F.count("*").alias("n"))
    )


FUNDING_DIAGNOSTICS = """
SELECT *, date_diff('second', prev_timestamp, "timestamp") AS delta_seconds,
       coalesce(date_diff('second', prev_timestamp, "timestamp") > 28800, FALSE) AS time_gaps,
       abs(funding_rate) > 0.01 AS funding_rate_extremes
FROM (SELECT *, lag("timestamp") OVER (PARTITION BY exchange, symbol ORDER BY "timestamp")
          AS prev_timestamp FROM fr)
"""


@add(
    "funding_diagnostics",
    with_views(f"SELECT *, CAST(1 AS BIGINT) AS copies FROM ({FUNDING_DIAGNOSTICS})", "fr"),
)
def funding_diagnostics(spark, folder):
    return dg.funding_diagnostics(views.funding_rates(spark, folder))


FUNDING_ANOMALIES_SQL = f"""
SELECT 'ERROR' AS severity, 'funding_rates' AS "table", symbol, CAST(NULL AS VARCHAR) AS "interval",
       'time_gaps' AS check_name, "timestamp", "timestamp" AS end_timestamp,
       CAST(delta_seconds AS DOUBLE) AS value FROM ({FUNDING_DIAGNOSTICS}) WHERE time_gaps
UNION ALL SELECT 'WARN', 'funding_rates', symbol, NULL, 'funding_rate_extremes', "timestamp",
       "timestamp", funding_rate FROM ({FUNDING_DIAGNOSTICS}) WHERE funding_rate_extremes
UNION ALL SELECT 'WARN', 'funding_rates', symbol, NULL, 'funding_rate_distribution', {SPAN},
       CAST(count(*) AS DOUBLE) FROM fr GROUP BY symbol HAVING count(*) >= 20
       AND (abs(avg(funding_rate)) > 0.001 OR stddev_samp(funding_rate) > 0.01)
"""


@add("funding_anomalies", with_views(FUNDING_ANOMALIES_SQL, "fr"))
def funding_anomalies(spark, folder):
    rates = views.funding_rates(spark, folder)
    found = dg.funding_anomalies(dg.funding_diagnostics(rates), am.audit_funding_rates(rates))
    return found.drop("prev_timestamp", "close", "marker_y", "detail")


# ---------------------------------------------------------------------------
# Metric checks
# ---------------------------------------------------------------------------
@add(
    "audit_metric_duplicates",
    with_views(
        """
SELECT symbol, CAST(sum(n - 1) AS BIGINT) AS bad_count, min("timestamp") AS first_timestamp,
       max("timestamp") AS last_timestamp, max(n) AS max_occurrences
FROM (SELECT exchange, symbol, "timestamp", count(*) AS n FROM doi GROUP BY ALL)
WHERE n > 1 GROUP BY 1
""",
        "doi",
    ),
)
def audit_metric_duplicates(spark, folder):
    return am.metric_duplicates(views.dirty_open_interest(spark, folder))


METRIC_GAPS = """
SELECT symbol, prev, "timestamp", date_diff('second', prev, "timestamp") AS delta
FROM (SELECT *, lag("timestamp") OVER (PARTITION BY exchange, symbol ORDER BY "timestamp") AS prev
      FROM {table} WHERE exchange = 'binance') WHERE date_diff('second', prev, "timestamp") > {step}
"""


def metric_gaps_sql(table: str, step: int) -> str:
    return f"""
SELECT symbol, count(*) AS bad_count, {SPAN}, max(delta) AS max_delta_seconds,
       CAST({step} AS BIGINT) AS expected_seconds
FROM ({METRIC_GAPS.format(table=table, step=step)}) GROUP BY 1
"""


@add("audit_open_interest_gaps", with_views(metric_gaps_sql("doi", 300), "doi"))
def audit_open_interest_gaps(spark, folder):
    return am.metric_time_gaps(views.dirty_open_interest(spark, folder), "open_interest")


@add("audit_funding_gaps", with_views(metric_gaps_sql("fr", 28_800), "fr"))
def audit_funding_gaps(spark, folder):
    return am.metric_time_gaps(views.funding_rates(spark, folder), "funding_rates")


@add(
    "audit_metric_invalid_values",
    with_views(
        f"SELECT symbol, count(*) AS bad_count, {SPAN} FROM doi "
        f"WHERE NOT {pos('open_interest')} GROUP BY 1",
        "doi",
    ),
)
def audit_metric_invalid_values(spark, folder):
    return am.metric_value_errors(views.dirty_open_interest(spark, folder), "open_interest", True)


OI_CTES = {
    "changes": f"""
SELECT symbol, "timestamp", abs(open_interest / prev - 1) AS change FROM (
    SELECT *, lag(open_interest) OVER (PARTITION BY exchange, symbol
                                       ORDER BY "timestamp", open_interest) AS prev
    FROM doi WHERE {pos('open_interest')}) WHERE prev > 0""",
    "quartiles": """
SELECT symbol, count(*) AS n, quantile_cont(change, 0.25) AS q1, quantile_cont(change, 0.75) AS q3
FROM changes GROUP BY 1""",
}
OI_CHANGES_SQL = f"""
SELECT symbol, count(*) AS bad_count, {SPAN}, round(max(change), 6) AS max_relative_change
FROM changes JOIN quartiles USING (symbol)
WHERE n >= 20 AND q3 > q1 AND change > q3 + 8 * (q3 - q1) GROUP BY 1
"""


@add("audit_oi_changes", with_views(OI_CHANGES_SQL, "doi", extra=OI_CTES))
def audit_oi_changes(spark, folder):
    found = am.open_interest_changes(views.dirty_open_interest(spark, folder))
    return rounded(found, "max_relative_change")


@add("audit_oi_changes_large_groups", with_views(OI_CHANGES_SQL, "doi", extra=OI_CTES))
def audit_oi_changes_large_groups(spark, folder):
    """The same check over rows dealt out at random, so that every task holds every series."""
    found = am.open_interest_changes(views.dirty_open_interest(spark, folder).repartition(16))
    return rounded(found, "max_relative_change")


@add(
    "audit_funding_extremes",
    with_views(
        f"SELECT symbol, count(*) AS bad_count, {SPAN}, max(abs(funding_rate)) AS max_abs_funding_rate "
        "FROM fr WHERE abs(funding_rate) > 0.01 GROUP BY 1",
        "fr",
    ),
)
def audit_funding_extremes(spark, folder):
    return am.funding_extremes(views.funding_rates(spark, folder))


@add(
    "audit_funding_distribution",
    with_views(
        f"SELECT symbol, count(*) AS bad_count, {SPAN}, round(avg(funding_rate), 6) AS mean_funding_rate, "
        "round(stddev_samp(funding_rate), 6) AS std_funding_rate FROM fr GROUP BY 1 "
        "HAVING count(*) >= 20 AND (abs(avg(funding_rate)) > 0.001 OR stddev_samp(funding_rate) > 0.01)",
        "fr",
    ),
)
def audit_funding_distribution(spark, folder):
    found = am.funding_distribution(views.funding_rates(spark, folder))
    return rounded(found, "mean_funding_rate", "std_funding_rate")


# ---------------------------------------------------------------------------
# Universe checks
# ---------------------------------------------------------------------------
DATES = 'min("date") AS first_timestamp, max("date") AS last_timestamp'


@add(
    "audit_universe_duplicates",
    with_views(
        f"""
SELECT symbol, CAST(sum(n - 1) AS BIGINT) AS bad_count, {DATES}, max(n) AS max_occurrences
FROM (SELECT provider, provider_id, "date", min(symbol) AS symbol, count(*) AS n FROM duni
      GROUP BY 1, 2, 3) WHERE n > 1 GROUP BY 1
""",
        "duni",
    ),
)
def audit_universe_duplicates(spark, folder):
    return au.universe_duplicates(views.dirty_rankings(spark, folder))


@add(
    "audit_universe_duplicate_ranks",
    with_views(
        f"""
SELECT count(*) AS bad_count, {DATES}, max(n) AS max_occurrences
FROM (SELECT "date", rank, count(*) AS n FROM duni GROUP BY 1, 2) WHERE n > 1 HAVING count(*) > 0
""",
        "duni",
    ),
)
def audit_universe_duplicate_ranks(spark, folder):
    return au.duplicate_ranks(views.dirty_rankings(spark, folder))


@add(
    "audit_universe_duplicate_symbols",
    with_views(
        f"""
SELECT symbol, count(*) AS bad_count, {DATES}, max(n) AS max_occurrences
FROM (SELECT "date", symbol, count(*) AS n FROM duni GROUP BY 1, 2) WHERE n > 1 GROUP BY 1
""",
        "duni",
    ),
)
def audit_universe_duplicate_symbols(spark, folder):
    return au.duplicate_symbols(views.dirty_rankings(spark, folder))


@add(
    "audit_universe_invalid_values",
    with_views(
        f"""
SELECT symbol, count(*) AS bad_count, {DATES} FROM duni
WHERE "date" IS NULL OR symbol IS NULL OR rank IS NULL OR rank < 1
   OR (market_cap IS NOT NULL AND (NOT {fin('market_cap')} OR market_cap < 0)) GROUP BY 1
""",
        "duni",
    ),
)
def audit_universe_invalid_values(spark, folder):
    return au.universe_value_errors(views.dirty_rankings(spark, folder))


@add(
    "audit_universe_missing_snapshots",
    with_views(
        f"""
SELECT count(*) AS bad_count, {DATES}, 'monthly' AS frequency, array_to_string(list_slice(
       list(strftime("date", '%Y-%m-%d') ORDER BY "date"), 1, 20), ',') AS sample_missing_dates
FROM (
    SELECT CAST(unnest(generate_series(date_trunc('month', lo), date_trunc('month', hi), INTERVAL 1 MONTH))
                AS DATE) AS "date"
    FROM (SELECT CAST(min("date") AS TIMESTAMP) AS lo, CAST(max("date") AS TIMESTAMP) AS hi FROM duni)) AS e
WHERE "date" NOT IN (SELECT "date" FROM duni) HAVING count(*) > 0
""",
        "duni",
    ),
)
def audit_universe_missing_snapshots(spark, folder):
    found = au.missing_snapshots(views.dirty_rankings(spark, folder), UNIVERSE_CONFIG)
    return found.withColumn("sample_missing_dates", F.array_join(F.col("sample_missing_dates").cast("array<string>"), ","))


@add(
    "audit_universe_rank_above",
    with_views(
        f"""
SELECT count(*) AS bad_count, {DATES}, max(rank) AS max_rank, 20 AS top_n FROM duni
WHERE rank > 20 HAVING count(*) > 0
""",
        "duni",
    ),
)
def audit_universe_rank_above(spark, folder):
    return au.ranks_above(views.dirty_rankings(spark, folder), UNIVERSE_CONFIG)


@add(
    "audit_universe_rank_coverage",
    with_views(
        f"""
SELECT count(*) AS bad_count, {DATES}, min(max_rank) AS min_observed_max_rank,
       max(max_rank) AS max_observed_max_rank, min(row_count) AS min_row_count, 25 AS top_n
FROM (SELECT "date", count(*) AS row_count, max(rank) AS max_rank FROM duni GROUP BY 1)
WHERE max_rank < 25 HAVING count(*) > 0
""",
        "duni",
    ),
)
def audit_universe_rank_coverage(spark, folder):
    return au.rank_coverage(views.dirty_rankings(spark, folder), AuditConfig(universe_top_n=25))


SLOTS_SQL = """
SELECT "date", rank FROM (
    SELECT "date", CAST(unnest(range(1, least(max(rank), 20) + 1)) AS INTEGER) AS rank
    FROM {table} WHERE {where} GROUP BY "date") AS e
WHERE NOT EXISTS (SELECT 1 FROM {table} AS o WHERE o."date" = e."date" AND o.rank = e.rank)
"""


@add(
    "audit_universe_missing_ranks",
    with_views(
        f"""
SELECT count(*) AS bad_count, count(DISTINCT "date") AS affected_dates, {DATES},
       max(rank) AS max_missing_rank,
       array_to_string(list_slice(list(strftime("date", '%Y-%m-%d') || '/' || rank
                                       ORDER BY "date", rank), 1, 20), ',') AS sample_missing_ranks
FROM ({SLOTS_SQL.format(table="duni", where="TRUE")})
""",
        "duni",
    ),
)
def audit_universe_missing_ranks(spark, folder):
    found = au.missing_ranks(views.dirty_rankings(spark, folder), UNIVERSE_CONFIG)
    text = F.transform(
        "sample_missing_ranks", lambda s: F.concat(s["date"], F.lit("/"), s["rank"].cast("string"))
    )
    return found.withColumn("sample_missing_ranks", F.array_join(text, ","))


@add(
    "audit_universe_missing_ranks_in_bounds",
    with_views(
        SLOTS_SQL.format(
            table="duni", where="\"date\" BETWEEN DATE '1996-01-01' AND DATE '1997-06-30'"
        ),
        "duni",
    ),
)
def audit_universe_missing_ranks_in_bounds(spark, folder):
    config = AuditConfig(
        universe_top_n=20, universe_start_date="1996-01-01", universe_end_date="1997-06-30"
    )
    return au.missing_rank_slots(views.dirty_rankings(spark, folder), config)


@add(
    "audit_universe_rank_order",
    with_views(
        f"""
SELECT count(*) AS bad_count, {DATES}, round(max(market_cap - prev), 2) AS max_market_cap_inversion
FROM (SELECT *, lag(market_cap) OVER (PARTITION BY "date" ORDER BY rank, market_cap) AS prev FROM duni
      WHERE {fin('market_cap')}) WHERE market_cap > prev HAVING count(*) > 0
""",
        "duni",
    ),
)
def audit_universe_rank_order(spark, folder):
    found = au.rank_order(views.dirty_rankings(spark, folder))
    return rounded(found, "max_market_cap_inversion", digits=2)


# ---------------------------------------------------------------------------
# Validation contracts
# ---------------------------------------------------------------------------
def _violation(rule: str, column: str, condition: str, table: str, keys: str, shown: str = "") -> str:
    value = shown or f"CAST({column} AS VARCHAR)"
    return (
        f"SELECT {keys}, '{rule}' AS rule, '{column}' AS \"column\", {value} IS NULL AS is_null "
        f"FROM {table} WHERE {condition}"
    )


_KEYS = 'symbol, "timestamp"'
VALIDATE_SQL = " UNION ALL ".join(
    [
        *[_violation("not_null", c, f"{c} IS NULL", "dirty", _KEYS) for c in
          ("open", "high", "low", "close", "volume", "quote_volume")],
        *[_violation("positive", c, f"{c} <= 0", "dirty", _KEYS) for c in
          ("open", "high", "low", "close")],
        *[_violation("minimum", c, f"{c} < 0", "dirty", _KEYS) for c in
          ("volume", "quote_volume", "trades_count", "taker_buy_base_volume", "taker_buy_quote_volume")],
        *[_violation(f"high_vs_{c}", "high", f"high < {c}", "dirty", _KEYS) for c in
          ("low", "open", "close")],
        *[_violation(f"low_vs_{c}", "low", f"low > {c}", "dirty", _KEYS) for c in ("open", "close")],
        'SELECT symbol, "timestamp", \'unique\', \'exchange,symbol,interval,timestamp\', FALSE '
        'FROM dirty GROUP BY exchange, symbol, "interval", "timestamp" HAVING count(*) > 1',
    ]
)


@add("validate_ohlcv", with_views(VALIDATE_SQL, "dirty"))
def validate_ohlcv(spark, folder):
    found = va.validate(views.dirty_candles(spark, folder), "spot", strict=False)
    return found.select(
        "symbol", "timestamp", "rule", "column", F.col("value").isNull().alias("is_null")
    )


@add(
    "validate_open_interest",
    with_views(
        " UNION ALL ".join(
            [
                _violation("not_null", "open_interest", "open_interest IS NULL", "doi", _KEYS),
                _violation("positive", "open_interest", "open_interest <= 0", "doi", _KEYS),
                "SELECT symbol, \"timestamp\", 'unique', 'exchange,symbol,timestamp', FALSE FROM doi "
                'GROUP BY exchange, symbol, "timestamp" HAVING count(*) > 1',
            ]
        ),
        "doi",
    ),
)
def validate_open_interest(spark, folder):
    found = va.validate(views.dirty_open_interest(spark, folder), "open_interest", strict=False)
    return found.select(
        "symbol", "timestamp", "rule", "column", F.col("value").isNull().alias("is_null")
    )


@add(
    "validate_funding",
    with_views(
        "SELECT symbol, \"timestamp\", 'pattern' AS rule, 'symbol' AS \"column\" FROM ("
        "SELECT lower(symbol) AS symbol, \"timestamp\" FROM fr WHERE symbol = 'VIEWUSDT')",
        "fr",
    ),
)
def validate_funding(spark, folder):
    """Funding rows with one symbol written in lower case."""
    rates = views.funding_rates(spark, folder).withColumn(
        "symbol",
        F.when(F.col("symbol") == "VIEWUSDT", F.lower("symbol")).otherwise(F.col("symbol")),
    )
    found = va.validate(rates, "funding_rates", strict=False)
    return found.select("symbol", "timestamp", "rule", "column")


@add(
    "validate_universe",
    with_views(
        """
SELECT 'minimum' AS rule, "date", count(*) AS n FROM duni WHERE rank < 1 GROUP BY 2
UNION ALL SELECT 'unique_key', "date", count(*) FROM (
    SELECT "date" FROM duni GROUP BY provider, provider_id, "date" HAVING count(*) > 1) GROUP BY 2
UNION ALL SELECT 'unique_rank', "date", count(*) FROM (
    SELECT "date" FROM duni GROUP BY "date", rank HAVING count(*) > 1) GROUP BY 2
""",
        "duni",
    ),
)
def validate_universe(spark, folder):
    found = va.violations(views.dirty_rankings(spark, folder), "crypto_universe")
    rule = (
        F.when(F.col("column") == "date,rank", "unique_rank")
        .when(F.col("rule") == "unique", "unique_key")
        .otherwise(F.col("rule"))
    )
    return found.groupBy(rule.alias("rule"), "date").agg(F.count("*").alias("n"))


@add(
    "validate_types",
    with_views(
        """
SELECT symbol, 'type' AS rule, 'close' AS "column", count(*) AS n FROM k1h
WHERE trades_count % 3 = 0 GROUP BY 1
UNION ALL SELECT symbol, 'not_null', 'close', count(*) FROM k1h WHERE trades_count % 3 = 0 GROUP BY 1
""",
        "k1h",
    ),
)
def validate_types(spark, folder):
    """Candles whose close is text, part of it unreadable."""
    text = views.hourly_candles(spark, folder).withColumn(
        "close",
        F.when(F.col("trades_count") % 3 == 0, F.lit("n/a")).otherwise(F.col("close").cast("string")),
    )
    found = va.validate(text, "spot", strict=False)
    return found.groupBy("symbol", "rule", "column").agg(F.count("*").alias("n"))


@add(
    "time_reversals",
    """
SELECT user_id, event_id FROM (
    SELECT *, lag(t) OVER (PARTITION BY user_id ORDER BY event_id) AS prev FROM (
        SELECT user_id, event_id, CASE WHEN event_id % 5 = 0 THEN ts - INTERVAL 2 DAY ELSE ts END AS t
        FROM events)) WHERE t < prev
""",
)
def time_reversals(spark, folder):
    """Every user's events as a file in id order, each fifth one dated two days back."""
    lines = views.read_table(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("file"),
        F.col("event_id").alias("line_no"),
        "user_id",
        "event_id",
        F.when(F.col("event_id") % 5 == 0, F.col("ts") - F.expr("interval 2 days"))
        .otherwise(F.col("ts"))
        .alias("timestamp"),
    )
    return va.time_reversals(lines).select("user_id", "event_id")


@add(
    "validate_price_continuity",
    with_views(
        RETURN_OUTLIERS_SQL.replace("n >= 20", "n >= 1").replace("4 * std", "3 * std"),
        "dirty",
        extra={"returns": RETURNS, "stats": RETURN_STATS},
    ),
)
def validate_price_continuity(spark, folder):
    found = va.price_continuity(views.dirty_candles(spark, folder), sigma=3.0)
    return rounded(found, "max_abs_log_return")


@add("validate_volume_spread", with_views(volume_sql(3, 4), "dirty"))
def validate_volume_spread(spark, folder):
    return va.volume_spread(views.dirty_candles(spark, folder))


@add(
    "validate_open_interest_levels",
    with_views(
        f"""
SELECT symbol, count(*) AS bad_count, {SPAN}, round(max(abs(open_interest - m) / s), 6) AS max_z
FROM oi JOIN (SELECT symbol, count(*) AS n, avg(open_interest) AS m, stddev_samp(open_interest) AS s
              FROM oi GROUP BY 1) USING (symbol)
WHERE n >= 3 AND s > 0 AND abs(open_interest - m) / s > 5 GROUP BY 1
""",
        "oi",
    ),
)
def validate_open_interest_levels(spark, folder):
    return rounded(va.open_interest_levels(views.open_interest(spark, folder)), "max_z")


@add(
    "validate_funding_balance",
    with_views(
        """
SELECT symbol, count(*) AS n, round(avg(funding_rate), 6) AS mean_rate,
       round(stddev_samp(funding_rate), 6) AS std_rate FROM fr GROUP BY 1
HAVING count(*) >= 10 AND NOT (abs(avg(funding_rate)) < 0.001 AND stddev_samp(funding_rate) < 0.01)
""",
        "fr",
    ),
)
def validate_funding_balance(spark, folder):
    return rounded(va.funding_balance(views.funding_rates(spark, folder)), "mean_rate", "std_rate")


@add(
    "validate_statistical_warnings",
    with_views(
        f"""
SELECT symbol, "interval", 'price_continuity' AS "check", 'DataFrame' AS "column",
       'Extreme price jumps detected (>5 sigma)' AS error
FROM returns JOIN stats USING (symbol, "interval")
WHERE std > 0 AND abs(log_return - mean) > 5 * std GROUP BY 1, 2
UNION ALL SELECT symbol, "interval", 'volume_outliers', 'DataFrame',
       'Extreme volume outliers detected (>Q3 + 3*IQR)' FROM ({volume_sql(3, 4)})
""",
        "dirty",
        extra={"returns": RETURNS, "stats": RETURN_STATS},
    ),
)
def validate_statistical_warnings(spark, folder):
    return va.statistical_warnings(views.dirty_candles(spark, folder), "spot")
