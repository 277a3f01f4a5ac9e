"""Calendars, file periods, completeness of stored periods and availability."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import specs
from tidemark.functions.scalars import accepts_prefix, date_literal, prefixed_symbol
from tidemark.operators import coverage as coverage_of
from tidemark.operators.gaps import scan
from tidemark.operators.upsert import close_day

FREQUENCIES = ("daily", "weekly", "monthly")
PERIOD_KEYS = ("table", "symbol", "interval", "period")


def calendar(bounds: DataFrame, frequency: str) -> DataFrame:
    """Dates from ``start`` to ``end`` of every row: days, Mondays or first days of months.

    Monthly dates begin with the first day of the start month; start after end gives none.
    """
    if frequency not in FREQUENCIES:
        raise ValueError(f"unknown frequency {frequency!r}; one of {', '.join(FREQUENCIES)}")
    ordered = bounds.where(F.col("start") <= F.col("end"))
    others = [c for c in bounds.columns if c not in ("start", "end")]
    # Literal bounds may be folded before the filter runs, so the sequence guards itself.
    end = F.greatest("start", "end")
    if frequency == "monthly":
        dates = F.sequence(F.trunc("start", "MM"), F.trunc(end, "MM"), F.expr("interval 1 month"))
    else:
        dates = F.sequence("start", end, F.expr("interval 1 day"))
    days = ordered.select(*others, F.explode(dates).alias("date"))
    return days.where(F.dayofweek("date") == 2) if frequency == "weekly" else days


def months(bounds: DataFrame) -> DataFrame:
    """Months touched by every range, as yyyy-MM."""
    others = [c for c in bounds.columns if c not in ("start", "end")]
    return calendar(bounds, "monthly").select(
        *others, F.date_format("date", "yyyy-MM").alias("period")
    )


def candle_periods(requests: DataFrame, as_of: date | str) -> DataFrame:
    """Files to fetch for candle requests (``start``, ``end`` dates plus any other columns).

    Months that ended before ``as_of`` come as one monthly file. The open month comes as
    daily files up to yesterday; the last three days of those replace what is stored.
    """
    today = date_literal(as_of)
    yesterday = F.date_sub(today, 1)
    others = [c for c in requests.columns if c not in ("start", "end")]
    spans = (
        requests.where(F.col("start") <= F.col("end"))
        .withColumn(
            "_month",
            F.explode(
                F.sequence(
                    F.trunc("start", "MM"),
                    F.trunc(F.greatest("start", "end"), "MM"),
                    F.expr("interval 1 month"),
                )
            ),
        )
        .withColumn("_closed", F.last_day("_month") < today)
    )
    monthly = spans.where("_closed").select(
        *others,
        F.date_format("_month", "yyyy-MM").alias("period"),
        F.lit(True).alias("is_monthly"),
        F.lit(False).alias("replace_existing"),
    )
    first = F.greatest("start", "_month")
    last = F.least(F.col("end"), F.last_day("_month"), yesterday)
    daily = (
        spans.where(~F.col("_closed"))
        .where(first <= last)
        .withColumn("_day", F.explode(F.sequence(first, F.greatest(first, last), F.expr("interval 1 day"))))
        .select(
            *others,
            F.date_format("_day", "yyyy-MM-dd").alias("period"),
            F.lit(False).alias("is_monthly"),
            (F.col("_day") >= F.date_sub(yesterday, specs.RECENT_REFRESH_DAYS - 1)).alias(
                "replace_existing"
            ),
        )
    )
    return monthly.unionByName(daily)


def metric_periods(requests: DataFrame, table: str) -> DataFrame:
    """Open interest comes in daily files, funding in monthly ones."""
    others = [c for c in requests.columns if c not in ("start", "end")]
    monthly = table == "funding_rates"
    fmt = "yyyy-MM" if monthly else "yyyy-MM-dd"
    return calendar(requests, "monthly" if monthly else "daily").select(
        *others,
        F.date_format("date", fmt).alias("period"),
        F.lit(monthly).alias("is_monthly"),
        F.lit(False).alias("replace_existing"),
    )


def with_period_bounds(periods: DataFrame) -> DataFrame:
    """Add the half-open calendar range of every period label."""
    start = F.when(
        F.length("period") == 7, F.to_date(F.concat("period", F.lit("-01")))
    ).otherwise(F.to_date("period"))
    end = F.when(F.length("period") == 7, F.add_months(start, 1)).otherwise(F.date_add(start, 1))
    return periods.withColumns(
        {
            "period_start": start.cast("timestamp_ntz"),
            "period_end": end.cast("timestamp_ntz"),
        }
    )


def candle_period_status(periods: DataFrame, candles: DataFrame) -> DataFrame:
    """Every candle period with ``complete``: all of them in one grouped join.

    A row belongs to the period that holds the instant before its close. Rows are put together by
    day first, and only days are labelled with months.
    """
    rows = scan(candles, exchange=specs.EXCHANGE)
    days = (
        rows.groupBy("exchange", "symbol", "interval", close_day("timestamp").alias("day"))
        .agg(
            F.count("*").alias("row_count"),
            F.min("timestamp").alias("first_timestamp"),
            F.max("timestamp").alias("last_timestamp"),
        )
        .withColumn("widest_gap", F.lit(None).cast("bigint"))
    )
    return _status(coverage_of.candle_completeness(with_period_bounds(periods), days))


def metric_period_status(periods: DataFrame, metrics: DataFrame, table: str) -> DataFrame:
    """Every metric period with ``complete``: at least two rows, edges and no wide gap."""
    days = coverage_of.day_summaries(scan(metrics, exchange=specs.EXCHANGE), table)
    return _status(coverage_of.metric_completeness(with_period_bounds(periods), days, table))


def stored_period_status(periods: DataFrame, days: DataFrame, table: str) -> DataFrame:
    """Every period with ``complete``, from kept summaries of days; no stored row is read."""
    labelled = with_period_bounds(periods)
    if specs.table_spec(table).kind == "kline":
        return _status(coverage_of.candle_completeness(labelled, days, table))
    return _status(coverage_of.metric_completeness(labelled, days, table))


def _status(found: DataFrame) -> DataFrame:
    return found.withColumnsRenamed({"first_timestamp": "min_ts", "last_timestamp": "max_ts"})


def missing_periods(status: DataFrame) -> DataFrame:
    """Periods still to fetch: incomplete ones, and those flagged for replacement."""
    return status.where(F.col("replace_existing") | ~F.col("complete"))


def missing_snapshot_dates(dates: DataFrame, universe: DataFrame) -> DataFrame:
    """Requested snapshot dates not stored yet."""
    return dates.join(universe.select("date").distinct(), "date", "left_anti")


def cut_after_end_of_life(
    results: DataFrame, threshold: int, keys: Sequence[str] = ("symbol",)
) -> DataFrame:
    """Drop everything from the first run of ``threshold`` missing files after a success.

    ``results`` has one row per period with a ``status`` of success, not_found or anything
    else. Misses before the first success do not count and other failures end a run. A
    series has one row per file, so its ordered rows fit one task.
    """
    if threshold <= 0:
        return results
    keys = list(keys)
    running = (
        Window.partitionBy(*keys)
        .orderBy("period")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    miss = F.col("status") == "not_found"
    marked = results.withColumns(
        {
            "_alive": F.max((F.col("status") == "success").cast("int")).over(running),
            "_block": F.sum((~miss).cast("int")).over(running),
        }
    )
    cuts = (
        marked.where(miss & (F.col("_alive") == 1))
        .groupBy(*keys, "_block")
        .agg(F.count("*").alias("_run"), F.min("period").alias("_first"))
        .where(F.col("_run") >= threshold)
        .groupBy(*keys)
        .agg(F.min("_first").alias("_cut"))
    )
    return (
        results.join(cuts, keys, "left")
        .where(F.col("_cut").isNull() | (F.col("period") < F.col("_cut")))
        .drop("_cut")
    )


def effective_symbols(requests: DataFrame, available: DataFrame) -> DataFrame:
    """Pick plain or 1000-prefixed file names: the prefix only if no plain file exists at all.

    ``requests`` and ``available`` carry (table, symbol, interval, period); the effective
    symbol is the one rows are stored under.
    """
    files = available.select("table", "symbol").distinct()
    names = requests.select("table", "symbol").distinct()
    plain = names.join(files, ["table", "symbol"], "left_semi")
    prefixed = (
        names.where(accepts_prefix("table", "symbol"))
        .join(plain, ["table", "symbol"], "left_anti")
        .withColumn("effective_symbol", prefixed_symbol("symbol"))
        .join(
            files.withColumnRenamed("symbol", "effective_symbol"),
            ["table", "effective_symbol"],
            "left_semi",
        )
    )
    return requests.join(prefixed, ["table", "symbol"], "left").withColumn(
        "effective_symbol", F.coalesce("effective_symbol", "symbol")
    )


def availability(
    tables: Mapping[str, DataFrame],
    interval: str,
    symbols: Sequence[str] | None = None,
) -> DataFrame:
    """First and last stored day per symbol and table."""
    parts = []
    for name, df in tables.items():
        kline = specs.table_spec(name).kind == "kline"
        rows = scan(df, symbols, [interval] if kline else None, specs.EXCHANGE)
        parts.append(
            rows.groupBy("symbol").agg(
                F.lit(name).alias("data_type"),
                F.to_date(F.min("timestamp")).alias("first_date"),
                F.to_date(F.max("timestamp")).alias("last_date"),
            )
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.orderBy("symbol", "data_type")


def coverage(
    available: DataFrame, start: date | str, end: date | str
) -> DataFrame:
    """Share of the requested range covered, in days for open interest and else in months."""
    lo, hi = date_literal(start), date_literal(end)
    first, last = F.greatest(F.col("first_date"), lo), F.least(F.col("last_date"), hi)
    daily = F.col("data_type") == "open_interest"

    def span(a: Column, b: Column) -> Column:
        by_month = (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a) + 1
        return F.when(daily, F.datediff(b, a) + 1).otherwise(by_month)

    total = span(lo, hi)
    covered = F.when(first <= last, span(first, last)).otherwise(F.lit(0))
    return available.withColumns({"covered": covered, "total": total}).withColumn(
        "percent",
        F.when(
            F.col("total") > 0, F.floor(F.col("covered") / F.col("total") * 100)
        )
        .otherwise(F.lit(0))
        .cast("int"),
    )


def missing_data_types(available: DataFrame, requested: Sequence[str]) -> DataFrame:
    """Requested tables without any row, per symbol."""
    wanted = F.array(*[F.lit(name) for name in sorted(requested)])
    return (
        available.groupBy("symbol")
        .agg(F.array_sort(F.array_except(wanted, F.collect_set("data_type"))).alias("_missing"))
        .where(F.size("_missing") > 0)
        .select("symbol", F.concat_ws(", ", "_missing").alias("missing"))
    )


def status_counts(results: DataFrame) -> DataFrame:
    """How many periods were downloaded, skipped, failed or not found."""
    return results.groupBy("status").agg(F.count("*").alias("periods"))
