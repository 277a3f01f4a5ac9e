"""Multi-operator plans: ingest archives, refresh snapshots, repair and build a warehouse."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import specs
from tidemark.functions.scalars import date_literal
from tidemark.operators import normalize, planning, repair, universe, upsert, validate
from tidemark.session import materialise
from tidemark.sources import archives, reports, tables


@dataclass
class IngestSummary:
    """Counters of one ingest run."""

    inserted: dict[str, int] = field(default_factory=dict)
    replaced_days: int = 0
    rejected_files: int = 0
    anomalies: int = 0


def ingest_lines(
    spark: SparkSession,
    root: str,
    table: str,
    lines: DataFrame,
    windows: DataFrame | None = None,
    anomaly_path: str | None = None,
    strict: bool = True,
) -> IngestSummary:
    """Normalise, validate and store archive lines; a file is stored as a whole or not at all.

    Daily candle files replace their day, all other files only add absent keys. ``strict``
    raises before anything is written when a file is unreadable or breaks the contract.
    """
    spec = specs.table_spec(table)
    parsed = normalize.normalise(lines, table, windows)
    rows = materialise(parsed.rows, f"parsed-{table}")
    broken = validate.violations(rows, table, ["file"]).select("file").distinct()
    bad = materialise(
        broken.unionByName(parsed.rejected.select("file")).distinct(), f"rejected-{table}"
    )
    summary = IngestSummary(rejected_files=bad.count())
    if strict and summary.rejected_files:
        example = bad.orderBy("file").first()[0]
        raise validate.ContractError(
            f"{table}: {summary.rejected_files} files break the contract, such as {example}"
        )
    good = upsert.accepted_files(rows, bad)
    daily = F.length("period") == 10 if spec.kind == "kline" else F.lit(False)
    summary.inserted[table] = tables.insert_new(
        spark, root, table, good.where(~daily).select(*spec.columns)
    )
    if spec.kind == "kline":
        fresh = good.where(daily)
        days = fresh.select("symbol", "interval", F.to_date("period").alias("day")).distinct()
        summary.replaced_days = days.count()
        if summary.replaced_days:
            content = fresh.select(*spec.columns)
            if tables.table_exists(spark, root, table):
                tables.replace_days(spark, root, table, content, days)
            else:
                tables.insert_new(spark, root, table, content)
    if anomaly_path is not None:
        found = upsert.accepted_files(
            parsed.anomalies, bad.withColumnRenamed("file", "source_file"), "source_file"
        )
        found = materialise(found, f"anomalies-{table}")
        reports.append_anomalies(found, anomaly_path)
        summary.anomalies = found.count()
    return summary


def refresh_universe(
    spark: SparkSession,
    root: str,
    listings: DataFrame,
    dates: DataFrame,
    exclude_tags: Sequence[str] | None = None,
    exclude_symbols: Sequence[str] | None = None,
    skip_existing: bool = True,
) -> universe.SnapshotBuild | None:
    """Build the requested snapshot dates and replace them in the stored table.

    Dates already stored are skipped by default; None means nothing was left to do. If every
    date fails, nothing is written and an error is raised.
    """
    wanted = dates.select("date").distinct()
    if skip_existing and tables.table_exists(spark, root, "crypto_universe"):
        stored = tables.read_table(spark, root, "crypto_universe").select("date").distinct()
        wanted = wanted.join(stored, "date", "left_anti")
    total = wanted.count()
    if total == 0:
        return None
    build = universe.build_snapshots(listings, wanted, exclude_tags, exclude_symbols)
    failed = materialise(build.failed_dates, "failed-dates")
    if failed.count() == total:
        raise RuntimeError(f"all {total} universe dates failed")
    done = wanted.join(failed.select("date"), "date", "left_anti")
    tables.replace_dates(spark, root, build.rows, done)
    return build


def repair_tables(
    spark: SparkSession,
    root: str,
    sources: Mapping[str, DataFrame],
    symbols: Sequence[str] | None = None,
    intervals: Sequence[str] | None = None,
) -> DataFrame:
    """Repair the gaps of every table of ``sources``; returns the per-table report."""
    reports_ = []
    for table, backfill in sources.items():
        target = tables.read_table(spark, root, table)
        fixed = repair.repair(target, backfill, table, symbols, intervals)
        # The outcomes describe the table before the insert, so they are stored first.
        outcomes = materialise(fixed.outcomes, f"outcomes-{table}")
        inserted = tables.insert_new(spark, root, table, fixed.rows)
        counted = spark.createDataFrame([(table, inserted)], "table string, inserted_rows bigint")
        reports_.append(repair.repair_report(outcomes, counted))
    result = reports_[0]
    for part in reports_[1:]:
        result = result.unionByName(part)
    return result


#: Missing files in a row after which a series counts as ended.
END_OF_LIFE_FILES = 3


def _month_before(start: date | str) -> str:
    first = date.fromisoformat(str(start)[:10]).replace(day=1)
    return f"{first - timedelta(days=1):%Y-%m}"


def wanted_files(
    spark: SparkSession,
    root: str,
    table: str,
    symbols: DataFrame,
    available: DataFrame,
    intervals: Sequence[str],
    start: date | str,
    end: date | str,
    as_of: date | str,
    threshold: int = END_OF_LIFE_FILES,
) -> DataFrame:
    """Archive periods to fetch for the symbols, with ``path``, ``file`` and ``status``.

    ``available`` has (file, symbol, interval, period) of the archives there are. Symbols are
    replaced by the name their files have, periods stored completely are left out, and a series
    is cut where its files end. A period without a file has the status not_found.
    """
    spec = specs.table_spec(table)
    kline = spec.kind == "kline"
    requests = symbols.select(
        "symbol", date_literal(start).alias("start"), date_literal(end).alias("end")
    )
    if kline:
        labels = F.array(*[F.lit(i) for i in intervals])
        periods = planning.candle_periods(requests.withColumn("interval", F.explode(labels)), as_of)
    else:
        periods = planning.metric_periods(requests, table).withColumn(
            "interval", F.lit(None).cast("string")
        )
    of_table = F.lit(table).alias("table")
    named = planning.effective_symbols(
        periods.select("*", of_table), available.select("*", of_table)
    ).select(
        F.col("symbol").alias("asked_symbol"),
        F.col("effective_symbol").alias("symbol"),
        "interval",
        "period",
        "is_monthly",
        "replace_existing",
    )
    if tables.table_exists(spark, root, table):
        # Partitions by month: those of the range, and the one before it for rows at midnight.
        months = _month_before(start), str(end)[:7]
        days = tables.read_coverage(spark, root, table, intervals if kline else None, months).join(
            named.select("symbol").distinct(), "symbol", "left_semi"
        )
        status = planning.stored_period_status(named, days, table)
        named = planning.missing_periods(status).select(*named.columns)
    files = available.select(
        "file", *[F.col(c).alias(f"_{c}") for c in ("symbol", "interval", "period")]
    ).distinct()
    same = (
        (F.col("symbol") == F.col("_symbol"))
        & F.col("interval").eqNullSafe(F.col("_interval"))
        & (F.col("period") == F.col("_period"))
    )
    path = archives.archive_path(
        table, F.col("symbol"), F.coalesce("interval", F.lit("")), F.col("period"), F.col("is_monthly")
    )
    found = named.join(files, same, "left").select(
        *named.columns,
        path.alias("path"),
        "file",
        F.when(F.col("file").isNull(), "not_found").otherwise("success").alias("status"),
    )
    return planning.cut_after_end_of_life(
        found.withColumn("_series", F.coalesce("interval", F.lit(""))), threshold, ["symbol", "_series"]
    ).drop("_series")


def archives_below(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """(file, symbol, interval, period) of the zipped archives below a folder; no content is read."""
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.zip")
        .option("recursiveFileLookup", True)
        .load(folder)
        .select(F.col("path").alias("file"))
    )
    return archives.with_file_parts(listed, table)


@dataclass
class BuildSummary:
    """Symbols asked for, periods by status, and what every table's ingest did."""

    symbols: int
    periods: dict[str, dict[str, int]] = field(default_factory=dict)
    pruned: dict[str, int] = field(default_factory=dict)
    ingests: dict[str, IngestSummary] = field(default_factory=dict)


def build_warehouse(
    spark: SparkSession,
    root: str,
    listings: DataFrame,
    snapshot_dates: DataFrame,
    sources: Mapping[str, DataFrame | str],
    start: date | str,
    end: date | str,
    top_n: int,
    backfills: Mapping[str, DataFrame] | None = None,
    exclude_tags: Sequence[str] | None = None,
    exclude_symbols: Sequence[str] | None = None,
    anomaly_path: str | None = None,
    intervals: Sequence[str] = ("5m",),
    as_of: date | str | None = None,
) -> BuildSummary:
    """Snapshots, the symbols they ask for, the files these lack, their rows, then repair.

    ``sources`` maps a table to a folder of zipped archives, or to archive lines that are staged
    already. Only files that are planned and not stored completely are opened. Stored candles of
    the symbols outside the date range are pruned.
    """
    as_of = as_of or date.today()
    refresh_universe(spark, root, listings, snapshot_dates, exclude_tags, exclude_symbols)
    stored = tables.read_table(spark, root, "crypto_universe")
    symbols = materialise(
        universe.symbol_superset(stored, start, end, top_n, exclude_tags, exclude_symbols),
        "symbols",
    )
    summary = BuildSummary(symbols.count())
    if not summary.symbols:
        raise ValueError("no symbols in the requested ranks and dates")
    low, high = upsert.close_window(date_literal(start), date_literal(end))
    for table, source in sources.items():
        kline = specs.table_spec(table).kind == "kline"
        zipped = isinstance(source, str)
        available = (
            archives_below(spark, source, table)
            if zipped
            else source.select("file", "symbol", "interval", "period").distinct()
        )
        plan = materialise(
            wanted_files(spark, root, table, symbols, available, intervals, start, end, as_of),
            f"plan-{table}",
        )
        summary.periods[table] = {
            r["status"]: r["count"] for r in plan.groupBy("status").count().collect()
        }
        found = plan.where("status = 'success'")
        if zipped:
            # The list of files to open is what a reader holds on the driver in any case.
            paths = [r["file"] for r in found.select("file").collect()]
            lines = archives.read_zipped(spark, paths, table) if paths else None
        else:
            lines = source.join(found.select("file"), "file", "left_semi")
        if lines is not None and not found.isEmpty():
            windows = None
            if kline:
                windows = found.select(
                    "file", low.alias("window_start"), high.alias("window_end")
                ).distinct()
            summary.ingests[table] = ingest_lines(spark, root, table, lines, windows, anomaly_path)
        if kline and tables.table_exists(spark, root, table):
            names = plan.select("symbol").unionByName(symbols.select("symbol")).distinct()
            summary.pruned[table] = tables.prune(spark, root, table, names, intervals, low, high)
    if backfills:
        repair_tables(spark, root, backfills)
    return summary
