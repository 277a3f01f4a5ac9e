"""Stored tables: partitioned parquet, idempotent inserts and replacements, exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark import specs
from tidemark.operators import coverage, upsert, validate
from tidemark.operators.gaps import scan
from tidemark.session import discard, materialise


def table_exists(spark: SparkSession, root: str, table: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{table}")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def with_partition(df: DataFrame, table: str) -> DataFrame:
    """Add the table's partition column."""
    spec = specs.table_spec(table)
    if spec.partition_by == "month":
        return df.withColumn("month", F.date_format(upsert.close_day("timestamp"), "yyyy-MM"))
    return df.withColumn("year", F.year("date"))


def _partitions(table: str) -> list[str]:
    spec = specs.table_spec(table)
    return ["interval", spec.partition_by] if spec.kind == "kline" else [spec.partition_by]


def _hadoop_path(spark: SparkSession, path: str):
    """The path and its file system."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _write(df: DataFrame, root: str, table: str, mode: str) -> None:
    """Write with files clustered and sorted, so that min/max statistics can skip row groups.

    Hot symbols are spread over days: the exchange is on partition, symbol and day. Summaries of
    the partitions that are written are withdrawn before and made anew after, so a write that is
    broken off leaves partitions without a summary, never with a wrong one.
    """
    spec = specs.table_spec(table)
    when = "date" if spec.kind == "universe" else "timestamp"
    parts = _partitions(table)
    reached = None
    if keeps_coverage(table):
        spark = df.sparkSession
        if table_exists(spark, root, table):
            reached = _partitions_of(with_partition(df, table), table)
        _withdraw_coverage(spark, root, table, reached)
    (
        with_partition(df.select(*spec.columns), table)
        .repartition(*parts, "symbol", F.to_date(when))
        .sortWithinPartitions(*parts, "symbol", when)
        .write.mode(mode)
        # Only the partitions present in the write are replaced, whatever the session's setting.
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts)
        .parquet(f"{root}/{table}")
    )
    if keeps_coverage(table):
        renew_coverage(df.sparkSession, root, table, reached)


# ---------------------------------------------------------------------------
# Kept summaries of days, in a table beside the table and under its partitions
# ---------------------------------------------------------------------------
def keeps_coverage(table: str) -> bool:
    """Candles and metrics have summaries; rankings are small enough to be read."""
    return specs.table_spec(table).kind != "universe"


def _coverage_path(root: str, table: str) -> str:
    return f"{root}/_coverage/{table}"


def _partitions_of(rows: DataFrame, table: str) -> list[tuple]:
    """Partitions that rows fall into, a few bytes each, on the driver."""
    return [tuple(row) for row in rows.select(*_partitions(table)).distinct().collect()]


def _folders(spark: SparkSession, path: str, levels: int) -> set[tuple]:
    """Values of the partition folders below a path, by listing folders; none without the path."""
    place, files = _hadoop_path(spark, path)
    if not files.exists(place):
        return set()
    if not levels:
        return {()}
    below = [entry.getPath() for entry in files.listStatus(place) if entry.isDirectory()]
    unescape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    return {
        (unescape(entry.getName().split("=", 1)[1]), *rest)
        for entry in below
        if "=" in entry.getName()
        for rest in _folders(spark, entry.toString(), levels - 1)
    }


def _withdraw_coverage(spark: SparkSession, root: str, table: str, partitions: Sequence[tuple] | None) -> None:
    """Remove the summaries of partitions (None: all) that are about to change."""
    base = _coverage_path(root, table)
    names = _partitions(table)
    folders = [""] if partitions is None else [
        "/" + "/".join(f"{name}={value}" for name, value in zip(names, values, strict=True)) for values in partitions
    ]
    for folder in folders:
        place, files = _hadoop_path(spark, base + folder)
        files.delete(place, True)


def renew_coverage(
    spark: SparkSession, root: str, table: str, partitions: Sequence[tuple] | None = None
) -> None:
    """Summarise partitions of a stored table anew (None: all), as every write does by itself."""
    stored = read_table(spark, root, table)
    if partitions is not None:
        stored = stored.where(_in_partitions(partitions, table))
    parts = _partitions(table)
    (
        _summaries(stored, table)
        .repartition(*parts)
        .sortWithinPartitions(*parts, "symbol", "day")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts)
        .parquet(_coverage_path(root, table))
    )


def _summaries(stored: DataFrame, table: str) -> DataFrame:
    """Summaries of days under the table's partitions; a day on the edge of two is in two pieces."""
    return coverage.day_summaries(stored, table, ["month"])


def read_coverage(
    spark: SparkSession,
    root: str,
    table: str,
    intervals: Sequence[str] | None = None,
    months: tuple[str, str] | None = None,
) -> DataFrame:
    """Summaries of the days stored in a table; ``months`` are the first and last partition wanted.

    Kept summaries are read; partitions that have none (written by other means, or by a write that
    was broken off) are summarised from their rows.
    """
    parts = _partitions(table)

    def wanted(values: tuple) -> bool:
        named = dict(zip(parts, values, strict=True))
        return (not intervals or named.get("interval") in (None, *intervals)) and (
            months is None or months[0] <= named["month"] <= months[1]
        )

    present = {p for p in _folders(spark, f"{root}/{table}", len(parts)) if wanted(p)}
    kept = present & _folders(spark, _coverage_path(root, table), len(parts))
    stored = read_table(spark, root, table)
    fresh = _summaries(stored.where(_in_partitions(sorted(present - kept), table)), table)
    columns = [*specs.table_spec(table).series_keys, "day", *coverage.MEASURES]
    if not kept:
        return fresh.select(*columns)
    summed = (
        spark.read.schema(fresh.schema)
        .parquet(_coverage_path(root, table))
        .where(_in_partitions(sorted(kept), table))
        .select(*columns)
    )
    return summed if present == kept else summed.unionByName(fresh.select(*columns))


def create_table(df: DataFrame, root: str, table: str) -> None:
    """First write of a table; rows must satisfy the contract."""
    _write(validate.validate(df, table), root, table, "errorifexists")


def read_table(
    spark: SparkSession,
    root: str,
    table: str,
    symbols: Sequence[str] | None = None,
    intervals: Sequence[str] | None = None,
) -> DataFrame:
    """A stored table, filtered by symbol and interval where given."""
    spec = specs.table_spec(table)
    parts = ", ".join(f"{name} string" for name in _partitions(table) if name != "year")
    parts = parts or "year int"
    plain = [f for f in spec.schema if f.name not in _partitions(table)]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain)
    stored = spark.read.schema(f"{schema}, {parts}").parquet(f"{root}/{table}")
    return scan(stored, symbols, intervals)


def register_views(spark: SparkSession, root: str) -> list[str]:
    """Make every stored table below ``root`` a temporary view for SQL; returns their names."""
    present = [name for name in specs.TABLES if table_exists(spark, root, name)]
    for name in present:
        read_table(spark, root, name).createOrReplaceTempView(name)
    return present


def _typed(df: DataFrame, table: str) -> DataFrame:
    """The table's columns in its types; unknown or missing columns and lost values are refused."""
    problems = validate.column_problems(df, table)
    if problems:
        raise validate.ContractError(f"{table}: {'; '.join(problems)}")
    schema = specs.table_spec(table).schema
    if all(df.schema[f.name].dataType == f.dataType for f in schema):
        return df.select(*specs.table_spec(table).columns)
    typed = validate.coerce(df, table)
    lost = typed.where(F.size("_uncastable") > 0).limit(1).collect()
    if lost:
        raise validate.ContractError(f"{table}: unreadable value in {', '.join(lost[0]['_uncastable'])}")
    return typed.drop("_uncastable")


def _require_contract(found: DataFrame, table: str) -> None:
    """Refuse a write whose stored rows break the table's rules or its keys."""
    broken = found.limit(1).collect()
    if broken:
        raise validate.ContractError(
            f"{table}: rule {broken[0]['rule']} on {broken[0]['column']} broken by {broken[0]['value']!r}"
        )


def _touched(stored: DataFrame, incoming: DataFrame, table: str) -> DataFrame:
    """Stored rows of the very partitions that incoming rows fall into.

    The list of these partitions, a few bytes each, is read on the driver and prunes the scan.
    """
    return stored.where(_in_partitions(_partitions_of(with_partition(incoming, table), table), table))


def _in_partitions(partitions: Sequence[tuple], table: str) -> Column:
    """Whether a row lies in one of these partitions; prunes the scan."""
    parts = _partitions(table)
    groups: dict[tuple, list] = {}
    for values in partitions:
        groups.setdefault(tuple(values[:-1]), []).append(values[-1])
    wanted = F.lit(False)
    for outer, inner in groups.items():
        here = F.col(parts[-1]).isin(*inner)
        for name, value in zip(parts[:-1], outer, strict=True):
            here = here & (F.col(name) == value)
        wanted = wanted | here
    return wanted


def insert_new(spark: SparkSession, root: str, table: str, incoming: DataFrame) -> int:
    """Insert rows whose key is absent and return their number; a rerun inserts none.

    Rows that break the table's contract are refused before anything is written.
    """
    fresh = upsert.dedupe_incoming(_typed(incoming, table), table)
    if table_exists(spark, root, table):
        fresh = materialise(fresh, f"incoming-{table}")
        stored = _touched(read_table(spark, root, table), fresh, table)
        fresh = upsert.absent_rows(fresh, stored, table)
    counted = Observation()
    staged = materialise(
        fresh.observe(counted, F.count(F.lit(1)).alias("rows")), f"insert-{table}"
    )
    inserted = counted.get["rows"]
    if inserted:
        _require_contract(validate.violations(staged, table), table)
        _write(staged, root, table, "append")
    return inserted


def _overwrite_partitions(
    spark: SparkSession, root: str, table: str, content: DataFrame, touched: DataFrame
) -> None:
    """Replace the touched partitions by new content, staged and checked outside the table first."""
    spec = specs.table_spec(table)
    staged = materialise(content.select(*spec.columns), f"replace-{table}")
    _require_contract(validate.violations(staged, table), table)
    emptied = (
        touched.select(*_partitions(table))
        .distinct()
        .join(
            with_partition(staged, table).select(*_partitions(table)).distinct(),
            _partitions(table),
            "left_anti",
        )
    )
    # Partitions left without rows cannot be expressed by an overwrite of rows.
    for row in emptied.collect():
        if keeps_coverage(table):
            _withdraw_coverage(spark, root, table, [tuple(row[name] for name in _partitions(table))])
        folder = "/".join(f"{name}={row[name]}" for name in _partitions(table))
        path, files = _hadoop_path(spark, f"{root}/{table}/{folder}")
        files.delete(path, True)
    _write(staged, root, table, "overwrite")


def replace_days(
    spark: SparkSession, root: str, table: str, incoming: DataFrame, days: DataFrame
) -> None:
    """Replace the candles of every (symbol, interval, day) of ``days``.

    Rows of ``incoming`` outside these days are added; a key that is stored already, or comes
    twice, breaks the contract and nothing is written. The partitions of the days and of the
    incoming rows are rewritten, with all other rows they hold.
    """
    incoming = _typed(incoming, table)
    reach = (
        days.select("interval", F.date_format("day", "yyyy-MM").alias("month"))
        .unionByName(with_partition(incoming, table).select("interval", "month"))
        .distinct()
    )
    touched = read_table(spark, root, table).join(reach, ["interval", "month"], "left_semi")
    content = upsert.replace_days(
        touched.select(*specs.table_spec(table).columns), incoming, days
    )
    _overwrite_partitions(spark, root, table, content, touched)


def merge_rows(spark: SparkSession, root: str, table: str, incoming: DataFrame) -> None:
    """Let rows take the place of stored ones with their key; the other rows stay, new keys are added.

    Doing it again changes nothing. Only partitions that hold incoming rows are rewritten. A key that
    comes twice, or a row that breaks the table's rules, is refused before anything is written.
    """
    fresh = materialise(_typed(incoming, table), f"incoming-{table}")
    if not fresh.isEmpty():
        if table_exists(spark, root, table):
            columns = specs.table_spec(table).columns
            touched = _touched(read_table(spark, root, table), fresh, table)
            kept = upsert.absent_rows(touched.select(*columns), fresh, table)
            _overwrite_partitions(spark, root, table, kept.unionByName(fresh.select(*columns)), touched)
        else:
            _require_contract(validate.violations(fresh, table), table)
            _write(fresh, root, table, "append")
    discard(fresh)


def replace_dates(
    spark: SparkSession, root: str, incoming: DataFrame, dates: DataFrame
) -> None:
    """Replace the snapshots of every date; a date without incoming rows ends up empty."""
    table = "crypto_universe"
    incoming = _typed(incoming, table)
    if not table_exists(spark, root, table):
        staged = materialise(incoming, f"replace-{table}")
        _require_contract(validate.violations(staged, table), table)
        _write(staged, root, table, "errorifexists")
        return
    years = (
        dates.select(F.year("date").alias("year"))
        .unionByName(incoming.select(F.year("date").alias("year")))
        .distinct()
    )
    touched = read_table(spark, root, table).join(years, "year", "left_semi")
    content = upsert.replace_dates(
        touched.select(*specs.table_spec(table).columns), incoming, dates
    )
    _overwrite_partitions(spark, root, table, content, touched)


def prune(
    spark: SparkSession,
    root: str,
    table: str,
    symbols: DataFrame,
    intervals: Sequence[str],
    start: Column,
    end: Column,
) -> int:
    """Remove the symbols' stored candles of the intervals outside ``(start, end]``; their number.

    Only partitions that hold such candles are rewritten.
    """
    stored = read_table(spark, root, table, intervals=intervals)
    marked = symbols.select("symbol", F.lit(True).alias("_ours")).distinct()
    outside = (F.col("timestamp") <= start) | (F.col("timestamp") > end)
    gone = F.coalesce(F.col("_ours"), F.lit(False)) & (F.col("exchange") == specs.EXCHANGE) & outside
    reach = materialise(
        stored.join(marked, "symbol").where(gone).groupBy(*_partitions(table)).agg(F.count("*").alias("_gone")),
        f"prune-{table}",
    )
    removed = reach.agg(F.sum("_gone")).first()[0]
    if not removed:
        return 0
    touched = stored.join(reach, _partitions(table), "left_semi")
    content = touched.join(marked, "symbol", "left").where(~gone)
    _overwrite_partitions(spark, root, table, content, touched)
    return removed


def export(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write a filtered series as parquet or CSV."""
    if fmt not in ("parquet", "csv"):
        raise ValueError(f"unknown export format {fmt!r}")
    writer = df.write.mode("overwrite")
    writer.parquet(path) if fmt == "parquet" else writer.option("header", True).csv(path)
