"""Findings: from typed check results to report rows, ordering, counts and text lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import specs

COLUMNS = specs.FINDING_SCHEMA.fieldNames()
RESULT_COLUMNS = ("symbol", "interval", "bad_count", "first_timestamp", "last_timestamp")


def to_findings(
    results: DataFrame,
    table: str,
    check_name: str,
    severity: str,
    message: Column,
    metadata: Sequence[str] = (),
) -> DataFrame:
    """Turn the typed rows of one check into findings; ``metadata`` columns become JSON."""
    have = set(results.columns)

    def column(name: str, kind: str) -> Column:
        return F.col(name).cast(kind) if name in have else F.lit(None).cast(kind)

    details = F.to_json(F.struct(*metadata)) if metadata else F.lit("{}")
    return results.select(
        F.lit(severity).alias("severity"),
        F.lit(table).alias("table"),
        F.lit(check_name).alias("check_name"),
        message.alias("message"),
        F.col("bad_count").cast("bigint").alias("count"),
        column("symbol", "string").alias("symbol"),
        column("interval", "string").alias("interval"),
        column("first_timestamp", "timestamp_ntz").alias("first_timestamp"),
        column("last_timestamp", "timestamp_ntz").alias("last_timestamp"),
        details.alias("metadata"),
    )


def counted(text: str) -> Column:
    """Message made of the row count and a fixed text."""
    return F.concat(F.col("bad_count").cast("string"), F.lit(f" {text}"))


def empty_findings(spark) -> DataFrame:
    return spark.createDataFrame([], specs.FINDING_SCHEMA)


def missing_table_finding(spark, table: str) -> DataFrame:
    """The report row for a table that does not exist."""
    row = ("ERROR", table, "missing_table", f"Table '{table}' does not exist", 1)
    return spark.createDataFrame([(*row, None, None, None, None, "{}")], specs.FINDING_SCHEMA)


def contract_breaks(findings: DataFrame) -> DataFrame:
    """Findings that break the report contract: severity, table, required fields, count."""
    known = F.col("severity").isin(*specs.SEVERITIES) & F.col("table").isin(*specs.TABLES)
    filled = (
        F.col("check_name").isNotNull() & F.col("message").isNotNull() & (F.col("count") >= 0)
    )
    return findings.where(~F.coalesce(known & filled, F.lit(False)))


def report_order(findings: DataFrame) -> DataFrame:
    """Errors first, then table, symbol, interval and check."""
    return findings.orderBy(
        F.when(F.col("severity") == "ERROR", 0).otherwise(1),
        "table",
        F.coalesce("symbol", F.lit("")),
        F.coalesce("interval", F.lit("")),
        "check_name",
    )


def severity_counts(findings: DataFrame, fail_on_warning: bool = False) -> DataFrame:
    """One row: number of errors and warnings, and whether the audit passes."""
    failing = F.col("errors") == 0
    if fail_on_warning:
        failing = failing & (F.col("warnings") == 0)
    return findings.agg(
        F.count_if(F.col("severity") == "ERROR").alias("errors"),
        F.count_if(F.col("severity") == "WARN").alias("warnings"),
    ).withColumn("passed", failing)


def report_lines(findings: DataFrame) -> DataFrame:
    """One text line per finding, in report order."""
    scope = F.concat_ws(
        " ",
        "table",
        F.when(F.col("symbol") != "", F.col("symbol")),
        F.when(F.col("interval") != "", F.col("interval")),
    )
    line = F.concat(
        F.lit("["),
        F.col("severity"),
        F.lit("] "),
        scope,
        F.lit(" "),
        F.col("check_name"),
        F.lit(": "),
        F.col("message"),
        F.lit(" (count="),
        F.col("count").cast("string"),
        F.lit(")"),
    )
    return report_order(findings).select(line.alias("line"))


def rollup(findings: DataFrame) -> DataFrame:
    """Findings and affected rows per severity, table and check, largest first."""
    return (
        findings.groupBy("severity", "table", "check_name")
        .agg(F.count("*").alias("findings"), F.sum("count").alias("rows"))
        .orderBy("severity", F.col("rows").desc())
    )


def anomalies_to_findings(
    anomalies: DataFrame,
    tables: Sequence[str] | None = None,
    symbols: Sequence[str] | None = None,
    intervals: Sequence[str] | None = None,
    source: str | None = None,
) -> DataFrame:
    """Import anomalies as warnings, filtered by table, symbol and interval."""
    table = F.coalesce(
        F.when(F.col("table") != "", F.col("table")), F.col("table_name")
    )
    wanted = tuple(tables) if tables else tuple(specs.TABLES)
    for name in wanted:
        specs.table_spec(name)
    kept = anomalies.withColumn("_table", table).where(F.col("_table").isin(*wanted))
    if symbols:
        kept = kept.where(F.col("symbol").isin(*symbols))
    if intervals:
        kept = kept.where(F.col("interval").isin(*intervals))
    count = F.coalesce("count", F.lit(0)).cast("bigint")
    context = F.create_map(
        F.lit("period"),
        F.col("period"),
        F.lit("source_file"),
        F.col("source_file"),
        F.lit("event_timestamp"),
        F.col("event_timestamp"),
        F.lit("report_path"),
        F.lit(source).cast("string"),
    )
    own = F.coalesce("metadata", F.create_map().cast("map<string,string>"))
    # Context wins over metadata of the same name, whatever the session's map policy is.
    own = F.map_filter(own, lambda key, _: ~F.array_contains(F.map_keys(context), key))
    return kept.select(
        F.lit("WARN").alias("severity"),
        F.col("_table").alias("table"),
        F.coalesce(F.when(F.col("check_name") != "", F.col("check_name")), F.lit("import_anomaly")).alias(
            "check_name"
        ),
        F.concat(
            count.cast("string"), F.lit(" rows were handled during import before database insert")
        ).alias("message"),
        count.alias("count"),
        "symbol",
        "interval",
        F.lit(None).cast("timestamp_ntz").alias("first_timestamp"),
        F.lit(None).cast("timestamp_ntz").alias("last_timestamp"),
        F.to_json(F.map_concat(own, context)).alias("metadata"),
    )
