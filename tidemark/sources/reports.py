"""Findings and anomaly files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import specs
from tidemark.operators import findings as fd
from tidemark.session import materialise


def append_anomalies(anomalies: DataFrame, path: str) -> None:
    """Append anomalies with a positive count to a JSON-lines folder."""
    anomalies.where(F.col("count") > 0).write.mode("append").json(path)


def read_anomalies(spark: SparkSession, path: str) -> DataFrame:
    """Anomaly records; blank lines are skipped, a malformed line is an error."""
    return (
        spark.read.schema(specs.ANOMALY_SCHEMA).option("mode", "FAILFAST").json(path)
    )


def anomaly_findings(
    spark: SparkSession,
    path: str,
    tables: Sequence[str] | None = None,
    symbols: Sequence[str] | None = None,
    intervals: Sequence[str] | None = None,
) -> DataFrame:
    """Anomaly records of a JSON-lines folder as warnings."""
    return fd.anomalies_to_findings(
        read_anomalies(spark, path), tables, symbols, intervals, source=path
    )


def write_findings(findings: DataFrame, path: str) -> None:
    """Write a findings report as JSON, refusing rows that break the report contract.

    The findings are computed once, into the shared folder, and checked and published from there.
    """
    staged = materialise(findings, "findings")
    if fd.contract_breaks(staged).limit(1).count():
        raise ValueError("findings break the report contract")
    staged.write.mode("overwrite").json(path)


def read_findings(
    spark: SparkSession, path: str, anomalies: str | None = None
) -> DataFrame:
    """A findings report, with import anomalies if given; absent columns read as NULL.

    The report is JSON lines or one JSON array; anything else is an error. An array is read as one
    value, so it is for reports of a single tool; a folder of lines has no such limit.
    """
    first = spark.read.text(path).where(F.trim("value") != "").limit(1).collect()
    array = bool(first) and first[0][0].lstrip().startswith("[")
    report = (
        spark.read.schema(specs.FINDING_SCHEMA)
        .option("mode", "FAILFAST")
        .option("multiLine", array)
        .json(path)
    )
    if anomalies is not None:
        report = report.unionByName(
            anomaly_findings(spark, anomalies), allowMissingColumns=True
        )
    return report.withColumns(
        {
            "count": F.coalesce("count", F.lit(0).cast("bigint")),
            "metadata": F.coalesce("metadata", F.lit("{}")),
        }
    )
