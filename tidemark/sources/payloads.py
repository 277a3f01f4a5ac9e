"""Saved payloads of request-based sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import normalize


def read_candle_payloads(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """Candle rows of files named SYMBOL-interval….json, each one JSON array of arrays."""
    text = spark.read.text(paths, wholetext=True).select(
        F.regexp_extract(F.col("_metadata.file_name"), r"^([^-]+)-([^-.]+)", 1).alias("symbol"),
        F.regexp_extract(F.col("_metadata.file_name"), r"^([^-]+)-([^-.]+)", 2).alias("interval"),
        F.col("value").alias("payload"),
    )
    return normalize.candle_payload_rows(text)


def read_funding_payloads(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """Funding rows of files named SYMBOL….json, each one JSON array of objects."""
    text = spark.read.text(paths, wholetext=True).select(
        F.regexp_extract(F.col("_metadata.file_name"), r"^([^-.]+)", 1).alias("symbol"),
        F.col("value").alias("payload"),
    )
    return normalize.funding_payload_rows(text)


def read_listings(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """Universe rows of listing files named YYYY-MM-DD….json with a ``data`` array."""
    shape = f"data array<{normalize.LISTING_SHAPE}>"
    files = (
        spark.read.schema(shape)
        .option("multiLine", True)
        .json(paths)
        .select(
            F.to_date(F.regexp_extract(F.col("_metadata.file_name"), r"^(\d{4}-\d{2}-\d{2})", 1)).alias(
                "date"
            ),
            "data",
        )
    )
    return normalize.listing_rows(files)
