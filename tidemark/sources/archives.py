"""Archive files: paths by table, and reading CSV text out of plain or zipped files."""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import specs

LINE_SCHEMA = "file string, line_no bigint, line string"
BATCH_LINES = 20_000


def archive_path(
    table: Column | str, symbol: Column, interval: Column, period: Column, is_monthly: Column
) -> Column:
    """Relative path of the archive of one table, symbol, interval and period."""
    table = F.lit(table) if isinstance(table, str) else table
    grain = F.when(is_monthly, "monthly").otherwise("daily")
    market = F.when(table == "spot", "data/spot").otherwise("data/futures/um")
    candle = F.concat(
        market, F.lit("/"), grain, F.lit("/klines/"), symbol, F.lit("/"), interval, F.lit("/"),
        symbol, F.lit("-"), interval, F.lit("-"), period, F.lit(".zip"),
    )
    metrics = F.concat(
        F.lit("data/futures/um/daily/metrics/"), symbol, F.lit("/"),
        symbol, F.lit("-metrics-"), period, F.lit(".zip"),
    )
    funding = F.concat(
        F.lit("data/futures/um/monthly/fundingRate/"), symbol, F.lit("/"),
        symbol, F.lit("-fundingRate-"), period, F.lit(".zip"),
    )
    return (
        F.when(table == "open_interest", metrics)
        .when(table == "funding_rates", funding)
        .otherwise(candle)
    )


def with_file_parts(lines: DataFrame, table: str) -> DataFrame:
    """Add symbol, interval and period taken from the file name."""
    name = F.regexp_extract("file", r"([^/]+)\.(?:zip|csv)$", 1)
    if specs.table_spec(table).kind == "kline":
        pattern = r"^([^-]+)-([^-]+)-(\d{4}-\d{2}(?:-\d{2})?)$"
        interval, period = F.regexp_extract(name, pattern, 2), F.regexp_extract(name, pattern, 3)
    else:
        pattern = r"^([^-]+)-(metrics|fundingRate)-(\d{4}-\d{2}(?:-\d{2})?)$"
        interval, period = F.lit(None).cast("string"), F.regexp_extract(name, pattern, 3)
    return lines.withColumns(
        {
            "symbol": F.regexp_extract(name, pattern, 1),
            "interval": interval,
            "period": period,
        }
    )


def unzip_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lines of the first CSV member of each archive, in batches of bounded size.

    An archive that is broken, holds no CSV, or whose CSV is empty, damaged or no UTF-8 text gives
    one NULL line, by which the file is rejected; the others of the batch go on.
    """
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            try:
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    member = next(m for m in archive.namelist() if m.endswith(".csv"))
                    # Read once without keeping anything: a fault may lie behind the last line.
                    readable = any([bool(text) for text in _blocks(archive, member)])
                    yield from _member_lines(archive, member, path) if readable else [_lines(path, 0, [None])]
            except (StopIteration, ValueError, OSError, EOFError, RuntimeError, zlib.error, zipfile.BadZipFile):
                yield _lines(path, 0, [None])


def _blocks(archive: zipfile.ZipFile, member: str) -> Iterator[str]:
    with archive.open(member) as raw:
        text = io.TextIOWrapper(raw, encoding="utf-8", newline="\n")
        while block := text.read(1 << 20):
            yield block


def _member_lines(archive: zipfile.ZipFile, member: str, path: str) -> Iterator[pd.DataFrame]:
    with archive.open(member) as raw:
        block, start = [], 0
        for text in io.TextIOWrapper(raw, encoding="utf-8", newline="\n"):
            block.append(text.rstrip("\r\n"))
            if len(block) == BATCH_LINES:
                yield _lines(path, start, block)
                start, block = start + len(block), []
        if block:
            yield _lines(path, start, block)


def _lines(path: str, start: int, block: list[str | None]) -> pd.DataFrame:
    return pd.DataFrame(
        {"file": path, "line_no": range(start, start + len(block)), "line": block}
    )


def read_zipped(spark: SparkSession, paths: Sequence[str] | str, table: str) -> DataFrame:
    """Lines of zipped archives; one archive is the unit of parallelism."""
    files = spark.read.format("binaryFile").load(paths).select("path", "content")
    return with_file_parts(
        files.mapInPandas(unzip_lines, LINE_SCHEMA), table
    )


def read_plain(spark: SparkSession, paths: Sequence[str] | str, table: str) -> DataFrame:
    """Lines of plain CSV files, split by the reader.

    Line numbers count up inside a split and splits are ordered by their offset, which gives
    the order of lines in the file without reading any file in one task.
    """
    text = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_offset"),
        F.monotonically_increasing_id().alias("_id"),
        F.col("value").alias("line"),
    )
    # The low 33 bits count records inside a task; they fit beside the split's megabyte number.
    line_no = F.floor(F.col("_offset") / (1 << 20)).cast("bigint") * (1 << 33) + F.col(
        "_id"
    ).bitwiseAND(F.lit((1 << 33) - 1))
    return with_file_parts(text.select("file", line_no.alias("line_no"), "line"), table)


def stage_lines(lines: DataFrame, folder: str) -> None:
    """Append archive lines (file, line_no, line) to a landing folder, each file's in one part."""
    lines.select("file", "line_no", "line").repartition("file").write.mode("append").parquet(folder)
