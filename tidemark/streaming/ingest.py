"""Incremental ingest: archives appearing in a folder are normalised once and upserted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.warehouse import ingest_lines
from tidemark.sources.archives import LINE_SCHEMA, unzip_lines, with_file_parts

BINARY_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def ingest_new_archives(
    spark: SparkSession,
    folder: str,
    root: str,
    table: str,
    checkpoint: str,
    anomaly_path: str | None = None,
    files_per_batch: int = 1_000,
) -> StreamingQuery:
    """Start a run over all archives not ingested yet; it ends when they are done.

    The checkpoint remembers the files. A batch that is repeated after a failure inserts
    nothing twice, because stored keys are left alone and daily files replace their day.
    """
    arriving = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_SCHEMA)
        .option("pathGlobFilter", "*.zip")
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
        .select("path", "content")
    )
    lines = with_file_parts(arriving.mapInPandas(unzip_lines, LINE_SCHEMA), table)
    return _store_lines(lines, root, table, checkpoint, anomaly_path)


def ingest_new_lines(
    spark: SparkSession,
    folder: str,
    root: str,
    table: str,
    checkpoint: str,
    anomaly_path: str | None = None,
    parts_per_batch: int = 1_000,
) -> StreamingQuery:
    """The same over a landing folder of archive lines written by ``archives.stage_lines``."""
    arriving = (
        spark.readStream.schema(LINE_SCHEMA)
        .option("maxFilesPerTrigger", parts_per_batch)
        .parquet(folder)
    )
    return _store_lines(with_file_parts(arriving, table), root, table, checkpoint, anomaly_path)


def _store_lines(
    lines: DataFrame, root: str, table: str, checkpoint: str, anomaly_path: str | None
) -> StreamingQuery:
    def store(batch: DataFrame, _: int) -> None:
        ingest_lines(
            batch.sparkSession, root, table, batch, anomaly_path=anomaly_path, strict=False
        )

    return (
        lines.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
