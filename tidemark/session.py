"""Session settings the operators rely on, and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    # Stored timestamps are zone-less UTC; epoch arithmetic needs a UTC session.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join is split even when the aggregate above then needs an exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Unions must not promise a partitioning that adaptive re-planning may change under them.
    "spark.sql.unionOutputPartitioning": "false",
    # Only the partitions present in a write are replaced.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session, hand it the package, and return it."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once for each context, wherever the driver found it."""
    context = spark.sparkContext
    if any("/tidemark-code" in path for path in context.listFiles):
        return
    package = Path(__file__).resolve().parent
    if not package.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="spark-")) / "tidemark-code.zip"
    with zipfile.ZipFile(archive, "w") as code:
        for source in sorted(package.rglob("*.py")):
            code.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder.

    Where none is set, a session whose tasks all run in the driver's own process (a local master)
    gets a temporary one; any other session is refused, as its executors would not share it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", ""
    )
    if configured:
        return configured.rstrip("/")
    existing = spark.sparkContext.getCheckpointDir()
    if existing:
        return existing.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir is not set; intermediate tables need a folder that all executors share")
    local = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back, cutting its lineage.

    The stored copy survives lost executors and gives the planner its real size, which is
    what decides whether a join against it may be broadcast.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored._stored_at = path
    return stored


def stored_bytes(stored: DataFrame) -> int:
    """Size on disk of a copy made by ``materialise``."""
    context = stored.sparkSession.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(stored._stored_at)
    return path.getFileSystem(context._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


def discard(*stored: DataFrame) -> None:
    """Remove copies made by ``materialise`` that nothing reads any more."""
    for df in stored:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df._stored_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
