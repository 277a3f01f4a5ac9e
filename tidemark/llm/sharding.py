"""Shards of equal row counts along a Hilbert curve over several metadata columns.

Rows near each other in all the chosen columns come near each other on the curve, so every shard
covers a small range of each column and a reader can skip files by their minimum and maximum.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tidemark.llm.hilbert import hilbert_index
from tidemark.session import discard, materialise


def value_cells(df: DataFrame, column: str, cells: int = 64) -> Column:
    """A number for each text of a column that orders whole values and holds like shares of rows.

    Values are counted, put in order over several tasks, and cut where the rows below a value pass
    a multiple of rows / cells. Only the least value of each cell, ``cells`` at most, reaches the
    driver. Null comes first.
    """
    running = W.partitionBy("__part").orderBy("__v").rowsBetween(W.unboundedPreceding, -1)
    counted = materialise(
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("__v"))
        .agg(F.count("*").alias("__n"))
        .repartitionByRange("__v")
        .withColumn("__part", F.spark_partition_id()),
        "values",
    )
    # One row for each partition.
    parts = counted.groupBy("__part").agg(F.min("__v").alias("__first"), F.sum("__n").alias("__held"))
    earlier = W.orderBy("__first").rowsBetween(W.unboundedPreceding, -1)
    everything = W.orderBy("__first").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    placed = parts.select(
        "__part", F.coalesce(F.sum("__held").over(earlier), F.lit(0)).alias("__before"), F.sum("__held").over(everything).alias("__all")
    )
    below = F.coalesce(F.sum("__n").over(running), F.lit(0)) + F.col("__before")
    cell = F.expr(f"__below * {int(cells)} div __all")
    least = counted.join(placed, "__part").withColumn("__below", below).groupBy(cell.alias("__cell")).agg(F.min("__v").alias("__v"))
    cuts = sorted((row["__v"] for row in least.collect()), key=lambda v: v.encode())
    discard(counted)
    if not cuts:
        return F.lit(-1.0)
    passed = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: cut <= F.col(column)))
    return F.when(F.col(column).isNull(), F.lit(-1.0)).otherwise(passed.cast("double"))


def curve_key(df: DataFrame, dimensions: Mapping[str, Column], bits: int) -> Column:
    """Position on the curve of each row's cell.

    Each dimension is cut at approximate quantiles of all rows, so cells hold like numbers of rows
    whatever the distribution. The cuts (2 ** bits - 1 numbers a dimension) are all that the
    driver sees. Null and NaN count as the least value.
    """
    shares = [(i + 1) / (1 << bits) for i in range((1 << bits) - 1)]
    value = lambda c: F.when(c.isNull() | F.isnan(c.cast("double")), F.lit(-1.7e308)).otherwise(c.cast("double"))
    found = df.agg(*[F.percentile_approx(value(c), shares, 10_000).alias(n) for n, c in dimensions.items()]).first()
    cuts = [np.asarray(found[n] or [], dtype=float) for n in dimensions]

    @F.pandas_udf(T.LongType())
    def position(row: pd.DataFrame) -> pd.Series:
        cells = np.stack(
            [np.searchsorted(cut, row[f"d{i}"].to_numpy(dtype=float), side="right") for i, cut in enumerate(cuts)], axis=1
        )
        return pd.Series(hilbert_index(cells, bits))

    return position(F.struct(*[value(c).alias(f"d{i}") for i, c in enumerate(dimensions.values())]))


def shard_along_curve(
    df: DataFrame, dimensions: Mapping[str, Column], tie_break: Sequence[str], shards: int = 24, bits: int = 6
) -> DataFrame:
    """The rows with curve_key, shard (0 to shards - 1) and slot (gapless from 0 in each shard).

    Rows are range-partitioned by (curve position, tie_break), numbered within each partition, and
    the runs between ranks i * rows / shards are the shards: their counts differ by one at most.
    A hot cell is split by the columns of ``tie_break``. Rows equal in all of these are
    exchangeable. Fewer rows than shards leave shards empty; an empty table gives no rows. Input
    columns named like an output column are replaced.
    """
    kept = [c for c in df.columns if c not in ("curve_key", "shard", "slot")]
    keyed = df.withColumn("__key", curve_key(df, dimensions, bits))
    order = ["__key", *tie_break]
    # Stored: the numbering below must see the very partitions that were counted.
    placed = materialise(
        keyed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()),
        "curve",
    ).withColumn("__part", F.shiftright("__at", 33))
    # One row for each partition.
    everything = W.orderBy("__p").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    running = W.orderBy("__p").rowsBetween(W.unboundedPreceding, -1)
    starts = materialise(
        placed.groupBy(F.col("__part").alias("__p"))
        .agg(F.count("*").alias("n"))
        .select("__p", F.coalesce(F.sum("n").over(running), F.lit(0)).alias("__before"), F.sum("n").over(everything).alias("__all")),
        "starts",
    )
    ranked = placed.join(starts, F.col("__part") == F.col("__p")).withColumn(
        "__rank", F.col("__before") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    )
    shard = F.expr(f"__rank * {int(shards)} div __all")
    first = F.expr(f"(shard * __all + {int(shards) - 1}) div {int(shards)}")
    return ranked.withColumn("shard", shard).select(
        *[placed[c] for c in kept],
        F.col("__key").alias("curve_key"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("__rank") - first).alias("slot"),
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder for each shard, rows in slot order, so that each file covers a small range."""
    sharded.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
