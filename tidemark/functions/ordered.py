"""Ordered functions over a series that may hold a large share of all rows.

A plain ``Window.partitionBy(series)`` sends a whole series to one task. Here every series is
cut into time slices and the window runs inside each slice. Only the first rows of a slice can
need rows of an earlier one, so just the head and tail rows of every slice are put through a
second window per series: a few rows out of thousands. Both passes read the same shuffle.

Slices are sized in cadence steps, so a slice of a contract-conforming series holds at most
``SLICE_STEPS`` distinct timestamps; callers collapse copies of a row before ordering.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.scalars import epoch_seconds, seconds_between

SLICE_STEPS = 4_096
SLICE = "_slice"
DEFAULT_STEP_SECONDS = 3_600


def time_slice(ts: Column | str, step_seconds: Column | int | None) -> Column:
    """Slice number of a timestamp: ``SLICE_STEPS`` cadence steps per slice."""
    step = step_seconds if isinstance(step_seconds, Column) else F.lit(step_seconds)
    width = F.coalesce(step.cast("bigint"), F.lit(DEFAULT_STEP_SECONDS)) * SLICE_STEPS
    return F.floor(epoch_seconds(ts) / width).cast("bigint")


def with_trailing(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    reach: int,
    outputs: Mapping[str, Callable[[WindowSpec], Column]],
    slice_by: Column,
) -> DataFrame:
    """Add window results that look at most ``reach`` rows back within ``keys``.

    ``outputs`` maps a column name to a function of the ordered window. The slice must be a
    non-decreasing function of ``order`` inside a series.
    """
    names = list(outputs)
    inside = Window.partitionBy(*keys, SLICE).orderBy(*order)
    whole = Window.partitionBy(*keys).orderBy(*order)
    mark = F.lit(True)
    local = df.withColumn(SLICE, slice_by).withColumns(
        {
            "_head": F.lag(mark, reach).over(inside).isNull(),
            "_tail": F.lead(mark, reach).over(inside).isNull(),
            **{name: build(inside) for name, build in outputs.items()},
        }
    )
    border = local.drop(*names).where(F.col("_head") | F.col("_tail"))
    heads = border.withColumns({name: build(whole) for name, build in outputs.items()}).where(
        "_head"
    )
    return local.where(~F.col("_head")).unionByName(heads).drop("_head", "_tail", SLICE)


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    slice_by: Column,
    prefix: str = "prev_",
) -> DataFrame:
    """Add the previous row's ``values`` in ``order`` within ``keys``."""
    outputs = {prefix + v: (lambda w, v=v: F.lag(v).over(w)) for v in values}
    return with_trailing(df, keys, order, 1, outputs, slice_by)


def runs_of(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    member: str,
    step_seconds: Column,
    slice_by: Column,
    peaks: Sequence[str] = (),
) -> DataFrame:
    """Runs of ``member`` rows exactly one step apart with no other row in between.

    ``order`` starts with the timestamp. One row per run: first and last timestamp, number of
    observations and the maximum of every column in ``peaks``. Runs are built inside slices;
    only pieces that touch a slice border are then chained over the series.
    """
    keys, time = list(keys), order[0]
    inside = Window.partitionBy(*keys, SLICE).orderBy(*order)
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def linked(earlier: Column, later: Column) -> Column:
        return F.coalesce(seconds_between(earlier, later) == step_seconds, F.lit(False))

    rows = (
        df.withColumn(SLICE, slice_by)
        .withColumns(
            {
                "_before": F.lag(F.struct(F.col(time).alias("at"), F.col(member).alias("on"))).over(
                    inside
                ),
                "_tail": F.lead(F.lit(True)).over(inside).isNull(),
            }
        )
        .where(member)
    )
    joined = F.coalesce("_before.on", F.lit(False)) & linked(F.col("_before.at"), F.col(time))
    pieces = (
        rows.withColumn("_head", F.col("_before").isNull())
        .withColumn("_starts", F.when(joined, 0).otherwise(1))
        .withColumn("_piece", F.sum("_starts").over(running))
        .groupBy(*keys, SLICE, "_piece")
        .agg(
            F.min(time).alias("first_timestamp"),
            F.max(time).alias("last_timestamp"),
            F.count("*").alias("observations"),
            F.bool_or("_head").alias("_head"),
            F.bool_or("_tail").alias("_tail"),
            *[F.max(name).alias(name) for name in peaks],
        )
    )
    results = [*keys, "first_timestamp", "last_timestamp", "observations", *peaks]
    chain = Window.partitionBy(*keys).orderBy(SLICE, "_piece")
    so_far = chain.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = (
        F.col("_head")
        & F.coalesce(F.lag("_tail").over(chain), F.lit(False))
        & linked(F.lag("last_timestamp").over(chain), F.col("first_timestamp"))
    )
    border = (
        pieces.where(F.col("_head") | F.col("_tail"))
        .withColumn("_opens", F.when(carried, 0).otherwise(1))
        .withColumn("_chain", F.sum("_opens").over(so_far))
        .groupBy(*keys, "_chain")
        .agg(
            F.min("first_timestamp").alias("first_timestamp"),
            F.max("last_timestamp").alias("last_timestamp"),
            F.sum("observations").alias("observations"),
            *[F.max(name).alias(name) for name in peaks],
        )
    )
    inner = pieces.where(~F.col("_head") & ~F.col("_tail"))
    return inner.select(*results).unionByName(border.select(*results))
