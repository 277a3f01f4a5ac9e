"""Places and wide rolling figures in series of any length and any spacing of times.

Slices are bounded by counts, not by time: a slice with too many rows is divided at the extent of
its own times, again and again, and where one time has too many rows (or the time is NULL) at the
next column of the order. Offsets of slices give each row its place in the series, and places cut
a series into blocks of equal size, from which a wide window is put together: what is left of the
rows that drop out inside its block, the rows between, and the start of the block.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import ordered
from tidemark.functions.quantiles import join_group_stats, ordered_key
from tidemark.functions.scalars import epoch_micros
from tidemark.session import discard, materialise

#: Parts a slice with too many rows is divided into.
FAN = 16
POSITION = "_position"
SLICE = ordered.SLICE


def _slicing_key(df: DataFrame, name: str) -> Column:
    """A 63-bit integer that never decreases along the column's order."""
    kind = dict(df.dtypes)[name]
    if kind.startswith("timestamp"):
        return epoch_micros(name)
    if kind in ("double", "float"):
        return F.when(F.col(name).isNotNull(), F.shiftright(ordered_key(name), 1))
    return F.shiftright(F.col(name).cast("bigint"), 1)


def with_counted_slices(
    stored: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    step_seconds: Column,
    limit: int | None = None,
) -> DataFrame:
    """Add slices of at most ``limit`` rows (``ordered.SLICE_STEPS``) that follow ``order``.

    ``order`` starts with the time; its columns are times and numbers. The slice is an array that
    never decreases along the order. Counting starts from the slices by cadence, so a series that
    keeps its cadence is counted once and left as it is. Only rows equal in all of ``order`` stay
    together whatever their number. ``stored`` is read once a round; keys are not NULL.
    """
    keys, limit = list(keys), limit or ordered.SLICE_STEPS
    names = [f"_key{i}" for i in range(len(order))]
    rows = stored.withColumns(
        {SLICE: F.array(ordered.time_slice(order[0], step_seconds))} | {n: _slicing_key(stored, c) for n, c in zip(names, order, strict=True)}
    )
    for name in names:
        key = F.col(name)
        while True:
            full = materialise(
                rows.groupBy(*keys, SLICE)
                .agg(F.count("*").alias("_rows"), F.min(key).alias("_least"), F.max(key).alias("_most"), F.count_if(key.isNull()).alias("_empty"))
                .where(F.col("_rows") > limit),
                "full-slices",
            )
            if full.isEmpty():
                discard(full)
                return rows.drop(*names)
            # A slice of one value besides NULLs is divided too, by the NULLs.
            divisible = F.coalesce((F.col("_most") > F.col("_least")) | (F.col("_empty") > 0), F.lit(False)) & F.col("_least").isNotNull()
            divided = materialise(full.where(divisible).drop("_empty"), "divided-slices")
            discard(full)
            if divided.isEmpty():
                discard(divided)
                break
            width = F.floor((F.col("_most") - F.col("_least")) / FAN).cast("bigint") + 1
            part = F.floor((key - F.col("_least")) / width).cast("bigint")
            rows = (
                join_group_stats(rows, divided, [*keys, SLICE], order, "left", size="_rows")
                .withColumn(SLICE, F.when(F.col("_rows").isNull(), F.col(SLICE)).otherwise(F.concat(SLICE, F.array(part))))
                .drop("_rows", "_least", "_most")
            )
    return rows.drop(*names)


def with_positions(
    stored: DataFrame, keys: Sequence[str], order: Sequence[str], step_seconds: Column
) -> DataFrame:
    """Add each row's place in its series, from 0; rows equal in ``order`` follow in any order.

    Rows are ordered inside slices only. One row a slice goes through a window of the series.
    """
    return _placed(stored, list(keys), order, step_seconds).drop("_nth", "_n", SLICE)


def _placed(
    stored: DataFrame, keys: list[str], order: Sequence[str], step_seconds: Column, previous: Mapping[str, str] | None = None
) -> DataFrame:
    """Rows with POSITION, place in the slice (from 1) and rows of the slice.

    ``previous`` maps new columns to those whose value they take from the row before in the slice;
    they come from the very ordering that the places come from, as equal rows may be ordered anew.
    """
    rows = with_counted_slices(stored, keys, order, step_seconds)
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(*keys, SLICE)
        .agg(F.count("*").alias("_n"))
        .select(*keys, SLICE, "_n", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy(*keys, SLICE).orderBy(*order)
    before = {name: F.lag(value).over(inside) for name, value in (previous or {}).items()}
    return (
        rows.withColumns({"_nth": F.row_number().over(inside).cast("bigint"), **before})
        .join(offsets, [*keys, SLICE])
        .withColumn(POSITION, F.col("_offset") + F.col("_nth") - 1)
        .drop("_offset")
    )


def with_positions_and_previous(
    stored: DataFrame, keys: Sequence[str], order: Sequence[str], step_seconds: Column, value: str, prefix: str = "prev_"
) -> DataFrame:
    """``with_positions``, and the value of the row before, from one ordering of the rows.

    The rows are kept in the shared folder. Only first and last rows of slices go through a window
    of the series, to give the first ones the value of the slice before.
    """
    keys, name = list(keys), prefix + value
    placed = _placed(stored, keys, order, step_seconds, {name: value})
    ends = {"_first": F.col("_nth") == 1, "_last": F.col("_nth") == F.col("_n")}
    kept = materialise(placed.withColumns(ends).drop("_nth", "_n", SLICE), "places")
    whole = Window.partitionBy(*keys).orderBy(POSITION)
    heads = kept.where(F.col("_first") | F.col("_last")).withColumn(name, F.lag(value).over(whole)).where("_first")
    return kept.where(~F.col("_first")).unionByName(heads).drop("_first", "_last")


def block_of(position: Column | str) -> Column:
    return F.floor((F.col(position) if isinstance(position, str) else position) / ordered.SLICE_STEPS).cast("bigint")


def _moments(value: Column, over: Callable[[Column], Column] = lambda figure: figure) -> Column:
    """Number, mean and sum of squared distances from the mean; NULLs are left out."""
    number = over(F.count(value))
    return F.struct(
        number.alias("n"),
        F.coalesce(over(F.avg(value)), F.lit(0.0)).alias("mean"),
        F.coalesce(over(F.var_pop(value)) * number, F.lit(0.0)).alias("m2"),
    )


def _nothing() -> Column:
    return F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))


def _merged(a: Column, b: Column) -> Column:
    """Moments of two sets of values from their moments, without differences of large sums."""
    number, apart = a["n"] + b["n"], b["mean"] - a["mean"]
    some = F.greatest(number, F.lit(1))
    return F.struct(
        number.alias("n"),
        (a["mean"] + apart * b["n"] / some).alias("mean"),
        (a["m2"] + b["m2"] + apart * apart * (a["n"].cast("double") * b["n"]) / some).alias("m2"),
    )


def rolling_deviation(
    df: DataFrame, keys: Sequence[str], value: str, width: int, name: str
) -> DataFrame:
    """Add the sample deviation of ``value`` over the last ``width`` rows by POSITION.

    ``width`` exceeds a block. All windows that end in a block share the rows between its edge and
    its start: the edge are the rows that drop out of the window inside the block. So a row goes to
    its own block and, with its value alone, to the block that it drops out of; there a window is the
    rest of the edge, the rows between and the start of the block. Both go through one shuffle, and a
    block holds two blocks of rows at most, so a long series is spread like many short ones. Edges
    and block borders cut the series into two parts a block, whose moments give what lies between:
    two merges of width / block parts a block. ``df`` is read three times, the result is kept in the
    shared folder.
    """
    keys, size = list(keys), ordered.SLICE_STEPS
    if width <= size:
        raise ValueError(f"a window of {width} rows is no wider than a block of {size}")
    dropped = F.col(POSITION) + (width - 1)
    parts = df.groupBy(*keys, block_of(POSITION).alias("_from"), block_of(dropped).alias("_to")).agg(
        _moments(F.col(value)).alias("_part")
    )
    between = (
        parts.where(F.col("_to") - F.col("_from") > 1)
        .withColumn("_block", F.explode(F.sequence(F.col("_from") + 1, F.col("_to") - 1)))
        .groupBy(*keys, "_block")
        .agg(F.sort_array(F.collect_list(F.struct("_from", "_to", "_part"))).alias("_parts"))
        .select(*keys, "_block", F.aggregate("_parts", _nothing(), lambda so_far, part: _merged(so_far, part["_part"])).alias("_between"))
    )
    edges = df.select(*keys, dropped.alias(POSITION), value, F.lit(False).alias("_own"))
    rows = df.withColumn("_own", F.lit(True)).unionByName(edges, allowMissingColumns=True).withColumn("_block", block_of(POSITION))
    block = Window.partitionBy(*keys, "_block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Upwards the block so far; downwards the edge that is left, a row's last value before the row.
    start = _moments(F.when(F.col("_own"), F.col(value)), lambda figure: figure.over(block.orderBy(POSITION)))
    rest = _moments(F.when(~F.col("_own"), F.col(value)), lambda figure: figure.over(block.orderBy(F.col(POSITION).desc(), "_own")))
    total = _merged(_merged(F.col("_rest"), F.coalesce("_between", _nothing())), F.col("_start"))
    found = (
        rows.withColumns({"_start": start, "_rest": rest})
        .where("_own")
        .join(between, [*keys, "_block"], "left")
        .withColumn("_total", total)
        .withColumn(name, F.when(F.col("_total.n") > 1, F.sqrt(F.col("_total.m2") / F.greatest(F.col("_total.n") - 1, F.lit(1)))))
        .select(*df.columns, name)
    )
    return materialise(found, "deviations")
