"""Coverage of series by day: summaries that merge, and what can be told from them alone.

A summary is one row for each series and day, so a year of one-minute candles is 365 rows. Minimum,
maximum and number of rows merge by themselves; the widest gap of a longer period is the widest of
its days' gaps and of the steps from one day's last row to the next day's first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import specs
from tidemark.functions.scalars import cadence_seconds, epoch_micros, shift_seconds
from tidemark.operators.upsert import close_day

MEASURES = ("row_count", "first_timestamp", "last_timestamp", "widest_gap")


def day_of(table: str) -> Column:
    """Day of a row as the table's files count it: candles by the instant before their close."""
    if specs.table_spec(table).kind == "kline":
        return close_day("timestamp")
    return F.to_date("timestamp")


def day_summaries(rows: DataFrame, table: str, extra: Sequence[str] = ()) -> DataFrame:
    """(series keys, day, extra; row_count, first_timestamp, last_timestamp, widest_gap).

    ``widest_gap`` is in microseconds between neighbouring times of the day, NULL with one time
    only; copies of a time count as rows and are no gap. ``extra`` columns divide a day further, as
    the partition column of a table does. Copies combine before the shuffle, and the ordered window
    holds the distinct times of one day.
    """
    keys = [*specs.table_spec(table).series_keys, "day", *extra]
    times = (
        rows.withColumn("day", day_of(table))
        .groupBy(*keys, "timestamp")
        .agg(F.count("*").alias("_copies"))
    )
    micros = epoch_micros("timestamp")
    before = F.lag(micros).over(Window.partitionBy(*keys).orderBy("timestamp"))
    return (
        times.withColumn("_gap", micros - before)
        .groupBy(*keys)
        .agg(
            F.sum("_copies").alias("row_count"),
            F.min("timestamp").alias("first_timestamp"),
            F.max("timestamp").alias("last_timestamp"),
            F.max("_gap").alias("widest_gap"),
        )
    )


def _labels(day: Column) -> Column:
    """Month and day as the labels of periods."""
    return F.array(F.date_format(day, "yyyy-MM"), F.date_format(day, "yyyy-MM-dd"))


def period_coverage(days: DataFrame, table: str) -> DataFrame:
    """(symbol, [interval], period) and the measures of every month and day with rows, own exchange only.

    Days may come in several pieces, as long as these do not overlap in time.
    """
    keys = [k for k in specs.table_spec(table).series_keys if k != "exchange"]
    own = days.where(F.col("exchange") == specs.EXCHANGE)
    # One row for each day of a series.
    line = Window.partitionBy(*keys).orderBy("first_timestamp")
    ends = F.lag("last_timestamp").over(line)
    inner = F.col("widest_gap")
    return (
        own.withColumns({"_ended": ends, "_ended_on": F.lag("day").over(line)})
        .withColumn("period", F.explode(_labels(F.col("day"))))
        .withColumn(
            "_step",
            F.when(
                F.date_format("_ended_on", "yyyy-MM-dd").startswith(F.col("period")),
                epoch_micros("first_timestamp") - epoch_micros("_ended"),
            ),
        )
        .groupBy(*keys, "period")
        .agg(
            F.sum("row_count").alias("row_count"),
            F.min("first_timestamp").alias("first_timestamp"),
            F.max("last_timestamp").alias("last_timestamp"),
            # greatest leaves NULLs out.
            F.max(F.greatest(inner, "_step")).alias("widest_gap"),
        )
    )


def candle_completeness(labelled: DataFrame, days: DataFrame, table: str = "spot") -> DataFrame:
    """Candle periods with bounds, row_count and ``complete``, from summaries of days.

    A period is complete when its rows span it without holes in number; with a variable interval
    any row will do.
    """
    step = cadence_seconds("interval")
    spanned = epoch_micros("last_timestamp") - epoch_micros("first_timestamp")
    covered = (
        (F.col("row_count") >= F.floor(spanned / (step * 1_000_000)).cast("bigint") + 1)
        & (F.col("first_timestamp") <= shift_seconds("period_start", step))
        & (F.col("last_timestamp") >= F.col("period_end"))
    )
    stored = period_coverage(days, table)
    complete = F.when(F.col("row_count").isNull(), False).when(step.isNull(), True).otherwise(covered)
    return _joined(labelled, stored, ["symbol", "interval", "period"], complete)


def metric_completeness(labelled: DataFrame, days: DataFrame, table: str) -> DataFrame:
    """Metric periods with bounds, row_count and ``complete``: two rows at least, edges, no wide gap."""
    cadence = specs.table_spec(table).cadence_seconds
    # Copies of one timestamp are zero apart, which makes a gap of zero known.
    widest = F.coalesce("widest_gap", F.when(F.col("row_count") > 1, F.lit(0)))
    covered = (
        (F.col("row_count") >= 2)
        & (F.col("first_timestamp") <= shift_seconds("period_start", cadence))
        & (F.col("last_timestamp") >= shift_seconds("period_end", -cadence))
        & (widest <= cadence * 1_000_000)
    )
    return _joined(labelled, period_coverage(days, table), ["symbol", "period"], covered)


def _joined(labelled: DataFrame, stored: DataFrame, keys: list[str], complete: Column) -> DataFrame:
    return labelled.join(stored, keys, "left").withColumns(
        {
            "row_count": F.coalesce("row_count", F.lit(0).cast("bigint")),
            "complete": F.coalesce(complete, F.lit(False)),
        }
    ).drop("widest_gap")


def availability_of_days(
    tables: Mapping[str, DataFrame], interval: str, symbols: Sequence[str] | None = None
) -> DataFrame:
    """First and last stored day per symbol and table, from summaries of days."""
    result = None
    for name, days in tables.items():
        rows = days.where(F.col("exchange") == specs.EXCHANGE)
        if specs.table_spec(name).kind == "kline":
            rows = rows.where(F.col("interval") == interval)
        if symbols:
            rows = rows.where(F.col("symbol").isin(*symbols))
        part = rows.groupBy("symbol").agg(
            F.lit(name).alias("data_type"),
            F.to_date(F.min("first_timestamp")).alias("first_date"),
            F.to_date(F.max("last_timestamp")).alias("last_date"),
        )
        result = part if result is None else result.unionByName(part)
    return result.orderBy("symbol", "data_type")


def series_totals(days: DataFrame, table: str) -> DataFrame:
    """(series keys; row_count, first_timestamp, last_timestamp) of every series, from summaries of days."""
    return days.groupBy(*specs.table_spec(table).series_keys).agg(
        F.sum("row_count").alias("row_count"),
        F.min("first_timestamp").alias("first_timestamp"),
        F.max("last_timestamp").alias("last_timestamp"),
    )
