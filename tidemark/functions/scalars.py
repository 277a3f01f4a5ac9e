"""Column expressions shared by the operators. Everything stays inside codegen."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import specs


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def finite_sql(name: str) -> str:
    """SQL text: a number that is neither NULL, NaN nor infinite. Never NULL itself.

    NaN sorts above every number, so two comparisons cover it.
    """
    return (
        f"coalesce({name} > double('-infinity') AND {name} < double('infinity'), false)"
    )


def positive_sql(name: str) -> str:
    """SQL text: a finite number above zero."""
    return f"coalesce({name} > 0 AND {name} < double('infinity'), false)"


def present(name: str) -> Column:
    return F.expr(finite_sql(name))


def positive(name: str) -> Column:
    return F.expr(positive_sql(name))


def holds(condition: Column) -> Column:
    """A condition with NULL read as false, as a WHERE clause would."""
    return F.coalesce(condition, F.lit(False))


def epoch_micros(ts: Column | str) -> Column:
    return F.unix_micros(as_column(ts).cast("timestamp"))


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since the epoch, rounded down."""
    return F.unix_seconds(as_column(ts).cast("timestamp"))


def epoch_seconds_rounded(ts: Column | str) -> Column:
    """Seconds since the epoch to the nearest second, used for grid offsets."""
    return F.rint(epoch_micros(ts) / F.lit(1_000_000.0)).cast("bigint")


def seconds_between(earlier: Column | str, later: Column | str) -> Column:
    """Number of second boundaries crossed between two timestamps."""
    return epoch_seconds(later) - epoch_seconds(earlier)


def shift_seconds(ts: Column | str, seconds: Column | int) -> Column:
    """Move a timestamp by whole seconds, keeping its zone-less type."""
    seconds = seconds if isinstance(seconds, Column) else F.lit(seconds)
    return as_column(ts) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def ntz_from_seconds(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds).cast("timestamp_ntz")


def ntz_from_micros(micros: Column) -> Column:
    return F.timestamp_micros(micros.cast("bigint")).cast("timestamp_ntz")


def day_after(ts: Column | str, days: int = 1) -> Column:
    return as_column(ts) + F.expr(f"interval {days} day")


def cadence_seconds(interval: Column | str) -> Column:
    """Seconds of a fixed interval label; NULL for variable or unknown labels.

    A literal map instead of a dimension join: fourteen fixed entries need no exchange.
    """
    pairs = [F.lit(item) for pair in specs.INTERVAL_SECONDS.items() for item in pair]
    return F.try_element_at(F.create_map(*pairs), as_column(interval)).cast("bigint")


def interval_label(seconds: Column) -> Column:
    """Compact duration label such as 1d, 4h, 5m or 30s."""
    return (
        F.when(seconds % 86_400 == 0, F.concat((seconds / 86_400).cast("bigint").cast("string"), F.lit("d")))
        .when(seconds % 3_600 == 0, F.concat((seconds / 3_600).cast("bigint").cast("string"), F.lit("h")))
        .when(seconds % 60 == 0, F.concat((seconds / 60).cast("bigint").cast("string"), F.lit("m")))
        .otherwise(F.concat(seconds.cast("string"), F.lit("s")))
    )


def pair_symbol(symbol: Column | str) -> Column:
    return F.concat(as_column(symbol), F.lit(specs.QUOTE_ASSET))


def prefixed_symbol(symbol: Column | str) -> Column:
    return F.concat(F.lit(specs.PREFIX), as_column(symbol))


def accepts_prefix(table: Column | str, symbol: Column | str) -> Column:
    """Whether a symbol without files may be looked up under its 1000-prefixed name."""
    symbol = as_column(symbol)
    base = F.regexp_replace(symbol, f"{specs.QUOTE_ASSET}$", "")
    return (
        (as_column(table) != "spot")
        & ~symbol.startswith(specs.PREFIX)
        & (F.length(base) > 0)
        & ~base.rlike("^[0-9]")
    )


def tag_array(tags: Column | str) -> Column:
    """Comma list to an array of trimmed, lower-cased, non-empty tags."""
    parts = F.transform(F.split(as_column(tags), ","), lambda tag: F.lower(F.trim(tag)))
    return F.filter(parts, lambda tag: tag != "")


def carries_excluded_tag(tags: Column, excluded: Sequence[str] | None = None) -> Column:
    """Exact, case-insensitive match of an array of tags against the excluded list."""
    wanted = specs.EXCLUDED_TAGS if excluded is None else excluded
    wanted = sorted({tag.strip().lower() for tag in wanted if tag})
    if not wanted:
        return F.lit(False)
    normalised = F.transform(tags, lambda tag: F.lower(F.trim(tag)))
    return holds(F.arrays_overlap(normalised, F.array(*[F.lit(tag) for tag in wanted])))


def is_excluded_symbol(symbol: Column | str, excluded: Sequence[str] | None = None) -> Column:
    wanted = specs.EXCLUDED_SYMBOLS if excluded is None else excluded
    wanted = sorted({name.upper() for name in wanted})
    return holds(F.upper(as_column(symbol)).isin(wanted)) if wanted else F.lit(False)


def date_literal(value: date | datetime | str) -> Column:
    if isinstance(value, datetime):
        value = value.date()
    return F.lit(str(value)).cast("date")
