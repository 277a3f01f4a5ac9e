"""Comparing two copies of a table, and sampling rows to compare."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import cadence_seconds, epoch_micros
from tidemark.operators import upsert
from tidemark.session import materialise


@dataclass(frozen=True)
class Tolerance:
    """Largest accepted difference; relative ones are measured against the source value."""

    limit: float
    relative: bool = False


# Fixed comparison tolerances.
CANDLE_TOLERANCES = {
    "open": Tolerance(1e-8),
    "high": Tolerance(1e-8),
    "low": Tolerance(1e-8),
    "close": Tolerance(1e-8),
    "volume": Tolerance(1e-4, relative=True),
    "quote_volume": Tolerance(1e-4, relative=True),
    "trades_count": Tolerance(0),
}
UNIVERSE_TOLERANCES = {
    "rank": Tolerance(0),
    "market_cap": Tolerance(0.01, relative=True),
}


def _side_by_side(stored: DataFrame, source: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """One row for each key of either side, with the fields of both as structs."""

    def one(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.min(F.struct(*fields)).alias(name))

    return one(stored, "_stored").join(one(source, "_source"), keys, "full_outer")


def skipped(
    stored: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    tolerances: Mapping[str, Tolerance],
) -> DataFrame:
    """Per field the keys on both sides whose values could not be compared."""
    joined = _side_by_side(stored, source, list(keys), list(tolerances)).where(
        F.col("_stored").isNotNull() & F.col("_source").isNotNull()
    )
    counts = [
        F.struct(
            F.lit(field).alias("field"),
            F.count_if(F.col("_stored")[field].isNull() | F.col("_source")[field].isNull()).alias("skipped"),
        )
        for field in tolerances
    ]
    return joined.agg(F.array(*counts).alias("_all")).select(F.inline("_all"))


def reconcile(
    stored: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    tolerances: Mapping[str, Tolerance],
) -> DataFrame:
    """Every difference between two copies: rows on one side only, and fields out of tolerance.

    Fields missing on either side are skipped, as there is nothing to compare; ``skipped`` counts
    them. Of rows that share a key on one side the smallest by value is compared.
    """
    keys = list(keys)
    joined = _side_by_side(stored, source, keys, list(tolerances))
    one_sided = F.struct(
        F.lit("row").alias("field"),
        F.lit(None).cast("double").alias("stored_value"),
        F.lit(None).cast("double").alias("source_value"),
        F.lit(None).cast("double").alias("difference"),
        F.when(F.col("_source").isNull(), "missing_in_source")
        .when(F.col("_stored").isNull(), "missing_in_stored")
        .alias("kind"),
    )

    def compared(field: str, rule: Tolerance) -> Column:
        a = F.col("_stored")[field].cast("double")
        b = F.col("_source")[field].cast("double")
        gap = F.abs(a - b)
        if rule.relative:
            gap = F.when(b != 0, gap / F.abs(b)).otherwise(gap)
        return F.when(
            gap > rule.limit,
            F.struct(
                F.lit(field).alias("field"),
                a.alias("stored_value"),
                b.alias("source_value"),
                gap.alias("difference"),
                F.lit("mismatch").alias("kind"),
            ),
        )

    found = F.filter(
        F.array(
            F.when(F.col("_stored").isNull() | F.col("_source").isNull(), one_sided),
            *[compared(field, rule) for field, rule in tolerances.items()],
        ),
        lambda d: d.isNotNull(),
    )
    return joined.select(*keys, F.explode(found).alias("_d")).select(*keys, "_d.*")


def differing_parts(stored: DataFrame, source: DataFrame, parts: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """The parts (distinct values of ``parts``) whose rows are not the same on both sides.

    Each side gives one digest a part that does not depend on the order of rows: their number and
    sums of two hashes of keys and fields, which combine in the tasks before they travel. Rows
    that repeat count as often as they come; a part that one side lacks differs.
    """

    def digests(df: DataFrame, name: str) -> DataFrame:
        hashes = [F.xxhash64(F.lit(seed), *[F.coalesce(F.col(f).cast("string"), F.lit("\x00")) for f in fields]) for seed in (1, 2)]
        sums = [F.sum(h.cast("decimal(20,0)")) for h in hashes]
        return df.groupBy(*parts).agg(F.struct(F.count("*").alias("n"), *sums).alias(name))

    left = digests(stored, "_left").select(F.struct(*parts).alias("_part"), "_left")
    right = digests(source, "_right").select(F.struct(*parts).alias("_other"), "_right")
    both = left.join(right, F.col("_part").eqNullSafe(F.col("_other")), "full_outer")
    return both.where(~F.col("_left").eqNullSafe(F.col("_right"))).select(F.coalesce("_part", "_other").alias("_part")).select("_part.*")


def reconcile_by_day(
    stored: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    tolerances: Mapping[str, Tolerance],
    time: str = "timestamp",
) -> DataFrame:
    """``reconcile`` of the series and days whose digests differ; all others are the same row by row.

    The differing days are stored, and both sides read again for these alone.
    """
    keys = list(keys)
    series = [k for k in keys if k != time]
    days = [*series, "_day"]
    sides = [df.withColumn("_day", F.to_date(time)) for df in (stored, source)]
    parts = materialise(differing_parts(*sides, days, [*keys, *tolerances]), "differing-days")
    named = parts.toDF(*[f"_p{i}" for i in range(len(days))])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_p{i}")) for i, c in enumerate(days)])
    left, right = (df.join(named, same, "left_semi").drop("_day") for df in sides)
    return reconcile(left, right, keys, tolerances)


def canonical_listing(listings: DataFrame) -> DataFrame:
    """One listing per ticker and date: best rank, then larger market cap, nulls last."""
    order = [
        F.col("rank").isNull().alias("_no_rank"),
        F.col("rank").alias("_rank"),
        F.col("market_cap").isNull().alias("_no_cap"),
        (-F.col("market_cap")).alias("_cap"),
    ]
    return upsert.keep_first(listings, ["date", "symbol"], order).drop(upsert.COPIES)


def open_times(candles: DataFrame) -> DataFrame:
    """Candles with the open time in milliseconds that sources use as their key."""
    step_ms = cadence_seconds("interval") * 1_000
    return candles.withColumn(
        "open_time_ms", F.floor(epoch_micros("timestamp") / 1_000).cast("bigint") - step_ms
    )


def key_hash(seed: int, keys: Sequence[Column]) -> Column:
    """40 bits of the MD5 of seed and keys as text, the same on any cluster and in any SQL engine."""
    text = F.concat_ws("|", F.lit(str(seed)), *[key.cast("string") for key in keys])
    return F.conv(F.substring(F.md5(text), 1, 10), 16, 10).cast("bigint")


SAMPLE_KEYS = ("exchange", "symbol", "interval", "timestamp")
HASH_BITS = 40
CELL_BITS = 12


def _columns(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """Keys as numbers or text; times count in microseconds."""
    return [epoch_micros(k) if df.schema[k].dataType.typeName().startswith("timestamp") else F.col(k) for k in keys]


def _smallest_hashes(df: DataFrame, group: Sequence[str], take: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with the smallest ``_hash`` of each group, as many as ``take`` (group, _take) says.

    Counts of hash ranges give the range in which a group's share ends. Only the rows of that one
    range are ordered; those of the ranges below are taken as they are.
    """
    cell = F.shiftright("_hash", HASH_BITS - CELL_BITS)
    wanted = df.withColumn("_cell", cell).join(take, list(group))
    sizes = wanted.groupBy(*group, "_cell").agg(F.count("*").alias("_size"), F.first("_take").alias("_take"))
    # At most 2 ** CELL_BITS rows for each group.
    before = Window.partitionBy(*group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    ends = (
        sizes.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0)))
        .where((F.col("_before") < F.col("_take")) & (F.col("_take") <= F.col("_before") + F.col("_size")))
        .select(*group, F.col("_cell").alias("_end"), (F.col("_take") - F.col("_before")).alias("_left"))
    )
    near = wanted.join(ends, list(group), "left")
    whole = near.where(F.col("_end").isNull() | (F.col("_cell") < F.col("_end")))
    in_cell = Window.partitionBy(*group).orderBy("_hash", *keys)
    part = (
        near.where(F.col("_cell") == F.col("_end"))
        .withColumn("_pos", F.row_number().over(in_cell))
        .where(F.col("_pos") <= F.col("_left"))
        .drop("_pos")
    )
    return whole.unionByName(part)


def random_rows(
    df: DataFrame, n: int, seed: int = 0, keys: Sequence[str] = SAMPLE_KEYS
) -> DataFrame:
    """``n`` rows (all, if fewer) by hash of their keys: the same seed gives the same rows."""
    hashed = df.withColumns({"_hash": key_hash(seed, _columns(df, keys)), "_all": F.lit(0)})
    take = df.sparkSession.range(1).select(F.lit(0).alias("_all"), F.lit(n).cast("bigint").alias("_take"))
    return _smallest_hashes(hashed, ["_all"], take, keys).select(*df.columns)


def stratified_rows(
    df: DataFrame,
    ratio: float,
    max_symbols: int,
    seed: int = 0,
    keys: Sequence[str] = SAMPLE_KEYS,
) -> DataFrame:
    """Sample a share of the rows of up to ``max_symbols`` symbols, split evenly over them.

    The choice is by hash of the key, so the same seed gives the same rows on any cluster.
    Each symbol takes the rows with the smallest hashes; a cut-off per symbol is found from
    hash-range counts, so no symbol is ever sorted as a whole.
    """
    if not 0 < ratio <= 1:
        raise ValueError(f"ratio must lie in (0, 1], got {ratio}")
    if max_symbols <= 0:
        raise ValueError(f"max_symbols must be positive, got {max_symbols}")
    counts = df.groupBy("symbol").agg(F.count("*").alias("_rows"))
    chosen = counts.orderBy(key_hash(seed, [F.col("symbol")]), "symbol").limit(max_symbols)
    # At most max_symbols rows from here on.
    everything = Window.partitionBy(F.lit(1))
    order = Window.partitionBy(F.lit(1)).orderBy(key_hash(seed + 1, [F.col("symbol")]), "symbol")
    budget = (
        chosen.withColumn(
            "_target", F.greatest(F.lit(1), F.floor(F.sum("_rows").over(everything) * ratio))
        )
        .withColumn("_nth", F.row_number().over(order))
        .withColumn("_symbols", F.least(F.count("*").over(everything), F.col("_target")))
        .where(F.col("_nth") <= F.col("_target"))
        .withColumn(
            "_take",
            F.least(
                F.col("_rows"),
                F.floor(F.col("_target") / F.col("_symbols"))
                + F.when(F.col("_nth") <= F.col("_target") % F.col("_symbols"), 1).otherwise(0),
            ).cast("bigint"),
        )
        .select("symbol", "_take")
    )
    hashed = df.withColumn("_hash", key_hash(seed, _columns(df, keys)))
    return _smallest_hashes(hashed, ["symbol"], budget, keys).select(*df.columns)
