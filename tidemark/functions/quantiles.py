"""Exact continuous quantiles and group statistics that survive very large groups.

Radix selection: values become order-preserving 64-bit keys. The rows of each group are counted by
the leading bits of the key, the buckets that hold a wanted rank are kept, and only the rows in
them are counted again by the next bits, until the key is known. Nothing is sketched or sorted, and
no round passes on more than a count for each bucket. There is one way for groups of every size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import discard, materialise, stored_bytes

#: Bits of the key that are counted in each round; they sum up to 64.
ROUNDS = (22, 21, 21)
#: Stored statistics of at most this size are broadcast (compressed bytes; some ten times as much in memory).
BROADCAST_BYTES = 1 << 20
#: Rows of a group that meet one copy of its statistics.
ROWS_PER_REPLICA = 1 << 20
#: Copies of the statistics of a group whose size nobody has counted.
SALTS = 64


def join_group_stats(
    rows: DataFrame,
    stats: DataFrame,
    keys: Sequence[str],
    spread_on: Sequence[str],
    how: str = "inner",
    size: str | None = None,
) -> DataFrame:
    """Attach per-group statistics, one row per group, without sending a hot group to one task.

    ``size`` names the column of ``stats`` with the number of the group's rows. The statistics are
    then stored, if they are not yet, and measured, and broadcast up to BROADCAST_BYTES. Beyond
    that the shuffled join runs on (group, salt): a group gets one copy of its statistics for
    every ROWS_PER_REPLICA of its rows, so most stay single, and the rows learn of the others from
    a list shorter than the rows by that factor. Without ``size`` every group gets SALTS copies.
    """
    keys = list(keys)
    spread = F.xxhash64(*spread_on)
    if size is None:
        salted_rows, copies = rows.withColumn("_salt", F.pmod(spread, F.lit(SALTS)).cast("int")), F.lit(SALTS)
    else:
        stats = stats if hasattr(stats, "_stored_at") else materialise(stats, "group-statistics")
        if stored_bytes(stats) <= BROADCAST_BYTES:
            return rows.join(F.broadcast(stats), keys, how)
        copies = F.greatest(F.lit(1), F.ceil(F.col(size) / ROWS_PER_REPLICA).cast("int"))
        hot = stats.where(F.col(size) > ROWS_PER_REPLICA).select(*keys, copies.alias("_copies"))
        salt = F.coalesce(F.pmod(spread, F.col("_copies")).cast("int"), F.lit(0))
        salted_rows = rows.join(hot, keys, "left").withColumn("_salt", salt).drop("_copies")
    salted_stats = stats.withColumn("_salt", F.explode(F.sequence(F.lit(0), copies - 1)))
    return salted_rows.join(salted_stats, [*keys, "_salt"], how).drop("_salt")


def ordered_key(value: str) -> Column:
    """A 64-bit integer that orders the doubles of a column as Spark does: their bits, less the sign.

    Both zeros have key 0; NaN comes last.
    """
    bits = f"cast(java_method('java.lang.Double', 'doubleToLongBits', {value} + 0D) AS bigint)"
    return F.transform(F.array(F.expr(bits)), lambda b: F.when(b < 0, -b.bitwiseAND(F.lit((1 << 63) - 1))).otherwise(b))[0]


def ordered_value(key: str) -> Column:
    """The double of a key."""
    size = f"cast(java_method('java.lang.Double', 'longBitsToDouble', abs({key})) AS double)"
    return F.expr(f"if({key} < 0, -1D, 1D) * {size}")


def quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: Mapping[str, float],
    weight: str | None = None,
) -> DataFrame:
    """One row per group: ``keys``, the number of values ``n`` and the named quantiles.

    Linear interpolation between the two neighbouring order statistics; NULLs are ignored.
    A row of integer ``weight`` w counts as w equal values. Keys and weights are stored once; the
    buckets kept in a round, and the result, are stored too, so that their size is known when they
    are joined.
    """
    keys = list(keys)
    copies = F.lit(1).cast("bigint") if weight is None else F.col(weight).cast("bigint")
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"), copies.alias("_w"))
    keyed = materialise(rows.select(*keys, ordered_key("_v").alias("_key"), "_w"), "quantile-keys")
    positions = {name: F.lit(float(p)) * (F.col("n") - 1) for name, p in probabilities.items()}
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(p).cast("bigint"), F.ceil(p).cast("bigint")) for p in positions.values()])))
    held = [F.sum("_w").alias("_size"), F.count("*").alias("_rows")]
    within = F.filter("_ranks", lambda r: (r >= F.col("_below")) & (r < F.col("_below") + F.col("_size")))
    kept = [*keys, "_bucket", "_below", "_rows", "n", "_ranks"]

    shift = 64 - ROUNDS[0]
    group = Window.partitionBy(*keys)
    before = Window.unboundedPreceding, -1
    wanted = materialise(
        keyed.groupBy(*keys, F.shiftright("_key", shift).alias("_bucket"))
        .agg(*held)
        .withColumns({"n": F.sum("_size").over(group), "_below": F.coalesce(F.sum("_size").over(group.orderBy("_bucket").rowsBetween(*before)), F.lit(0))})
        .withColumn("_ranks", ranks)
        .withColumn("_ranks", within)
        .where(F.size("_ranks") > 0)
        .select(*kept),
        "quantile-buckets",
    )
    for bits in ROUNDS[1:]:
        inside = keyed.withColumn("_bucket", F.shiftright("_key", shift))
        shift -= bits
        bucket = Window.partitionBy(*keys, "_bucket").orderBy("_next").rowsBetween(*before)
        found = (
            join_group_stats(inside, wanted, [*keys, "_bucket"], ["_key"], size="_rows")
            .drop("_rows")
            .groupBy(*keys, "_bucket", F.shiftright("_key", shift).alias("_next"))
            .agg(*held, *[F.first(c).alias(c) for c in ("_below", "n", "_ranks")])
            .withColumn("_below", F.col("_below") + F.coalesce(F.sum("_size").over(bucket), F.lit(0)))
            .withColumn("_ranks", within)
            .where(F.size("_ranks") > 0)
            .withColumn("_bucket", F.col("_next"))
            .select(*kept)
        )
        # After the last bits the bucket is the key itself.
        narrower = materialise(found if shift else _interpolated(found, keys, positions), "quantile-buckets")
        discard(wanted)
        wanted = narrower
    discard(keyed)
    return wanted


def _interpolated(found: DataFrame, keys: list[str], positions: Mapping[str, Column]) -> DataFrame:
    """(keys, n, quantiles) from the values at the wanted ranks."""
    hits = found.select(*keys, "n", F.explode("_ranks").alias("_hit"), ordered_value("_bucket").alias("_v"))
    aggregates = [F.first("n").alias("n")]
    for name, position in positions.items():
        low = F.max(F.when(F.col("_hit") == F.floor(position).cast("bigint"), F.col("_v")))
        high = F.max(F.when(F.col("_hit") == F.ceil(position).cast("bigint"), F.col("_v")))
        share = F.first(position - F.floor(position))
        aggregates.append((low + (high - low) * share).alias(name))
    return hits.groupBy(*keys).agg(*aggregates)
