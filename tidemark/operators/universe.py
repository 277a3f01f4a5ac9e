"""Rankings: membership, look-ahead-free joins, identity across renames, snapshot builds."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import specs
from tidemark.functions.ordered import with_previous
from tidemark.functions.scalars import (
    carries_excluded_tag,
    date_literal,
    is_excluded_symbol,
    pair_symbol,
    tag_array,
)
from tidemark.operators import upsert, validate
from tidemark.operators.resample import just_before


def symbol_superset(
    universe: DataFrame,
    start: date | str,
    end: date | str,
    top_n: int,
    exclude_tags: Sequence[str] | None = None,
    exclude_symbols: Sequence[str] | None = None,
) -> DataFrame:
    """Pairs of every symbol in the top n on any date; one excluded tag drops the symbol."""
    tagged = carries_excluded_tag(tag_array("tags"), exclude_tags)
    return (
        universe.where(
            F.col("date").between(date_literal(start), date_literal(end))
            & (F.col("rank") <= top_n)
        )
        .groupBy("symbol")
        .agg(F.bool_or(tagged).alias("_tagged"))
        .where(~F.col("_tagged") & ~is_excluded_symbol("symbol", exclude_symbols))
        .select(pair_symbol("symbol").alias("symbol"))
        .orderBy("symbol")
    )


def rank_history(universe: DataFrame, symbol: str, top_n: int, since: date | str) -> DataFrame:
    """When a symbol was inside the top n."""
    return (
        universe.where(
            (F.col("symbol") == symbol)
            & (F.col("date") >= date_literal(since))
            & (F.col("rank") <= top_n)
        )
        .select("date", "symbol", "rank", "market_cap")
        .orderBy("date")
    )


def join_month_snapshot(universe: DataFrame, candles: DataFrame) -> DataFrame:
    """Candles with the ranking of the month they closed in."""
    snapshots = universe.select(
        "date", "symbol", "rank", "market_cap", pair_symbol("symbol").alias("_pair")
    )
    prices = candles.where(F.col("exchange") == specs.EXCHANGE).select(
        F.col("symbol").alias("_pair"),
        "timestamp",
        F.trunc(just_before("timestamp"), "MM").alias("date"),
        "close",
        "volume",
    )
    return prices.join(snapshots, ["_pair", "date"]).drop("_pair")


def snapshot_ranges(universe: DataFrame) -> DataFrame:
    """Every snapshot date with the days on which it is the latest known: after it, up to the next.

    One row for each snapshot date, which is why one ordered window over them is enough. The
    newest has no last day.
    """
    by_date = Window.partitionBy(F.lit(1)).orderBy("snapshot")
    return (
        universe.select(F.col("date").alias("snapshot"))
        .distinct()
        .select("snapshot", F.date_add("snapshot", 1).alias("_from"), F.lead("snapshot").over(by_date).alias("_to"))
    )


def join_latest_snapshot(universe: DataFrame, candles: DataFrame) -> DataFrame:
    """Candles with the latest ranking known before their trading day (no look-ahead).

    The ranking is spread over the months of its range and meets the candles on (pair, month),
    with the range as a residual condition: the candles are read and moved once. Days past the
    newest snapshot count as its first month.
    """
    ranges = snapshot_ranges(universe)
    newest = F.broadcast(ranges.agg(F.trunc(F.max("_from"), "MM").alias("_newest")))
    prices = (
        candles.where(F.col("exchange") == specs.EXCHANGE)
        .select(
            F.col("symbol").alias("_pair"),
            "timestamp",
            F.to_date(just_before("timestamp")).alias("day"),
            "close",
            "volume",
        )
        .crossJoin(newest)
        .withColumn("_month", F.least(F.trunc("day", "MM"), F.col("_newest")))
    )
    months = F.sequence(
        F.trunc("_from", "MM"), F.trunc(F.coalesce("_to", "_from"), "MM"), F.expr("interval 1 month")
    )
    members = (
        universe.select(
            F.col("date").alias("snapshot"),
            "symbol",
            "rank",
            "market_cap",
            pair_symbol("symbol").alias("_pair"),
        )
        .join(ranges, "snapshot")
        .withColumn("_month", F.explode(months))
    )
    known = (F.col("day") >= F.col("_from")) & F.coalesce(F.col("day") <= F.col("_to"), F.lit(True))
    return (
        prices.join(members, ["_pair", "_month"])
        .where(known)
        .select("snapshot", "day", "timestamp", "close", "volume", "symbol", "rank", "market_cap")
    )


def stitch_renamed(candles: DataFrame, names: DataFrame) -> DataFrame:
    """Put rows of renamed assets under one symbol.

    ``names`` has (symbol, canonical, valid_from, valid_to), periods half open and not
    overlapping, NULL for an open side. Rows without an entry keep their symbol.
    """
    mapped = F.coalesce(F.col("timestamp") > F.col("valid_from"), F.lit(True)) & F.coalesce(
        F.col("timestamp") <= F.col("valid_to"), F.lit(True)
    )
    spans = names.select(
        F.col("symbol").alias("_old"), F.col("canonical"), "valid_from", "valid_to"
    )
    joined = candles.join(spans, (F.col("symbol") == F.col("_old")) & mapped, "left")
    return joined.withColumn("symbol", F.coalesce("canonical", "symbol")).select(*candles.columns)


def renames(universe: DataFrame) -> DataFrame:
    """Dates on which an asset, followed by its provider id, changed its symbol."""
    keys = ["provider", "provider_id"]
    days = universe.groupBy(*keys, "date").agg(F.min("symbol").alias("symbol"))
    decades = F.floor(F.year("date") / 10).cast("bigint")
    return (
        with_previous(days, keys, ["date"], ["symbol"], decades)
        .where(F.col("symbol") != F.col("prev_symbol"))
        .select(*keys, "date", F.col("prev_symbol").alias("old_symbol"), F.col("symbol").alias("new_symbol"))
    )


def ticker_spans(universe: DataFrame, provider: str = specs.PROVIDER) -> DataFrame:
    """Whom a ticker belonged to and when: (symbol, provider_id, valid_from, valid_to).

    Half open periods in dates, that do not overlap within a ticker; NULL for an open side. A
    ticker on a date belongs to the asset with the best rank, equal ranks to the smaller id, and
    stays with it until another asset carries it. Its first owner had it all the time before.
    Rows without symbol, date or id take no part.
    """
    known = universe.where(
        (F.col("provider") == provider) & F.col("symbol").isNotNull() & F.col("date").isNotNull() & F.col("provider_id").isNotNull()
    )
    best = F.struct(F.col("rank").isNull(), "rank", "provider_id")
    owners = known.groupBy("symbol", "date").agg(F.min_by("provider_id", best).alias("provider_id"))
    decades = F.floor(F.year("date") / 10).cast("bigint")
    # One row a change of hands is left, so a window by ticker is small.
    changes = with_previous(owners, ["symbol"], ["date"], ["provider_id"], decades).where(
        ~F.col("provider_id").eqNullSafe(F.col("prev_provider_id"))
    )
    by_date = Window.partitionBy("symbol").orderBy("date")
    return changes.select(
        "symbol",
        "provider_id",
        F.when(F.col("prev_provider_id").isNotNull(), F.col("date")).alias("valid_from"),
        F.lead("date").over(by_date).alias("valid_to"),
    )


def asset_names(universe: DataFrame, provider: str = specs.PROVIDER) -> DataFrame:
    """One symbol for each asset of the rankings over all its renames: (provider_id, canonical).

    It is the newest ticker, so a chain A-B-C ends in C. Where that ticker has passed to another
    asset since, or never was this asset's own by ``ticker_spans``, the id is added ("C.17"), so no
    two assets share a name.
    """
    known = universe.where(
        (F.col("provider") == provider) & F.col("symbol").isNotNull() & F.col("date").isNotNull() & F.col("provider_id").isNotNull()
    )
    newest = known.groupBy("provider_id").agg(F.max_by("symbol", F.struct("date", "symbol")).alias("symbol"))
    holders = ticker_spans(universe, provider).where(F.col("valid_to").isNull()).select("symbol", F.col("provider_id").alias("_holder"))
    own = F.coalesce(F.col("_holder") == F.col("provider_id"), F.lit(False))
    return newest.join(holders, "symbol", "left").select(
        "provider_id",
        F.when(own, F.col("symbol")).otherwise(F.concat("symbol", F.lit("."), F.col("provider_id").cast("string"))).alias("canonical"),
    )


def names_from_rankings(universe: DataFrame, provider: str = specs.PROVIDER) -> DataFrame:
    """The mapping that ``stitch_renamed`` takes, for the pairs of all assets, from rankings alone.

    A pair that is called the same all the time needs no row and gets none.
    """
    spans = ticker_spans(universe, provider).join(asset_names(universe, provider), "provider_id")
    return spans.where(F.col("symbol") != F.col("canonical")).select(
        pair_symbol("symbol").alias("symbol"),
        pair_symbol("canonical").alias("canonical"),
        F.col("valid_from").cast("timestamp_ntz").alias("valid_from"),
        F.col("valid_to").cast("timestamp_ntz").alias("valid_to"),
    )


@dataclass(frozen=True)
class SnapshotBuild:
    """Result of one build over many dates."""

    rows: DataFrame
    violations: DataFrame
    excluded: DataFrame
    failed_dates: DataFrame


def with_exclusion(
    listings: DataFrame,
    exclude_tags: Sequence[str] | None = None,
    exclude_symbols: Sequence[str] | None = None,
) -> DataFrame:
    """Mark listings dropped by tag or by symbol; the tag wins."""
    return listings.withColumn(
        "exclusion",
        F.when(carries_excluded_tag(tag_array("tags"), exclude_tags), "tag").when(
            is_excluded_symbol("symbol", exclude_symbols), "symbol"
        ),
    )


def build_snapshots(
    listings: DataFrame,
    requested: DataFrame,
    exclude_tags: Sequence[str] | None = None,
    exclude_symbols: Sequence[str] | None = None,
) -> SnapshotBuild:
    """Universe rows of all requested dates in one job.

    A date without listings or with any violation is a failed date and contributes no rows.
    """
    marked = with_exclusion(
        listings.join(requested.select("date").distinct(), "date", "left_semi"),
        exclude_tags,
        exclude_symbols,
    )
    rows = upsert.dedupe_snapshot(marked.where(F.col("exclusion").isNull()).drop("exclusion"))
    broken = validate.violations(rows, "crypto_universe")
    failed = (
        requested.select("date")
        .distinct()
        .join(marked.select("date").distinct(), "date", "left_anti")
        .withColumn("reason", F.lit("no_listings"))
        .unionByName(
            broken.select("date").distinct().withColumn("reason", F.lit("validation_failed"))
        )
    )
    broken_dates = broken.select("date").distinct()
    excluded = (
        marked.where(F.col("exclusion").isNotNull())
        .join(broken_dates, "date", "left_anti")
        .select("exclusion", "symbol")
        .distinct()
    )
    return SnapshotBuild(
        rows.join(broken_dates, "date", "left_anti").select(*listings.columns),
        broken,
        excluded,
        failed,
    )
