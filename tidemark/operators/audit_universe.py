"""Quality checks of ranking snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import specs
from tidemark.functions.ordered import with_previous
from tidemark.functions.scalars import date_literal, finite_sql, present
from tidemark.operators.findings import counted, to_findings
from tidemark.operators.gaps import scan
from tidemark.operators.planning import calendar

TABLE = "crypto_universe"
RANK_SLICE = 4_096
SAMPLE = 20


def identity_columns(df: DataFrame) -> tuple[str, ...]:
    """Provider identity where the columns exist, else the older (date, symbol) key."""
    key = specs.TABLES[TABLE].primary_key
    return key if set(key) <= set(df.columns) else ("date", "symbol")


def snapshot_bounds(df: DataFrame, config: specs.AuditConfig) -> DataFrame:
    """One row (start, end): configured dates, each falling back to the table's own range."""
    start, end = config.universe_start_date, config.universe_end_date
    edge = df.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    own_start = date_literal(start) if start is not None else F.col("lo")
    own_end = date_literal(end) if end is not None else F.col("hi")
    # Without data, bounds exist only if both dates are configured.
    usable = F.lit(start is not None and end is not None) | F.col("lo").isNotNull()
    return edge.where(usable).select(own_start.alias("start"), own_end.alias("end"))


def within_bounds(df: DataFrame, config: specs.AuditConfig) -> DataFrame:
    """Rows inside the configured dates; start after end leaves nothing.

    Bounds taken from the table itself hold for every dated row, so only configured dates
    turn into filters, and those reach the scan.
    """
    kept = df.where(F.col("date").isNotNull())
    if config.universe_start_date is not None:
        kept = kept.where(F.col("date") >= date_literal(config.universe_start_date))
    if config.universe_end_date is not None:
        kept = kept.where(F.col("date") <= date_literal(config.universe_end_date))
    return kept


# ---------------------------------------------------------------------------
# Duplicates and values
# ---------------------------------------------------------------------------
def universe_duplicates(df: DataFrame) -> DataFrame:
    """Surplus rows on the identity key, reported per symbol."""
    keys = identity_columns(df)
    name = F.col("symbol") if "symbol" in keys else F.min("symbol")
    groups = df.groupBy(*keys).agg(
        *([] if "symbol" in keys else [name.alias("symbol")]),
        F.count("*").alias("copies"),
    )
    return _surplus_by_symbol(groups.where(F.col("copies") > 1), F.sum(F.col("copies") - 1))


def duplicate_ranks(df: DataFrame) -> DataFrame:
    """Number of (date, rank) groups with more than one row; no row when there is none."""
    return (
        df.groupBy("date", "rank")
        .agg(F.count("*").alias("copies"))
        .where(F.col("copies") > 1)
        .agg(
            F.count("*").alias("bad_count"),
            F.min("date").alias("first_timestamp"),
            F.max("date").alias("last_timestamp"),
            F.max("copies").alias("max_occurrences"),
        )
        .where(F.col("bad_count") > 0)
    )


def duplicate_symbols(df: DataFrame) -> DataFrame:
    """Per symbol, the number of dates that list it more than once."""
    groups = df.groupBy("date", "symbol").agg(F.count("*").alias("copies"))
    return _surplus_by_symbol(groups.where(F.col("copies") > 1), F.count("*"))


def _surplus_by_symbol(groups: DataFrame, measure) -> DataFrame:
    return groups.groupBy("symbol").agg(
        measure.alias("bad_count"),
        F.min("date").alias("first_timestamp"),
        F.max("date").alias("last_timestamp"),
        F.max("copies").alias("max_occurrences"),
    )


def universe_value_errors(df: DataFrame) -> DataFrame:
    bad = (
        "date IS NULL OR symbol IS NULL OR rank IS NULL OR rank < 1 OR (market_cap IS NOT NULL "
        f"AND (NOT {finite_sql('market_cap')} OR market_cap < 0))"
    )
    return (
        df.where(bad)
        .groupBy("symbol")
        .agg(
            F.count("*").alias("bad_count"),
            F.min("date").alias("first_timestamp"),
            F.max("date").alias("last_timestamp"),
        )
    )


# ---------------------------------------------------------------------------
# Coverage
# ---------------------------------------------------------------------------
def missing_snapshots(df: DataFrame, config: specs.AuditConfig) -> DataFrame:
    """Expected snapshot dates without any row."""
    expected = calendar(snapshot_bounds(df, config), config.universe_frequency)
    observed = within_bounds(df, config).select("date").distinct()
    missing = expected.join(observed, "date", "left_anti")
    totals = missing.agg(
        F.count("*").alias("bad_count"),
        F.min("date").alias("first_timestamp"),
        F.max("date").alias("last_timestamp"),
    )
    first = missing.orderBy("date").limit(SAMPLE).agg(
        F.sort_array(F.collect_list("date")).alias("sample_missing_dates")
    )
    # One row on either side.
    return (
        totals.crossJoin(first)
        .where(F.col("bad_count") > 0)
        .withColumn("frequency", F.lit(config.universe_frequency))
    )


def ranks_above(df: DataFrame, config: specs.AuditConfig) -> DataFrame:
    """Rows ranked beyond the requested top n."""
    top = int(config.universe_top_n)
    return (
        within_bounds(df, config)
        .where(F.col("rank") > top)
        .agg(
            F.count("*").alias("bad_count"),
            F.min("date").alias("first_timestamp"),
            F.max("date").alias("last_timestamp"),
            F.max("rank").alias("max_rank"),
        )
        .where(F.col("bad_count") > 0)
        .withColumn("top_n", F.lit(top))
    )


def rank_coverage(df: DataFrame, config: specs.AuditConfig) -> DataFrame:
    """Snapshots whose deepest rank stays below the requested top n."""
    top = int(config.universe_top_n)
    return (
        within_bounds(df, config)
        .groupBy("date")
        .agg(F.count("*").alias("row_count"), F.max("rank").alias("max_rank"))
        .where(F.col("max_rank") < top)
        .agg(
            F.count("*").alias("bad_count"),
            F.min("date").alias("first_timestamp"),
            F.max("date").alias("last_timestamp"),
            F.min("max_rank").alias("min_observed_max_rank"),
            F.max("max_rank").alias("max_observed_max_rank"),
            F.min("row_count").alias("min_row_count"),
        )
        .where(F.col("bad_count") > 0)
        .withColumn("top_n", F.lit(top))
    )


def rank_holes(df: DataFrame, config: specs.AuditConfig | None = None) -> DataFrame:
    """Runs of ranks (date, _low, _high) from 1 to the deepest rank that no row fills."""
    config = config or specs.AuditConfig()
    ranks = within_bounds(df, config).select("date", "rank").distinct()
    if config.universe_top_n is not None:
        top = int(config.universe_top_n)
        depth = ranks.groupBy("date").agg(F.max("rank").alias("_deepest"))
        # A rank past the limit still closes the hole before it.
        beyond = depth.where(F.col("_deepest") > top).select(
            "date", F.lit(top + 1).alias("rank")
        )
        ranks = ranks.where(F.col("rank") <= top).unionByName(beyond)
    ranks = ranks.where(F.col("rank") >= 1)
    ordered = with_previous(
        ranks, ["date"], ["rank"], ["rank"], F.floor(F.col("rank") / RANK_SLICE).cast("bigint")
    )
    return ordered.select(
        "date",
        (F.coalesce("prev_rank", F.lit(0)) + 1).alias("_low"),
        (F.col("rank") - 1).alias("_high"),
    ).where(F.col("_low") <= F.col("_high"))


def missing_rank_slots(df: DataFrame, config: specs.AuditConfig | None = None) -> DataFrame:
    """(date, rank) slots from 1 to the deepest rank that no row fills.

    Only the ranks next to a hole are expanded, so a complete snapshot costs nothing.
    """
    holes = rank_holes(df, config)
    # Expanded block by block, so that one absurd rank does not become one huge array.
    blocks = holes.withColumn(
        "_at", F.explode(F.sequence(F.col("_low"), F.col("_high"), F.lit(RANK_SLICE)))
    )
    block_end = F.least(F.col("_at") + (RANK_SLICE - 1), F.col("_high"))
    return blocks.select("date", F.explode(F.sequence(F.col("_at"), block_end)).alias("rank"))


def missing_ranks(df: DataFrame, config: specs.AuditConfig | None = None) -> DataFrame:
    """Total of missing rank slots with affected dates, deepest slot and first examples."""
    holes = rank_holes(df, config)
    totals = holes.agg(
        F.sum((F.col("_high") - F.col("_low") + 1).cast("bigint")).alias("bad_count"),
        F.count_distinct("date").alias("affected_dates"),
        F.min("date").alias("first_timestamp"),
        F.max("date").alias("last_timestamp"),
        F.max("_high").alias("max_missing_rank"),
    )
    # The first slots lie in the first holes; no other is expanded.
    first = holes.orderBy("date", "_low").limit(SAMPLE)
    slots = F.sequence("_low", F.least(F.col("_high"), F.col("_low") + (SAMPLE - 1)))
    examples = (
        first.select("date", F.explode(slots).alias("rank"))
        .orderBy("date", "rank")
        .limit(SAMPLE)
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct(F.date_format("date", "yyyy-MM-dd").alias("date"), F.col("rank"))
                )
            ).alias("sample_missing_ranks")
        )
    )
    # One row on either side.
    one = F.lit(1).alias("_one")
    return (
        totals.where(F.col("bad_count") > 0)
        .select("*", one)
        .join(examples.select("*", one), "_one", "left")
        .drop("_one")
    )


def rank_order(df: DataFrame) -> DataFrame:
    """Market caps above the cap of the next better rank on the same date."""
    rows = (
        df.where(present("market_cap"))
        .groupBy("date", "rank", "market_cap")
        .agg(F.count("*").alias("copies"))
    )
    ordered = with_previous(
        rows,
        ["date"],
        ["rank", "market_cap"],
        ["market_cap"],
        F.floor(F.coalesce("rank", F.lit(0)) / RANK_SLICE).cast("bigint"),
    )
    rise = F.col("market_cap") - F.col("prev_market_cap")
    return (
        ordered.where(rise > 0)
        .agg(
            F.count("*").alias("bad_count"),
            F.min("date").alias("first_timestamp"),
            F.max("date").alias("last_timestamp"),
            F.max(rise).alias("max_market_cap_inversion"),
        )
        .where(F.col("bad_count") > 0)
    )


# Text of the report (fixed value).
COVERAGE_NOTE = (
    "This can be expected when excluded assets occupy the highest requested ranks; "
    "investigate if the gap is large or unexpected."
)


def audit_universe(
    df: DataFrame,
    config: specs.AuditConfig | None = None,
    symbols: Sequence[str] | None = None,
) -> DataFrame:
    """Findings of all snapshot checks; coverage checks need the table without a filter."""
    config = config or specs.AuditConfig()
    rows = scan(df, symbols)
    occurrences = ["max_occurrences"]
    parts = [
        to_findings(
            universe_duplicates(rows),
            TABLE,
            "duplicate_primary_key",
            "ERROR",
            counted("duplicate rows on primary key"),
            occurrences,
        ),
        to_findings(
            duplicate_ranks(rows),
            TABLE,
            "duplicate_ranks",
            "ERROR",
            counted("duplicate rank groups detected"),
            occurrences,
        ),
        to_findings(
            duplicate_symbols(rows),
            TABLE,
            "duplicate_symbols",
            "WARN",
            counted("duplicate symbol rows detected for the same date"),
            occurrences,
        ),
        to_findings(
            universe_value_errors(rows),
            TABLE,
            "invalid_values",
            "ERROR",
            counted("rows contain null, infinite, or out-of-range values"),
        ),
    ]
    if not symbols:
        if config.universe_frequency is not None:
            parts.append(
                to_findings(
                    missing_snapshots(df, config),
                    TABLE,
                    "missing_snapshots",
                    "ERROR",
                    F.concat(
                        F.col("bad_count").cast("string"),
                        F.lit(
                            f" expected {config.universe_frequency} CoinMarketCap "
                            "snapshots are missing"
                        ),
                    ),
                    ["frequency", "sample_missing_dates"],
                )
            )
        if config.universe_top_n is not None:
            top = int(config.universe_top_n)
            parts.append(
                to_findings(
                    ranks_above(df, config),
                    TABLE,
                    "rank_above_top_n",
                    "ERROR",
                    counted(f"rows have rank above expected top_n={top}"),
                    ["top_n", "max_rank"],
                )
            )
            parts.append(
                to_findings(
                    rank_coverage(df, config).withColumn("note", F.lit(COVERAGE_NOTE)),
                    TABLE,
                    "rank_coverage_below_top_n",
                    "WARN",
                    counted(f"snapshots have max retained rank below expected top_n={top}"),
                    [
                        "top_n",
                        "min_observed_max_rank",
                        "max_observed_max_rank",
                        "min_row_count",
                        "note",
                    ],
                )
            )
        parts.append(
            to_findings(
                missing_ranks(df, config).withColumn(
                    "top_n", F.lit(config.universe_top_n).cast("int")
                ),
                TABLE,
                "missing_ranks",
                "WARN",
                counted("rank slots are missing inside observed universe snapshots"),
                ["affected_dates", "max_missing_rank", "top_n", "sample_missing_ranks"],
            )
        )
        parts.append(
            to_findings(
                rank_order(df),
                TABLE,
                "rank_market_cap_ordering",
                "ERROR",
                counted("rows violate rank ordering by market cap"),
                ["max_market_cap_inversion"],
            )
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
