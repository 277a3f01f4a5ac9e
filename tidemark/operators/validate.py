"""Row contracts of the stored tables.

Violations are data: one row per broken rule with the key, the rule, the column and the
offending value. Strict validation raises when there is any, lazy validation returns them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import specs
from tidemark.functions.ordered import with_previous
from tidemark.functions.quantiles import join_group_stats
from tidemark.functions.scalars import holds, present
from tidemark.operators import audit_candles
from tidemark.operators.audit_candles import weighted_moments

SYMBOL_PATTERN = "^[A-Z0-9]+$"


class ContractError(ValueError):
    """Rows or columns that break a table's contract."""


@dataclass(frozen=True)
class Rule:
    """A rule's name, its column and the SQL condition that breaks it.

    A condition that comes out NULL is not broken: missing values are left to ``not_null``.
    """

    name: str
    column: str
    broken: str


def _required(column: str) -> Rule:
    return Rule("not_null", column, f"{column} IS NULL")


def _text(column: str, low: int, high: int, pattern: str | None = None) -> list[Rule]:
    rules = [
        _required(column),
        Rule("length", column, f"length({column}) NOT BETWEEN {low} AND {high}"),
    ]
    if pattern:
        rules.append(Rule("pattern", column, f"NOT {column} RLIKE '{pattern}'"))
    return rules


def _constant(column: str, value: str) -> list[Rule]:
    return [_required(column), Rule("constant", column, f"{column} <> '{value}'")]


def _above(column: str, limit: int) -> Rule:
    return Rule("positive", column, f"{column} <= {limit}")


def _at_least(column: str, limit: int) -> Rule:
    return Rule("minimum", column, f"{column} < {limit}")


def _number(column: str) -> Rule:
    return Rule("not_null", column, f"{column} IS NULL OR isnan({column})")


def _finite(column: str) -> Rule:
    return Rule("finite", column, f"abs({column}) = double('infinity')")


def _order(left: str, sign: str, right: str) -> Rule:
    # NaN sorts above all numbers; it breaks not_null, not the order of prices.
    numbers = f"NOT isnan({left}) AND NOT isnan({right})"
    return Rule(f"{left}_vs_{right}", left, f"{left} {sign} {right} AND {numbers}")


def table_rules(table: str) -> list[Rule]:
    """Row-level rules of a table; uniqueness is checked separately."""
    spec = specs.table_spec(table)
    if spec.kind == "universe":
        return [
            *_constant("provider", specs.PROVIDER),
            _required("provider_id"),
            _at_least("provider_id", 1),
            _required("date"),
            *_text("symbol", 1, 20, SYMBOL_PATTERN),
            *_text("name", 1, 100),
            _required("rank"),
            _at_least("rank", 1),
        ]
    rules = [*_constant("exchange", specs.EXCHANGE), *_text("symbol", 3, 20, SYMBOL_PATTERN)]
    rules.append(_required("timestamp"))
    if spec.kind == "kline":
        known = ", ".join(f"'{label}'" for label in specs.INTERVALS)
        rules += [_required("interval"), Rule("known", "interval", f"interval NOT IN ({known})")]
        for name in ("open", "high", "low", "close"):
            rules += [_number(name), _above(name, 0)]
        for name in ("volume", "quote_volume"):
            rules += [_number(name), _at_least(name, 0)]
        for name in ("trades_count", "taker_buy_base_volume", "taker_buy_quote_volume"):
            rules.append(_at_least(name, 0))
        rules += [_order("high", "<", other) for other in ("low", "open", "close")]
        rules += [_order("low", ">", other) for other in ("open", "close")]
    elif table == "open_interest":
        rules += [
            _number("open_interest"),
            _above("open_interest", 0),
            _finite("open_interest"),
        ]
    else:
        rules += [_number("funding_rate"), _finite("funding_rate")]
    return rules


def breaks_any_rule(table: str) -> Column:
    """Whether a row breaks any row-level rule of the table."""
    return F.expr(
        " OR ".join(f"coalesce({rule.broken}, false)" for rule in table_rules(table))
    )


def column_problems(df: DataFrame, table: str) -> list[str]:
    """Unknown and missing columns; the order of columns is free."""
    known = specs.table_spec(table).columns
    unknown = [f"unknown column {c}" for c in df.columns if c not in known]
    return unknown + [f"missing column {c}" for c in known if c not in df.columns]


def coerce(df: DataFrame, table: str, keep: Sequence[str] = ()) -> DataFrame:
    """Cast to the table's types; ``_uncastable`` lists columns whose value was lost."""
    schema = specs.table_spec(table).schema
    lost = [
        F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), F.lit(f.name))
        for f in schema
    ]
    return df.select(
        *keep,
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema],
        F.filter(F.array(*lost), lambda c: c.isNotNull()).alias("_uncastable"),
    )


def row_violations(df: DataFrame, table: str, keep: Sequence[str] = ()) -> DataFrame:
    """Broken row-level rules, all of them found in one pass over the rows."""
    spec = specs.table_spec(table)
    broken = [
        F.expr(
            f"if(coalesce({rule.broken}, false), struct('{rule.name}' AS rule, '{rule.column}' AS "
            f"column, cast({rule.column} AS string) AS value), NULL)"
        )
        for rule in table_rules(table)
    ]
    if "_uncastable" in df.columns:
        lost = F.transform(
            "_uncastable",
            lambda c: F.struct(
                F.lit("type").alias("rule"), c.alias("column"), F.lit(None).cast("string").alias("value")
            ),
        )
        found = F.concat(F.array(*broken), lost)
    else:
        found = F.array(*broken)
    return df.select(
        *keep,
        *spec.primary_key,
        F.explode(F.filter(found, lambda v: v.isNotNull())).alias("_v"),
    ).select(*keep, *spec.primary_key, "_v.rule", "_v.column", "_v.value")


def key_violations(df: DataFrame, keys: Sequence[str], scope: Sequence[str] = ()) -> DataFrame:
    """Key values that occur more than once (inside ``scope``, such as one file)."""
    return (
        df.groupBy(*scope, *keys)
        .agg(F.count("*").alias("_n"))
        .where(F.col("_n") > 1)
        .select(
            *scope,
            *keys,
            F.lit("unique").alias("rule"),
            F.lit(",".join(keys)).alias("column"),
            F.col("_n").cast("string").alias("value"),
        )
    )


def violations(df: DataFrame, table: str, scope: Sequence[str] = ()) -> DataFrame:
    """All contract violations of a table: row rules, primary key and duplicate ranks."""
    spec = specs.table_spec(table)
    found = row_violations(df, table, scope).unionByName(
        key_violations(df, spec.primary_key, scope)
    )
    if spec.kind == "universe":
        ranks = key_violations(df, ("date", "rank"), scope)
        ranks = ranks.drop("rank").withColumns(
            {c: F.lit(None).cast(spec.schema[c].dataType) for c in spec.primary_key if c != "date"}
        )
        found = found.unionByName(ranks)
    return found


def validate(df: DataFrame, table: str, strict: bool = True) -> DataFrame:
    """Strict: the coerced rows, or ContractError. Lazy: the violations, possibly none."""
    problems = column_problems(df, table)
    if problems:
        raise ContractError(f"{table}: {'; '.join(problems)}")
    typed = coerce(df, table)
    found = violations(typed, table)
    if not strict:
        return found
    first = found.limit(1).collect()
    if first:
        broken = first[0]
        raise ContractError(
            f"{table}: rule {broken['rule']} on {broken['column']} broken by {broken['value']!r}"
        )
    return typed.drop("_uncastable")


def time_reversals(df: DataFrame, file: str = "file", line: str = "line_no") -> DataFrame:
    """Rows whose timestamp is earlier than that of the line before."""
    lines_per_slice = 4_096
    ordered = with_previous(
        df, [file], [line], ["timestamp"], F.floor(F.col(line) / lines_per_slice).cast("bigint")
    )
    return ordered.where(F.col("timestamp") < F.col("prev_timestamp"))


# ---------------------------------------------------------------------------
# Statistical validation: warnings, never errors
# ---------------------------------------------------------------------------
def price_continuity(df: DataFrame, sigma: float = 5.0) -> DataFrame:
    """Series with log returns more than ``sigma`` deviations from their mean."""
    config = specs.AuditConfig(price_return_sigma=sigma, min_outlier_observations=1)
    return audit_candles.return_outliers(df, config)


def volume_spread(df: DataFrame, multiplier: float = 3.0) -> DataFrame:
    """Series with positive volumes outside the quartiles by ``multiplier`` ranges."""
    config = specs.AuditConfig(volume_iqr_multiplier=multiplier, min_outlier_observations=4)
    return audit_candles.volume_outliers(df, config)


def open_interest_levels(df: DataFrame, threshold: float = 5.0) -> DataFrame:
    """Series with open interest levels beyond ``threshold`` deviations; needs three rows."""
    rows = df.where(present("open_interest")).withColumn("weight", F.lit(1).cast("bigint"))
    stats = weighted_moments(rows, ["symbol"], "open_interest").where(
        (F.col("n") >= 3) & (F.col("std") > 0)
    )
    z = F.abs(F.col("open_interest") - F.col("mean")) / F.col("std")
    return (
        join_group_stats(rows, stats, ["symbol"], ["timestamp"], size="n")
        .where(z > threshold)
        .groupBy("symbol")
        .agg(
            F.count("*").alias("bad_count"),
            F.min("timestamp").alias("first_timestamp"),
            F.max("timestamp").alias("last_timestamp"),
            F.max(z).alias("max_z"),
        )
    )


def funding_balance(df: DataFrame) -> DataFrame:
    """Series of ten or more rates whose mean or spread is not that of a balanced market."""
    return (
        df.where(F.col("funding_rate").isNotNull())
        .groupBy("symbol")
        .agg(
            F.count("*").alias("n"),
            F.avg("funding_rate").alias("mean_rate"),
            F.stddev_samp("funding_rate").alias("std_rate"),
        )
        .where(
            (F.col("n") >= 10)
            & ~((F.abs("mean_rate") < 0.001) & holds(F.col("std_rate") < 0.01))
        )
    )


def statistical_warnings(df: DataFrame, table: str) -> DataFrame:
    """One warning row per series and failed check; an empty result means passed."""
    kind = specs.table_spec(table).kind

    def warn(rows: DataFrame, check: str, error: str) -> DataFrame:
        interval = F.col("interval") if "interval" in rows.columns else F.lit(None).cast("string")
        return rows.select(
            "symbol",
            interval.alias("interval"),
            F.lit(check).alias("check"),
            F.lit("DataFrame").alias("column"),
            F.lit(error).alias("error"),
        )

    if kind == "kline":
        return warn(
            price_continuity(df), "price_continuity", "Extreme price jumps detected (>5 sigma)"
        ).unionByName(
            warn(
                volume_spread(df),
                "volume_outliers",
                "Extreme volume outliers detected (>Q3 + 3*IQR)",
            )
        )
    if table == "open_interest":
        return warn(
            open_interest_levels(df),
            "open_interest_outliers",
            "Extreme open interest outliers detected (>5 sigma)",
        )
    if table == "funding_rates":
        return warn(
            funding_balance(df),
            "funding_rate_distribution",
            "Funding rate distribution check failed",
        )
    raise ValueError(f"no statistical checks for {table!r}")
