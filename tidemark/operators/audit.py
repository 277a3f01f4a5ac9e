"""The whole audit over any set of tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark import specs
from tidemark.operators.audit_candles import audit_candles
from tidemark.operators.audit_metrics import audit_funding_rates, audit_open_interest
from tidemark.operators.audit_universe import audit_universe
from tidemark.operators.findings import missing_table_finding


def audit(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    wanted: Sequence[str] | None = None,
    symbols: Sequence[str] | None = None,
    intervals: Sequence[str] | None = None,
    config: specs.AuditConfig | None = None,
) -> DataFrame:
    """Findings of every check of the wanted tables; a table not given is itself a finding."""
    config = config or specs.AuditConfig()
    parts = []
    for name in wanted or specs.TABLES:
        spec = specs.table_spec(name)
        if name not in tables:
            parts.append(missing_table_finding(spark, name))
        elif spec.kind == "kline":
            parts.append(audit_candles(tables[name], name, config, symbols, intervals))
        elif name == "open_interest":
            parts.append(audit_open_interest(tables[name], config, symbols))
        elif name == "funding_rates":
            parts.append(audit_funding_rates(tables[name], config, symbols))
        else:
            parts.append(audit_universe(tables[name], config, symbols))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
