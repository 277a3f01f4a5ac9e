"""A registered query: how Spark builds it, and the same result in plain SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import configure

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    build: Build
    sql: str | None = None


class Registry:
    """Queries by name; ``add`` is used as a decorator on the build function."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Build], Build]:
        if name in self.queries:
            raise ValueError(f"query {name!r} is registered twice")

        def register(build: Build) -> Build:
            def configured(spark: SparkSession, folder: str) -> DataFrame:
                return build(configure(spark), folder)

            self.queries[name] = Query(configured, sql)
            return build

        return register


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round derived doubles, whose last bits depend on the order of summation."""
    return df.withColumns({c: F.round(c, digits) for c in columns})
