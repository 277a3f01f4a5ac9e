"""Market-shaped views over generic event and order tables.

The queries of this repository run on these views: candles, open interest, funding rates
and rankings derived by Spark from the whole input tables, plus variants with planted faults
so that no check is exercised on clean data only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import specs
from tidemark.functions.scalars import day_after, epoch_seconds, ntz_from_seconds, shift_seconds

CANDLE_COLUMNS = specs.CANDLE_SCHEMA.fieldNames()


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bucket_end(ts: str, seconds: int):
    """Close boundary of the epoch-aligned bucket that holds ``ts``."""
    return ntz_from_seconds((F.floor(epoch_seconds(ts) / seconds) + 1).cast("bigint") * seconds)


def hourly_candles(spark: SparkSession, folder: str) -> DataFrame:
    """One spot candle per event type and hour, keyed by its close boundary."""
    quantity = (1 + F.col("event_id") % 7).cast("double")
    taker = F.col("event_id") % 2 == 0
    return (
        read_table(spark, folder, "events")
        .where(F.col("value") > 0)
        .select(
            F.concat(F.upper("event_type"), F.lit(specs.QUOTE_ASSET)).alias("symbol"),
            bucket_end("ts", 3_600).alias("timestamp"),
            "ts",
            "value",
            quantity.alias("qty"),
            taker.alias("taker"),
        )
        .groupBy("symbol", "timestamp")
        .agg(
            F.min_by("value", "ts").alias("open"),
            F.max("value").alias("high"),
            F.min("value").alias("low"),
            F.max_by("value", "ts").alias("close"),
            F.sum("qty").alias("volume"),
            F.sum(F.col("value") * F.col("qty")).alias("quote_volume"),
            F.count("*").cast("int").alias("trades_count"),
            F.coalesce(F.sum(F.when(F.col("taker"), F.col("qty"))), F.lit(0.0)).alias(
                "taker_buy_base_volume"
            ),
            F.coalesce(
                F.sum(F.when(F.col("taker"), F.col("value") * F.col("qty"))), F.lit(0.0)
            ).alias("taker_buy_quote_volume"),
        )
        .withColumns({"exchange": F.lit(specs.EXCHANGE), "interval": F.lit("1h")})
        .select(*CANDLE_COLUMNS)
    )


def dirty_candles(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly candles with one planted fault of every kind the audit looks for."""
    clean = hourly_candles(spark, folder)
    code = F.pmod(
        (epoch_seconds("timestamp") / 3_600).cast("bigint") + F.length("symbol"), F.lit(97)
    )
    frozen = (
        (F.col("symbol") == "ERRORUSDT")
        & (F.col("timestamp") > F.lit("2024-01-05 00:00:00").cast("timestamp_ntz"))
        & (F.col("timestamp") <= F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))
    )
    fault = clean.withColumn("_fc", F.when(frozen, F.lit(-1)).otherwise(code))

    def when_fault(number: int, changed, column: str, frozen_value):
        return (
            F.when(F.col("_fc") == -1, frozen_value)
            .when(F.col("_fc") == number, changed)
            .otherwise(F.col(column))
        )

    flat, none = F.lit(10.0), F.lit(0.0)
    return (
        fault.withColumn(
            "_copy",
            F.explode(F.sequence(F.lit(1), F.when(F.col("_fc") == 11, 2).otherwise(1))),
        )
        .select(
            "exchange",
            "symbol",
            "interval",
            F.when(F.col("_fc") == 13, shift_seconds("timestamp", 17))
            .otherwise(F.col("timestamp"))
            .alias("timestamp"),
            F.when(F.col("_fc") == -1, flat).otherwise(F.col("open")).alias("open"),
            when_fault(3, F.col("low") * 0.9, "high", flat).alias("high"),
            F.when(F.col("_fc") == -1, flat).otherwise(F.col("low")).alias("low"),
            when_fault(17, F.lit(None).cast("double"), "close", flat).alias("close"),
            F.when(F.col("_fc") == -1, none)
            .when(F.col("_fc") == 7, F.lit(-1.0))
            .when(F.col("_fc") == 19, F.col("volume") * 1_000)
            .otherwise(F.col("volume"))
            .alias("volume"),
            F.when(F.col("_fc") == -1, none)
            .when(F.col("_fc") == 5, F.lit(0.0))
            .when(F.col("_fc") == 19, F.col("quote_volume") * 1_000)
            .otherwise(F.col("quote_volume"))
            .alias("quote_volume"),
            F.when(F.col("_fc") == -1, F.lit(0))
            .otherwise(F.col("trades_count"))
            .cast("int")
            .alias("trades_count"),
            when_fault(23, F.col("volume") * 2, "taker_buy_base_volume", none).alias(
                "taker_buy_base_volume"
            ),
            F.when(F.col("_fc") == -1, none)
            .otherwise(F.col("taker_buy_quote_volume"))
            .alias("taker_buy_quote_volume"),
        )
        .select(*CANDLE_COLUMNS)
    )


def holed_candles(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly candles with every eleventh hour taken out: the target of a repair."""
    hour = (epoch_seconds("timestamp") / 3_600).cast("bigint")
    return hourly_candles(spark, folder).where(F.pmod(hour, F.lit(11)) != 4)


def daily_candles(spark: SparkSession, folder: str) -> DataFrame:
    """One candle per nation and order day."""
    orders = read_table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("day")
    )
    customers = read_table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nations = read_table(spark, folder, "nation").select("n_nationkey", "n_name")
    return (
        orders.join(customers, orders["o_custkey"] == customers["c_custkey"])
        .join(nations, F.col("c_nationkey") == nations["n_nationkey"])
        .select(
            F.concat(
                F.regexp_replace(F.upper("n_name"), "_", ""), F.lit(specs.QUOTE_ASSET)
            ).alias("symbol"),
            day_after(F.col("day").cast("timestamp_ntz")).alias("timestamp"),
            "o_orderkey",
            "o_totalprice",
            (1 + F.col("o_orderkey") % 5).cast("double").alias("qty"),
        )
        .groupBy("symbol", "timestamp")
        .agg(
            F.min_by("o_totalprice", "o_orderkey").alias("open"),
            F.max("o_totalprice").alias("high"),
            F.min("o_totalprice").alias("low"),
            F.max_by("o_totalprice", "o_orderkey").alias("close"),
            F.sum("qty").alias("volume"),
            F.sum(F.col("o_totalprice") * F.col("qty")).alias("quote_volume"),
            F.count("*").cast("int").alias("trades_count"),
        )
        .withColumns(
            {
                "exchange": F.lit(specs.EXCHANGE),
                "interval": F.lit("1d"),
                "taker_buy_base_volume": F.lit(None).cast("double"),
                "taker_buy_quote_volume": F.lit(None).cast("double"),
            }
        )
        .select(*CANDLE_COLUMNS)
    )


def rankings(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly ranking snapshots of nations by order value."""
    orders = read_table(spark, folder, "orders").select(
        "o_custkey", "o_totalprice", F.trunc(F.to_date("o_orderdate"), "MM").alias("date")
    )
    customers = read_table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nations = read_table(spark, folder, "nation").select("n_nationkey", "n_name")
    totals = (
        orders.join(customers, orders["o_custkey"] == customers["c_custkey"])
        .groupBy("date", "c_nationkey")
        .agg(F.round(F.sum("o_totalprice"), 2).alias("market_cap"))
    )
    # A month holds at most one row per nation, so ranking it needs one small task.
    ranked = totals.withColumn(
        "rank",
        F.row_number()
        .over(Window.partitionBy("date").orderBy(F.col("market_cap").desc(), "c_nationkey"))
        .cast("int"),
    )
    provider_id = (F.col("c_nationkey") + 1).cast("bigint")
    symbol = F.regexp_replace(F.upper("n_name"), "_", "")
    return (
        ranked.join(nations, F.col("c_nationkey") == nations["n_nationkey"])
        .select(
            F.lit(specs.PROVIDER).alias("provider"),
            provider_id.alias("provider_id"),
            "date",
            symbol.alias("symbol"),
            F.col("n_name").alias("name"),
            F.lower("n_name").alias("slug"),
            "rank",
            "market_cap",
            (F.col("market_cap") * 2).alias("fully_diluted_market_cap"),
            F.lit(None).cast("double").alias("circulating_supply"),
            F.lit(None).cast("double").alias("max_supply"),
            F.when(provider_id % 8 == 0, "defi, Stablecoin")
            .when(provider_id % 8 == 1, "stablecoin-protocol")
            .otherwise("defi")
            .alias("tags"),
            F.when(provider_id % 3 == 0, "NationChain").alias("platform"),
            F.lit(None).cast("date").alias("date_added"),
        )
        .select(*specs.UNIVERSE_SCHEMA.fieldNames())
    )


def dirty_rankings(spark: SparkSession, folder: str) -> DataFrame:
    """Rankings with planted faults: a missing month, missing and duplicate ranks, copies,
    duplicate symbols, negative and inverted market caps."""
    month = (F.year("date") * 12 + F.month("date")).cast("bigint")
    code = F.pmod(month * 31 + F.col("provider_id"), F.lit(41))
    return (
        rankings(spark, folder)
        .where(F.pmod(month, F.lit(17)) != 5)
        .withColumn("_fc", code)
        .where(F.col("_fc") != 2)
        .withColumn(
            "_copy",
            F.explode(F.sequence(F.lit(1), F.when(F.col("_fc") == 7, 2).otherwise(1))),
        )
        .withColumns(
            {
                "rank": F.when(F.col("_fc") == 11, F.col("rank") + 1)
                .when(F.col("_fc") == 13, F.lit(0))
                .otherwise(F.col("rank"))
                .cast("int"),
                "symbol": F.when(F.col("_fc") == 17, F.lit("NATION1")).otherwise(F.col("symbol")),
                "market_cap": F.when(F.col("_fc") == 19, -F.col("market_cap"))
                .when(F.col("_fc") == 23, F.col("market_cap") * 10)
                .when(F.col("_fc") == 29, F.lit(None).cast("double"))
                .otherwise(F.col("market_cap")),
            }
        )
        .select(*specs.UNIVERSE_SCHEMA.fieldNames())
    )


def open_interest(spark: SparkSession, folder: str) -> DataFrame:
    """Last event value per symbol and five-minute bucket."""
    return (
        read_table(spark, folder, "events")
        .select(
            F.concat(F.upper("event_type"), F.lit(specs.QUOTE_ASSET)).alias("symbol"),
            bucket_end("ts", 300).alias("timestamp"),
            "ts",
            "value",
        )
        .groupBy("symbol", "timestamp")
        .agg(F.max_by("value", "ts").alias("open_interest"))
        .select(F.lit(specs.EXCHANGE).alias("exchange"), "symbol", "timestamp", "open_interest")
    )


def dirty_open_interest(spark: SparkSession, folder: str) -> DataFrame:
    """Open interest with copies, zeros and nulls planted."""
    code = F.pmod(
        (epoch_seconds("timestamp") / 300).cast("bigint") + F.length("symbol"), F.lit(89)
    )
    return (
        open_interest(spark, folder)
        .withColumn("_fc", code)
        .withColumn(
            "_copy",
            F.explode(F.sequence(F.lit(1), F.when(F.col("_fc") == 3, 3).otherwise(1))),
        )
        .select(
            "exchange",
            "symbol",
            "timestamp",
            F.when(F.col("_fc") == 5, F.lit(0.0))
            .when(F.col("_fc") == 7, F.lit(None).cast("double"))
            .otherwise(F.col("open_interest"))
            .alias("open_interest"),
        )
    )


def mean_rate():
    """Funding rate of a bucket; the tiny offset keeps exact halves from rounding either way."""
    return F.round((F.avg("value") - 50) / 1_000 + 3e-10, 6)


def funding_rates(spark: SparkSession, folder: str) -> DataFrame:
    """Mean event value per symbol and eight-hour bucket, with every 17th bucket left out."""
    return (
        read_table(spark, folder, "events")
        .select(
            F.concat(F.upper("event_type"), F.lit(specs.QUOTE_ASSET)).alias("symbol"),
            bucket_end("ts", 28_800).alias("timestamp"),
            "value",
        )
        .groupBy("symbol", "timestamp")
        .agg(mean_rate().alias("funding_rate"))
        .where(
            F.pmod((epoch_seconds("timestamp") / 28_800).cast("bigint"), F.lit(17)) != 3
        )
        .select(F.lit(specs.EXCHANGE).alias("exchange"), "symbol", "timestamp", "funding_rate")
    )
