"""Candles from an event stream, corrected by late events inside the watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import specs
from tidemark.session import scratch_path
from tidemark.sources import tables

LATENESS = "3 days"
# What takers bought, as SQL over the events.
TAKER_SUMS = {"taker_buy_base_volume": "qty", "taker_buy_quote_volume": "value * qty"}


def streaming_candles(
    events: DataFrame, width: str = "1 hour", interval: str = "1h", lateness: str = LATENESS
) -> DataFrame:
    """Candles of an event stream (event_id, ts, symbol, value, qty, taker), closed by the watermark.

    An event delivered twice inside the watermark counts once. A candle is emitted when its
    window can no longer change; until then late events correct it in state.
    """
    stream = (
        events.withColumn("ts", F.col("ts").cast("timestamp"))
        .withWatermark("ts", lateness)
        .dropDuplicatesWithinWatermark(["event_id"])
    )
    return _candles(stream, width, interval)


def _candles(events: DataFrame, width: str, interval: str) -> DataFrame:
    """All columns of a candle, over a stream or a table of events; ties on ``ts`` go by value."""
    return (
        events.groupBy("symbol", F.window("ts", width).alias("_w"))
        .agg(
            F.min_by("value", F.struct("ts", "value")).alias("open"),
            F.max("value").alias("high"),
            F.min("value").alias("low"),
            F.max_by("value", F.struct("ts", "value")).alias("close"),
            F.sum("qty").alias("volume"),
            F.sum(F.col("value") * F.col("qty")).alias("quote_volume"),
            F.count("*").cast("int").alias("trades_count"),
            *[
                F.coalesce(F.sum(F.when(F.col("taker"), F.expr(amount))), F.lit(0.0)).alias(name)
                for name, amount in TAKER_SUMS.items()
            ],
        )
        .select(
            F.lit(specs.EXCHANGE).alias("exchange"),
            "symbol",
            F.lit(interval).alias("interval"),
            F.col("_w.end").cast("timestamp_ntz").alias("timestamp"),
            "open",
            "high",
            "low",
            "close",
            "volume",
            "quote_volume",
            "trades_count",
            *TAKER_SUMS,
        )
    )


def open_candles(
    events: DataFrame, width: str = "1 hour", interval: str = "1h", lateness: str = LATENESS
) -> DataFrame:
    """Candles of a table of events that a stream over them has not closed yet.

    These are the windows that end after the newest event less the lateness. Together with what
    the stream has written they are all candles so far.
    """
    once = events.withColumn("ts", F.col("ts").cast("timestamp")).dropDuplicates(["event_id"])
    watermark = once.agg(F.max("ts").alias("_newest")).select(
        (F.col("_newest") - F.expr(f"interval {lateness}")).cast("timestamp_ntz").alias("_watermark")
    )
    # One row on the right.
    candles = _candles(once, width, interval).crossJoin(F.broadcast(watermark))
    return candles.where(F.col("timestamp") > F.col("_watermark")).drop("_watermark")


def store_updates(candles: DataFrame, root: str, table: str, checkpoint: str) -> StreamingQuery:
    """Keep a stored table up to date with a stream of candles, the open ones included.

    In update mode each turn hands on every candle that its events have touched, as a whole and not
    as a difference, and the candle takes the place of the stored one. So open windows are in the
    table at once, late events correct them as long as the watermark allows, events delivered again
    change nothing, and a turn repeated after a failure writes the same rows. The run ends when
    all that has arrived is done; the next one with this ``checkpoint`` goes on from there.
    """

    def merge(batch: DataFrame, _: int) -> None:
        tables.merge_rows(batch.sparkSession, root, table, batch)

    return (
        candles.writeStream.outputMode("update")
        .foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_to_table(spark: SparkSession, stream: DataFrame, label: str) -> DataFrame:
    """Process everything available into a parquet folder and return it as a table."""
    out, checkpoint = scratch_path(spark, label), scratch_path(spark, f"{label}-state")
    query = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)
