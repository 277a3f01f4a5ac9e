"""Counted slices, places and wide rolling windows against plain computations."""

from __future__ import annotations

import math
import random
from collections import Counter
from datetime import timedelta

import pytest
from conftest import START
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions import blocks, ordered
from tidemark.functions import quantiles as qs
from tidemark.operators.resample import rolling_volatility

LIMIT = 16


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(ordered, "SLICE_STEPS", LIMIT)


def awkward_rows():
    """On the cadence, microseconds apart, one time only, no time at all, and a bit of each."""
    rng = random.Random(3)
    hours = [("even", START + timedelta(hours=i), rng.uniform(1, 2)) for i in range(200)]
    micros = [("micros", START + timedelta(microseconds=3 * i), rng.uniform(1, 2)) for i in range(500)]
    once = [("once", START, rng.uniform(1, 2)) for _ in range(300)]
    never = [("never", None, rng.uniform(1, 2)) for _ in range(300)]
    far = [("mixed", START + timedelta(days=9_000 * i), 1.0 + i) for i in range(3)]
    return hours + micros + once + never + far + [("mixed", None, 1.5)] * 5 + [("mixed", t, v) for _, t, v in micros]


@pytest.mark.parametrize("broadcast", [True, False])
def test_slices_hold_few_rows_and_follow_the_order(spark, small, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(qs, "BROADCAST_BYTES", 0)
        monkeypatch.setattr(qs, "ROWS_PER_REPLICA", 50)
    rows = awkward_rows()
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double")
    cut = blocks.with_counted_slices(df, ["k"], ["ts", "v"], F.lit(3_600))
    found = [(r["k"], r["ts"], r["v"], tuple(r[ordered.SLICE])) for r in cut.collect()]
    assert Counter(r[:3] for r in found) == Counter(rows)
    assert max(Counter((k, s) for k, _, _, s in found).values()) <= LIMIT
    nulls_first = lambda x: (x is not None, x or 0)
    for key in {r[0] for r in rows}:
        own = sorted((r for r in found if r[0] == key), key=lambda r: (r[1] is not None, r[1] or START, r[2]))
        slices = [[nulls_first(x) for x in r[3]] for r in own]
        assert slices == sorted(slices)


def test_rows_equal_in_their_order_end_the_division(spark, small):
    df = spark.createDataFrame([("a", START, 1.0)] * 100 + [("a", None, None)] * 100, "k string, ts timestamp_ntz, v double")
    placed = blocks.with_positions(df, ["k"], ["ts", "v"], F.lit(3_600))
    assert sorted(r[0] for r in placed.select(blocks.POSITION).collect()) == list(range(200))


def test_a_series_on_its_cadence_is_left_as_it_is(spark, small):
    df = spark.createDataFrame([r for r in awkward_rows() if r[0] == "even"], "k string, ts timestamp_ntz, v double")
    cut = blocks.with_counted_slices(df, ["k"], ["ts", "v"], F.lit(3_600))
    assert {len(r[0]) for r in cut.select(ordered.SLICE).collect()} == {1}


@pytest.mark.parametrize("width", [LIMIT + 1, 2 * LIMIT, 83, 5_000])
def test_wide_windows_equal_plain_ones(spark, small, width):
    rows = [r for r in awkward_rows() if r[0] != "never"]
    df = spark.createDataFrame(
        [("x", k, "1h", t, v) for k, t, v in rows], "exchange string, symbol string, interval string, timestamp timestamp_ntz, close double"
    ).repartition(5)
    whole = Window.partitionBy("symbol").orderBy("timestamp", "close")
    plain = df.withColumn("log_return", F.ln(F.col("close") / F.lag("close").over(whole))).withColumn(
        "volatility", F.stddev_samp("log_return").over(whole.rowsBetween(-(width - 1), 0))
    )

    def key(row):
        return row["symbol"], str(row["timestamp"]), row["close"]

    theirs = sorted(((key(r), r["volatility"]) for r in plain.collect()), key=repr)
    ours = sorted(((key(r), r["volatility"]) for r in rolling_volatility(df, width).collect()), key=repr)
    assert [k for k, _ in ours] == [k for k, _ in theirs]
    for (k, a), (_, b) in zip(ours, theirs, strict=True):
        if k[0] == "mixed" and k[1] == "None":
            continue  # rows equal in all columns may swap places
        assert (a is None) == (b is None) and (a is None or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12)), k


def test_no_task_needs_a_whole_series(spark, small):
    """The moments are stored by block; what remains are joins on (series, place) and (series, block)."""
    rows = [("s", i, float(i % 7)) for i in range(2_000)]
    placed = spark.createDataFrame(rows, f"symbol string, {blocks.POSITION} bigint, v double")
    wide = blocks.rolling_deviation(placed, ["symbol"], "v", 100, "d")
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert wide.count() == 2_000
    held = placed.groupBy("symbol", blocks.block_of(blocks.POSITION)).count().agg(F.max("count")).first()[0]
    assert held == LIMIT


def test_narrow_windows_are_refused_here(spark):
    with pytest.raises(ValueError, match="no wider"):
        blocks.rolling_deviation(spark.range(1), ["id"], "id", 5, "d")


def test_empty_series(spark):
    df = spark.createDataFrame([], "exchange string, symbol string, interval string, timestamp timestamp_ntz, close double")
    assert rolling_volatility(df, 10_000).count() == 0


def shuffled_records(spark):
    context = spark.sparkContext
    none = context._gateway.new_array(context._jvm.double, 0)
    stages = context._jsc.sc().statusStore().stageList(None, False, False, none, context._jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def test_rows_are_shuffled_once_for_their_places_and_twice_for_their_windows(spark):
    """Own block and edge are all that a row is sent to; nothing with moments is joined row by row."""
    n, width = 40_000, 10_000
    df = spark.range(n).select(
        F.lit("x").alias("exchange"),
        F.lit("s").alias("symbol"),
        F.lit("1d").alias("interval"),
        (F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") * 7)).alias("timestamp"),
        (1 + F.col("id") * 37 % 101).cast("double").alias("close"),
    )
    before, threshold = shuffled_records(spark), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    # Joins as on large tables, which are not broadcast.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rolling_volatility(df, width).count() == n
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert shuffled_records(spark) - before < 3.2 * n
