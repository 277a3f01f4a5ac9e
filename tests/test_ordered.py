"""Sliced windows, runs and distributed quantiles against plain computations."""

from __future__ import annotations

import random
from collections import Counter
from datetime import timedelta

import numpy as np
import pytest
from conftest import START
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions import ordered, quantiles


@pytest.fixture
def tiny_slices(monkeypatch):
    monkeypatch.setattr(ordered, "SLICE_STEPS", 4)


def series(spark, n=300, seed=1):
    rng = random.Random(seed)
    rows = []
    for key in ("a", "b", "c"):
        at = START
        for _ in range(n):
            at += timedelta(hours=rng.choice([1, 1, 1, 2, 5, 40]))
            rows.append((key, at, rng.random()))
    return spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double")


@pytest.mark.parametrize("reach", [1, 3, 9])
def test_trailing_equals_plain_window(spark, tiny_slices, reach):
    df = series(spark)
    whole = Window.partitionBy("k").orderBy("ts")
    sliced = ordered.with_trailing(
        df,
        ["k"],
        ["ts"],
        reach,
        {
            "before": lambda w: F.lag("v", reach).over(w),
            "mean": lambda w: F.round(F.avg("v").over(w.rowsBetween(-reach, 0)), 9),
        },
        ordered.time_slice("ts", 3_600),
    )
    plain = df.withColumns(
        {
            "before": F.lag("v", reach).over(whole),
            "mean": F.round(F.avg("v").over(whole.rowsBetween(-reach, 0)), 9),
        }
    )
    columns = plain.columns
    assert Counter(map(tuple, sliced.select(columns).collect())) == Counter(
        map(tuple, plain.collect())
    )


def test_no_series_window_sees_more_than_borders(spark):
    """Both windows read one shuffle of the rows."""
    df = ordered.with_previous(
        series(spark), ["k"], ["ts"], ["v"], ordered.time_slice("ts", 3_600)
    )
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan


def test_runs_equal_plain_numbering(spark, tiny_slices):
    rng = random.Random(5)
    rows, at = [], START
    for _ in range(400):
        at += timedelta(minutes=rng.choice([60] * 12 + [30, 120]))
        rows.append(("a", at, rng.random() < 0.85))
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, on boolean")
    found = ordered.runs_of(
        df, ["k"], ["ts"], "on", F.lit(3_600), ordered.time_slice("ts", 3_600)
    )
    expected, previous = [], (None, False)
    for _, ts, on in rows:
        if on and previous[1] and ts - previous[0] == timedelta(hours=1):
            expected[-1][1:] = [ts, expected[-1][2] + 1]
        elif on:
            expected.append([ts, ts, 1])
        previous = (ts, on)
    columns = ("first_timestamp", "last_timestamp", "observations")
    assert sorted(map(list, found.select(*columns).collect())) == expected
    assert max(run[2] for run in expected) > 2 * ordered.SLICE_STEPS


@pytest.mark.parametrize("kind", ["spread", "copies", "two_values", "single"])
def test_exact_quantiles(spark, kind):
    rng = np.random.default_rng(3)
    values = {
        "spread": rng.normal(size=5_000),
        "copies": np.concatenate([np.full(3_000, 0.25), rng.random(2_000)]),
        "two_values": rng.integers(0, 2, 999).astype(float),
        "single": np.array([4.0]),
    }[kind]
    df = spark.createDataFrame([("g", float(v)) for v in values], "g string, v double")
    wanted = {"q1": 0.25, "q2": 0.5, "q3": 0.75}
    row = quantiles.quantiles(df, ["g"], "v", wanted).first()
    assert row["n"] == len(values)
    for name, p in wanted.items():
        assert row[name] == pytest.approx(np.quantile(values, p), abs=1e-12)


def test_weighted_quantiles(spark):
    pairs = [(0.5, 1), (0.0, 700), (1.5, 2), (2.5, 1), (9.0, 400)]
    expanded = np.concatenate([np.full(w, v) for v, w in pairs])
    df = spark.createDataFrame([("g", v, w) for v, w in pairs], "g string, v double, w bigint")
    row = quantiles.quantiles(df, ["g"], "v", {"q": 0.5, "r": 0.9}, "w").first()
    assert row["n"] == len(expanded)
    assert row["q"] == pytest.approx(np.quantile(expanded, 0.5))
    assert row["r"] == pytest.approx(np.quantile(expanded, 0.9))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=60))
def test_quantiles_of_any_values(spark, values):
    df = spark.createDataFrame([("g", v) for v in values], "g string, v double")
    row = quantiles.quantiles(df, ["g"], "v", {"q": 0.3}).first()
    assert row["q"] == pytest.approx(np.quantile(values, 0.3), rel=1e-9, abs=1e-9)


def test_group_stats_reach_every_row(spark):
    rows = spark.range(1_000).withColumn("g", F.lit("hot"))
    stats = spark.createDataFrame([("hot", 7)], "g string, s int")
    joined = quantiles.join_group_stats(rows, stats, ["g"], ["id"])
    assert joined.count() == 1_000 and joined.where("s = 7").count() == 1_000


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=True, allow_infinity=True), min_size=1, max_size=80))
def test_keys_order_doubles_and_give_them_back(spark, values):
    edges = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, -1e-310]
    edges += [float("inf"), float("-inf"), float("nan")] + [2.0**e * m for e in (-1022, -53, 0, 52, 1023) for m in (1, 1 - 2**-53, 1 + 2**-52)]
    df = spark.createDataFrame([(v,) for v in values + edges], "v double").withColumn("k", quantiles.ordered_key("v"))
    rows = [(r["v"], r["k"], r["b"]) for r in df.withColumn("b", quantiles.ordered_value("k")).collect()]
    order = lambda v: (np.isnan(v), 0.0 if np.isnan(v) else v)
    for v, _, back in rows:
        assert back == v or (np.isnan(v) and np.isnan(back))
    by_key = [order(v) for v, _, _ in sorted(rows, key=lambda r: r[1])]
    assert by_key == sorted(by_key)
    assert all((a[1] == b[1]) == (order(a[0]) == order(b[0])) for a, b in zip(rows, rows[1:], strict=False))


def test_counted_replicas_follow_hot_groups(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "ROWS_PER_REPLICA", 100)
    monkeypatch.setattr(quantiles, "BROADCAST_BYTES", 0)
    rows = spark.range(30_000).withColumn("g", F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 4_000)).repartition(8)
    stats = rows.groupBy("g").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    for k, v in {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "64"}.items():
        spark.conf.set(k, v)
    try:
        joined = quantiles.join_group_stats(rows, stats, ["g"], ["id"], size="n")
        # The join's own partitions: no task holds much more than its share of the hot group.
        held = [len(part) for part in joined.select("id").rdd.glom().collect()]
        groups = stats.count()
        copies = stats.select(F.sum(F.greatest(F.lit(1), F.ceil(F.col("n") / 100)))).first()[0]
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert sum(held) == 30_000 and joined.where("top IS NULL").count() == 0
    assert copies < 2 * groups and max(held) < 0.1 * 30_000


def test_a_hot_group_is_counted_in_every_task(spark):
    rng = np.random.default_rng(5)
    values = rng.normal(size=30_000)
    rows = [("hot" if i % 3 == 0 else f"g{i % 500}", float(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(8)
    found = {r["g"]: (r["n"], r["q"], r["t"]) for r in quantiles.quantiles(df, ["g"], "v", {"q": 0.5, "t": 0.99}).collect()}
    by = {}
    for g, v in rows:
        by.setdefault(g, []).append(v)
    assert found.keys() == by.keys()
    for g, held in by.items():
        assert found[g][0] == len(held) and found[g][1:] == pytest.approx(tuple(np.quantile(held, [0.5, 0.99])), abs=1e-12)
    # What a task hands on in the first round is a count for each bucket, far fewer than the rows of the hot group.
    keyed = df.where("g = 'hot'").select(quantiles.ordered_key("v").alias("k"))
    buckets = keyed.groupBy(F.shiftright("k", 64 - quantiles.ROUNDS[0])).count()
    assert buckets.agg(F.max("count")).first()[0] < 200
