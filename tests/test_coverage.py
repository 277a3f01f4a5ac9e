"""Kept summaries of days: equal to a rescan after every kind of write, and enough to plan with."""

from __future__ import annotations

import shutil
import tempfile
from collections import Counter
from datetime import datetime, timedelta

import pytest
from conftest import START, candle, every
from pyspark.sql import functions as F

from tidemark.operators import coverage
from tidemark.operators import planning as pl
from tidemark.plans import warehouse
from tidemark.plans.catalog import catalogue
from tidemark.sources import tables


@pytest.fixture
def root():
    return tempfile.mkdtemp(prefix="store-", dir="/tmp")


def rescan(spark, root, table):
    rows = coverage.day_summaries(tables.read_table(spark, root, table), table, ["month"]).drop("month")
    return Counter(tuple(row) for row in rows.collect())


def kept(spark, root, table):
    rows = tables.read_coverage(spark, root, table)
    return Counter(tuple(row) for row in rows.collect())


def files_read(df, root):
    """Which stored tables the plan reads files of."""
    names = {path.split(root, 1)[1] for path in df.inputFiles() if root in path}
    return {name.split("/month=")[0].split("/interval=")[0].strip("/") for name in names}


def test_summaries_follow_every_write(spark, candles, root):
    rows = [candle(t, interval="4h") for t in every(4, 6 * 40)[1:]]
    tables.create_table(candles(rows[::3]), root, "spot")
    assert kept(spark, root, "spot") == rescan(spark, root, "spot")
    # Into the holes of the days that are summarised already.
    tables.insert_new(spark, root, "spot", candles(rows))
    assert kept(spark, root, "spot") == rescan(spark, root, "spot")
    day = candles(rows).where("to_date(timestamp - interval 1 second) = '2024-01-05'").limit(2)
    days = spark.createDataFrame([("BTCUSDT", "4h", "2024-01-05")], "symbol string, interval string, day string")
    tables.replace_days(spark, root, "spot", day, days.withColumn("day", F.to_date("day")))
    assert kept(spark, root, "spot") == rescan(spark, root, "spot")
    tables.merge_rows(spark, root, "spot", candles([candle(START + timedelta(days=60), "ETHUSDT")]))
    assert kept(spark, root, "spot") == rescan(spark, root, "spot")
    # A month that loses all its rows loses its summaries.
    symbols = spark.createDataFrame([("BTCUSDT",)], "symbol string")
    low, high = (F.lit(x).cast("timestamp_ntz") for x in ("2024-01-01", "2024-01-20"))
    assert tables.prune(spark, root, "spot", symbols, ["4h"], low, high) > 0
    found = kept(spark, root, "spot")
    assert found == rescan(spark, root, "spot")
    assert {(row[1], str(row[3])[:7]) for row in found} == {("BTCUSDT", "2024-01"), ("ETHUSDT", "2024-02")}


def test_partitions_without_summaries_are_scanned(spark, candles, root):
    rows = [candle(t) for t in every(4, 6 * 40)[1:]]
    tables.insert_new(spark, root, "spot", candles(rows))
    whole = kept(spark, root, "spot")
    assert files_read(tables.read_coverage(spark, root, "spot"), root) == {"_coverage/spot"}
    # What a write that was broken off leaves behind.
    shutil.rmtree(f"{root}/_coverage/spot/interval=4h/month=2024-01")
    assert files_read(tables.read_coverage(spark, root, "spot"), root) == {"_coverage/spot", "spot"}
    assert kept(spark, root, "spot") == whole
    shutil.rmtree(f"{root}/_coverage")
    assert kept(spark, root, "spot") == whole
    tables.renew_coverage(spark, root, "spot")
    assert files_read(tables.read_coverage(spark, root, "spot"), root) == {"_coverage/spot"}
    assert kept(spark, root, "spot") == whole


def test_ranges_and_intervals_select_partitions(spark, candles, root):
    rows = [candle(t, interval=i) for i in ("4h", "1h") for t in every(4, 6 * 40)[1:]]
    tables.insert_new(spark, root, "spot", candles(rows))
    found = tables.read_coverage(spark, root, "spot", intervals=["1h"], months=("2024-02", "2024-03"))
    got = {(r["interval"], f"{r['day']:%Y-%m}") for r in found.collect()}
    assert got == {("1h", "2024-02")}
    assert tables.read_coverage(spark, root, "spot", intervals=["5m"]).count() == 0


def test_a_day_in_two_partitions_is_judged_as_one(spark, metrics, root):
    """Midnight of the first lies in the partition of the month before it."""
    times = every(8, 3 * 60)
    tables.insert_new(spark, root, "funding_rates", metrics("funding_rates", [("BTCUSDT", t, 0.1) for t in times]))
    days = tables.read_coverage(spark, root, "funding_rates")
    assert days.where("day = date'2024-02-01'").count() == 2
    periods = spark.createDataFrame(
        [("BTCUSDT", p) for p in ("2024-01", "2024-02", "2024-02-01", "2024-02-28", "2024-03-05")],
        "symbol string, period string",
    )
    stored = tables.read_table(spark, root, "funding_rates")
    told = pl.stored_period_status(periods, days, "funding_rates")
    scanned = pl.metric_period_status(periods, stored, "funding_rates")
    rows = sorted(tuple(r) for r in told.select("period", "row_count", "complete").collect())
    assert rows == sorted(tuple(r) for r in scanned.select("period", "row_count", "complete").collect())
    assert rows == [
        ("2024-01", 93, True),
        ("2024-02", 87, True),
        ("2024-02-01", 3, True),
        ("2024-02-28", 3, True),
        ("2024-03-05", 0, False),
    ]


def test_a_hole_over_midnight_breaks_the_month_not_the_days(spark, metrics, root):
    times = [t for t in every(8, 3 * 31) if t not in (START + timedelta(days=9, hours=16), START + timedelta(days=10))]
    tables.insert_new(spark, root, "funding_rates", metrics("funding_rates", [("BTCUSDT", t, 0.1) for t in times]))
    days = tables.read_coverage(spark, root, "funding_rates")
    periods = spark.createDataFrame([("BTCUSDT", p) for p in ("2024-01", "2024-01-10")], "symbol string, period string")
    found = pl.stored_period_status(periods, days, "funding_rates").select("period", "complete").collect()
    assert dict(map(tuple, found)) == {"2024-01": False, "2024-01-10": False}


def test_copies_and_single_times(spark, metrics):
    """Copies count as rows with a gap of zero; one time has no gap; NULL times fill no period."""
    rows = metrics("funding_rates", [("A", START, 0.1)] * 3 + [("B", START, 0.1), ("C", None, 0.1), ("C", None, 0.1)])
    found = {r["symbol"]: r for r in coverage.day_summaries(rows, "funding_rates").collect()}
    assert [found[s]["row_count"] for s in "ABC"] == [3, 1, 2]
    assert all(found[s]["widest_gap"] is None for s in "ABC")
    assert found["C"]["day"] is None
    assert coverage.day_summaries(rows.limit(0), "funding_rates").count() == 0


def test_planning_reads_no_stored_rows(spark, candles, root):
    full = [candle(t, interval="1d") for t in every(24, 32)[1:]]
    tables.insert_new(spark, root, "spot", candles(full + [candle(START + timedelta(days=40), interval="1d")]))
    symbols = spark.createDataFrame([("BTCUSDT",)], "symbol string")
    available = spark.createDataFrame(
        [(f"f{m}", "BTCUSDT", "1d", f"2024-0{m}") for m in (1, 2)], "file string, symbol string, interval string, period string"
    )
    plan = warehouse.wanted_files(spark, root, "spot", symbols, available, ["1d"], "2024-01-01", "2024-02-29", "2024-06-01")
    assert files_read(plan, root) == {"_coverage/spot"}
    assert [r["period"] for r in plan.collect()] == ["2024-02"]


def test_totals_and_availability(spark, candles, root):
    tables.insert_new(spark, root, "spot", candles([candle(t) for t in every(4, 20)[1:]]))
    days = tables.read_coverage(spark, root, "spot")
    total = coverage.series_totals(days, "spot").first()
    assert (total["row_count"], total["first_timestamp"], total["last_timestamp"]) == (
        19, START + timedelta(hours=4), START + timedelta(hours=76),
    )
    stored = {"spot": tables.read_table(spark, root, "spot")}
    expected = [tuple(r) for r in pl.availability(stored, "4h").collect()]
    assert [tuple(r) for r in coverage.availability_of_days({"spot": days}, "4h").collect()] == expected


def test_availability_counts_rows_that_a_table_refuses(spark, tmp_path):
    """An open interest of zero breaks the contract; it is the first row of one symbol and all of another."""
    rows = [
        (1, datetime(2024, 1, 1, 5), "view", 0.0),
        (2, datetime(2024, 1, 3, 5), "view", 7.0),
        (3, datetime(2024, 1, 4, 5), "click", 0.0),
    ]
    events = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, event_type string, value double")
    events.write.parquet(f"{tmp_path}/events.parquet")
    found = catalogue()["coverage_availability"].build(spark, str(tmp_path)).collect()
    spans = {tuple(str(x) for x in row) for row in found if row["data_type"] == "open_interest"}
    assert spans == {
        ("VIEWUSDT", "open_interest", "2024-01-01", "2024-01-03"),
        ("CLICKUSDT", "open_interest", "2024-01-04", "2024-01-04"),
    }


def test_availability_of_refused_rows_alone(spark, tmp_path):
    rows = [(1, datetime(2024, 1, 1, 5), "view", 0.0)]
    events = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, event_type string, value double")
    events.write.parquet(f"{tmp_path}/events.parquet")
    found = catalogue()["coverage_availability"].build(spark, str(tmp_path)).collect()
    assert {row["data_type"] for row in found} == {"open_interest", "funding_rates"}
