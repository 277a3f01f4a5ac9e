"""Quality checks on small constructed tables with known findings."""

from __future__ import annotations

import json
from collections import Counter
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from conftest import START, candle, day, every
from pyspark.sql import functions as F

from tidemark.functions import ordered
from tidemark.operators import audit_candles as ac
from tidemark.operators import audit_metrics as am
from tidemark.operators import audit_universe as au
from tidemark.operators import diagnostics as dg
from tidemark.operators import findings as fd
from tidemark.operators.audit import audit
from tidemark.specs import AuditConfig

# Prices and volumes of the plain candle fit together with this quote volume.
FIT = {"quote_volume": 10_050.0}


def found(df):
    return {(r["check_name"], r["symbol"], r["interval"]): r for r in df.collect()}


def only(df, check):
    rows = [r for r in df.collect() if r["check_name"] == check]
    assert len(rows) == 1
    return rows[0], json.loads(rows[0]["metadata"])


def test_clean_candles_have_no_findings(candles):
    assert ac.audit_candles(candles([candle(ts) for ts in every(4, 5)])).count() == 0


def test_gap(candles):
    times = [START, START + timedelta(hours=4), START + timedelta(hours=12)]
    row, meta = only(ac.audit_candles(candles([candle(ts) for ts in times])), "time_gaps")
    assert (row["severity"], row["count"], row["message"]) == (
        "ERROR",
        1,
        "1 gaps detected; max gap 8h vs expected 4h",
    )
    assert meta == {"max_delta_seconds": 28_800, "expected_seconds": 14_400}
    assert row["first_timestamp"] == times[-1]


def test_variable_interval_has_no_gaps(candles):
    rows = [candle(datetime(2024, m, 1), interval="1M") for m in (1, 2, 5)]
    assert ac.time_gaps(candles(rows)).count() == 0


def test_gaps_of_other_exchanges_are_left_out(candles):
    rows = [candle(ts, exchange="other") for ts in (START, START + timedelta(days=9))]
    assert ac.time_gaps(candles(rows)).count() == 0


def test_duplicate_key(candles):
    row, meta = only(ac.audit_candles(candles([candle(START)] * 2)), "duplicate_primary_key")
    assert row["count"] == 1 and meta == {"max_occurrences": 2}


def test_volume_outlier(candles):
    volumes = [100.0 + i for i in range(20)] + [10_000.0]
    rows = [candle(ts, volume=v) for ts, v in zip(every(4, 21), volumes)]
    row, meta = only(ac.audit_candles(candles(rows)), "volume_outliers")
    assert row["severity"] == "WARN" and row["count"] == 1 and meta == {"max_volume": 10_000.0}


def test_alignment(candles):
    row, meta = only(
        ac.audit_candles(candles([candle(START + timedelta(hours=1))])), "timestamp_alignment"
    )
    assert row["count"] == 1 and meta == {"max_distance_seconds": 3_600}


def test_alignment_tolerance(candles):
    df = candles([candle(START + timedelta(seconds=30)), candle(START + timedelta(hours=4, seconds=-31))])
    config = AuditConfig(timestamp_alignment_tolerance_seconds=30)
    assert ac.row_check(df, "timestamp_alignment", config).first()["bad_count"] == 1


def test_quote_volume_band(candles):
    row, meta = only(
        ac.audit_candles(candles([candle(START, volume=10.0, quote_volume=1.0, taker_buy_base_volume=5.0,
                                         taker_buy_quote_volume=0.5)])),
        "volume_price_inconsistency",
    )
    assert row["count"] == 1
    assert meta["quote_volume_price_band_count"] == 1
    assert sum(meta.values()) == 1


@pytest.mark.parametrize(
    ("changes", "flag"),
    [
        ({"quote_volume": 0.0, "taker_buy_quote_volume": 0.0}, "positive_volume_zero_quote"),
        ({"volume": 0.0, "taker_buy_base_volume": 0.0}, "positive_quote_zero_volume"),
        ({"trades_count": 0}, "zero_trades_positive_volume"),
        ({"taker_buy_base_volume": 100.2}, "taker_base_exceeds_volume"),
        ({"taker_buy_quote_volume": 10_200.0}, "taker_quote_exceeds_quote_volume"),
    ],
)
def test_volume_flags(candles, changes, flag):
    row = ac.row_check(candles([candle(START, **FIT | changes)]), "volume_price_inconsistency").first()
    assert {f for f in ac.VOLUME_FLAGS if row[f"{f}_count"]} == {flag}


def test_missing_trades_count_is_no_zero_trades(candles):
    assert ac.row_check(candles([candle(START, trades_count=None, **FIT)]), "volume_price_inconsistency").count() == 0


def test_jump_with_zero_deviation(candles):
    closes = [100.0] * 20 + [1_000.0]
    rows = [candle(ts, close=c, high=max(101.0, c)) for ts, c in zip(every(4, 21), closes)]
    row = ac.robust_jumps(candles(rows)).first()
    assert row["bad_count"] == 1
    assert row["max_abs_relative_return"] == pytest.approx(9.0)


def test_jump_needs_twenty_returns(candles):
    closes = [100.0] * 19 + [1_000.0]
    rows = [candle(ts, close=c, high=1_000.0) for ts, c in zip(every(4, 20), closes)]
    assert ac.robust_jumps(candles(rows)).count() == 0


def test_wick(candles):
    row, meta = only(
        ac.audit_candles(candles([candle(START, high=250.0, close=100.0)])), "wick_outliers"
    )
    assert row["count"] == 1 and meta["max_range_pct"] > 1


FLAT = {
    "open": 10.0, "high": 10.0, "low": 10.0, "close": 10.0, "volume": 0.0, "quote_volume": 0.0,
    "trades_count": 0, "taker_buy_base_volume": 0.0, "taker_buy_quote_volume": 0.0,
}


@pytest.mark.parametrize("steps", [4_096, 2])
def test_stale_run_of_a_day(candles, monkeypatch, steps):
    monkeypatch.setattr(ordered, "SLICE_STEPS", steps)
    df = candles([candle(ts, **FLAT) for ts in every(4, 6)])
    row = ac.stale_price_runs(df).first()
    assert (row["bad_count"], row["max_observations"], row["max_duration_seconds"]) == (1, 6, 86_400)


def test_stale_run_breaks_on_copy_and_gap(candles):
    times = every(4, 20)
    rows = [candle(ts, **FLAT) for ts in times] + [candle(times[8], **FLAT)]
    row = ac.stale_price_runs(candles(rows)).first()
    assert (row["bad_count"], row["max_observations"]) == (2, 12)
    holed = [candle(ts, **FLAT) for i, ts in enumerate(times) if i != 8]
    row = ac.stale_price_runs(candles(holed)).first()
    assert (row["bad_count"], row["max_observations"]) == (2, 11)


@pytest.mark.parametrize(
    "changes",
    [
        {"close": None},
        {"close": float("nan")},
        {"open": 0.0},
        {"volume": -1.0},
        {"quote_volume": float("inf")},
        {"trades_count": -1},
        {"taker_buy_base_volume": float("nan")},
        {"timestamp": None},
    ],
)
def test_invalid_values(candles, changes):
    assert ac.row_check(candles([candle(START, **changes)]), "invalid_values").first()["bad_count"] == 1


def test_optional_columns_may_be_missing(candles):
    row = candle(START, trades_count=None, taker_buy_base_volume=None, taker_buy_quote_volume=None)
    assert ac.row_check(candles([row]), "invalid_values").count() == 0


def test_nan_price_counts_as_largest(candles):
    df = candles([candle(START, close=float("nan")), candle(START + timedelta(hours=4), close=None)])
    assert ac.row_check(df, "invalid_ohlc").first()["bad_count"] == 1


def test_metric_gaps(metrics):
    funding = metrics(
        "funding_rates", [("BTCUSDT", ts, 0.0001) for ts in (START, START + timedelta(hours=16))]
    )
    row, meta = only(am.audit_funding_rates(funding), "time_gaps")
    assert meta == {"max_delta_seconds": 57_600, "expected_seconds": 28_800}
    interest = metrics(
        "open_interest", [("BTCUSDT", START + timedelta(minutes=m), 5.0) for m in (0, 5, 15)]
    )
    row, meta = only(am.audit_open_interest(interest), "time_gaps")
    assert row["message"] == "1 gaps detected; max gap 10m vs expected 5m"


def test_funding_checks(metrics):
    rates = [("BTCUSDT", ts, 0.02) for ts in every(8, 20)] + [("ETHUSDT", START, float("nan"))]
    df = metrics("funding_rates", rates)
    names = {(r["check_name"], r["symbol"]): r["count"] for r in am.audit_funding_rates(df).collect()}
    assert names == {
        ("funding_rate_extremes", "BTCUSDT"): 20,
        ("funding_rate_distribution", "BTCUSDT"): 20,
        ("funding_rate_extremes", "ETHUSDT"): 1,
        ("invalid_values", "ETHUSDT"): 1,
    }


def test_zero_open_interest_is_invalid(metrics):
    df = metrics("open_interest", [("BTCUSDT", START, 0.0)])
    assert am.metric_value_errors(df, "open_interest", True).first()["bad_count"] == 1


# ---------------------------------------------------------------------------
# Universe
# ---------------------------------------------------------------------------
JAN, FEB, MAR = day("2024-01-01"), day("2024-02-01"), day("2024-03-01")


def test_missing_rank(ranking):
    df = ranking([(JAN, "BTC", 1, 9.0, "", 1), (JAN, "SOL", 3, 5.0, "", 3)])
    row = au.missing_ranks(df, AuditConfig(universe_top_n=3)).first()
    assert (row["bad_count"], row["affected_dates"], row["max_missing_rank"]) == (1, 1, 2)
    assert [tuple(s) for s in row["sample_missing_ranks"]] == [("2024-01-01", 2)]


def test_missing_ranks_stop_at_top_n(ranking):
    df = ranking([(JAN, "A", 1, 9.0, "", 1), (JAN, "B", 8, 5.0, "", 2)])
    slots = au.missing_rank_slots(df, AuditConfig(universe_top_n=4)).collect()
    assert sorted(r["rank"] for r in slots) == [2, 3, 4]


def test_missing_snapshot_and_bounds(ranking):
    df = ranking([(JAN, "BTC", 1, 9.0, "", 1), (MAR, "BTC", 1, 9.0, "", 1)])
    config = AuditConfig(universe_frequency="monthly")
    row = au.missing_snapshots(df, config).first()
    assert row["sample_missing_dates"] == [FEB]
    late = replace(config, universe_start_date="2024-05-01", universe_end_date="2024-04-01")
    assert au.missing_snapshots(df, late).count() == 0
    wide = replace(config, universe_end_date="2024-05-31")
    assert au.missing_snapshots(df, wide).first()["bad_count"] == 3


def test_universe_findings(ranking):
    rows = [
        (JAN, "BTC", 1, 5.0, "", 1), (JAN, "BTC", 1, 5.0, "", 1), (JAN, "ETH", 2, 7.0, "", 2),
        (JAN, "ETH", 9, -1.0, "", 7),
    ]
    got = found(au.audit_universe(ranking(rows), AuditConfig(universe_top_n=5)))
    counts = {key[:2]: row["count"] for key, row in got.items()}
    assert counts == {
        ("duplicate_primary_key", "BTC"): 1,
        ("duplicate_ranks", None): 1,
        ("duplicate_symbols", "BTC"): 1,
        ("duplicate_symbols", "ETH"): 1,
        ("invalid_values", "ETH"): 1,
        ("rank_above_top_n", None): 1,
        ("missing_ranks", None): 3,
        ("rank_market_cap_ordering", None): 1,
    }


def test_symbol_filter_skips_coverage(ranking):
    df = ranking([(JAN, "BTC", 1, 9.0, "", 1), (JAN, "SOL", 3, 5.0, "", 3)])
    assert au.audit_universe(df, AuditConfig(universe_top_n=3), ["BTC"]).count() == 0


def test_legacy_universe_key(spark):
    df = spark.createDataFrame(
        [(JAN, "BTC", 1, 9.0), (JAN, "BTC", 2, 8.0)], "date date, symbol string, rank int, market_cap double"
    )
    assert au.identity_columns(df) == ("date", "symbol")
    assert au.universe_duplicates(df).first()["bad_count"] == 1


# ---------------------------------------------------------------------------
# Reports and diagnostics
# ---------------------------------------------------------------------------
def test_audit_of_several_tables(spark, candles):
    df = candles([candle(START), candle(START + timedelta(hours=12))])
    report = audit(spark, {"spot": df}, ["spot", "futures"])
    assert {(r["table"], r["check_name"]) for r in report.collect()} == {
        ("spot", "time_gaps"),
        ("futures", "missing_table"),
    }
    lines = [r["line"] for r in fd.report_lines(report).collect()]
    assert lines[0] == "[ERROR] futures missing_table: Table 'futures' does not exist (count=1)"
    assert lines[1].startswith("[ERROR] spot BTCUSDT 4h time_gaps: 1 gaps detected")
    with pytest.raises(ValueError):
        audit(spark, {}, ["nothing"])


def test_severity_counts(spark, candles):
    report = ac.audit_candles(candles([candle(START + timedelta(hours=1))]))
    assert tuple(fd.severity_counts(report).first()) == (0, 1, True)
    assert tuple(fd.severity_counts(report, fail_on_warning=True).first()) == (0, 1, False)


def test_report_contract(spark):
    bad = fd.missing_table_finding(spark, "spot").withColumn("severity", F.lit("INFO"))
    assert fd.contract_breaks(bad).count() == 1
    assert fd.contract_breaks(fd.missing_table_finding(spark, "spot")).count() == 0


def test_diagnostics_sum_up_to_the_audit(spark, monkeypatch):
    """Flags of single rows, weighted by their copies, give the counts of the checks."""
    from tidemark.plans import views
    from tidemark.session import materialise

    monkeypatch.setattr(ordered, "SLICE_STEPS", 64)
    df = materialise(views.dirty_candles(spark, "/root/testdata/sf0.001"), "dirty")
    config = AuditConfig(price_return_sigma=3.0)
    rows = dg.candle_diagnostics(df, config)
    checks = (
        "time_gaps", "timestamp_alignment", "invalid_values", "invalid_ohlc",
        "volume_price_inconsistency", "price_return_outliers", "robust_price_jumps",
        "wick_outliers", "volume_outliers",
    )
    sums = rows.groupBy("symbol").agg(
        *[F.sum(F.when(F.col(c), F.col("copies")).otherwise(0)).alias(c) for c in checks],
        F.sum("copies").alias("rows"),
        F.count_distinct(F.when(F.col("stale_price_runs"), F.col("stale_start"))).alias("stale_price_runs"),
    )
    ours = {
        (c, r["symbol"]): r[c] for r in sums.collect() for c in (*checks, "stale_price_runs") if r[c]
    }
    report = ac.audit_candles(df, "spot", config).where("check_name <> 'duplicate_primary_key'")
    assert ours == {(r["check_name"], r["symbol"]): r["count"] for r in report.collect()}
    assert rows.agg(F.sum("copies")).first()[0] == df.count()


def test_hot_series_results_do_not_depend_on_slices(spark, candles, monkeypatch):
    rows = [candle(ts, close=100.0 + (i * 37) % 11, high=120.0) for i, ts in enumerate(every(4, 200)) if i % 9]
    df = candles(rows)
    results = []
    for steps in (4_096, 3):
        monkeypatch.setattr(ordered, "SLICE_STEPS", steps)
        results.append(
            Counter(map(tuple, ac.close_returns(df).collect()))
        )
    assert results[0] == results[1]
