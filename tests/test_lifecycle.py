"""Plans, completeness, upserts, validation, repair and rankings on constructed rows."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from conftest import START, candle, day, every
from pyspark.sql import functions as F

from tidemark import specs
from tidemark.operators import gaps as gp
from tidemark.operators import planning as pl
from tidemark.operators import reconcile as rc
from tidemark.operators import repair as rp
from tidemark.operators import resample as rs
from tidemark.operators import universe as un
from tidemark.operators import upsert as up
from tidemark.operators import validate as va

JAN, FEB, MAR = day("2024-01-01"), day("2024-02-01"), day("2024-03-01")


def bounds(spark, start, end):
    return spark.createDataFrame([(start, end)], "start date, end date")


# ---------------------------------------------------------------------------
# Plans
# ---------------------------------------------------------------------------
@pytest.mark.parametrize(
    ("frequency", "start", "end", "expected"),
    [
        ("monthly", "2024-01-15", "2024-03-02", ["2024-01-01", "2024-02-01", "2024-03-01"]),
        ("weekly", "2024-01-02", "2024-01-15", ["2024-01-08", "2024-01-15"]),
        ("daily", "2024-02-28", "2024-03-01", ["2024-02-28", "2024-02-29", "2024-03-01"]),
        ("daily", "2024-03-01", "2024-02-28", []),
        ("monthly", "2024-03-01", "2024-02-28", []),
    ],
)
def test_calendar(spark, frequency, start, end, expected):
    rows = pl.calendar(bounds(spark, day(start), day(end)), frequency).collect()
    assert sorted(str(r["date"]) for r in rows) == expected


def test_unknown_frequency(spark):
    with pytest.raises(ValueError):
        pl.calendar(bounds(spark, JAN, FEB), "hourly")


def test_candle_files_of_open_month(spark):
    plan = pl.candle_periods(bounds(spark, day("2024-03-20"), day("2024-05-30")), "2024-05-06")
    rows = {r["period"]: (r["is_monthly"], r["replace_existing"]) for r in plan.collect()}
    assert rows == {
        "2024-03": (True, False),
        "2024-04": (True, False),
        "2024-05-01": (False, False),
        "2024-05-02": (False, False),
        "2024-05-03": (False, True),
        "2024-05-04": (False, True),
        "2024-05-05": (False, True),
    }


def kline_status(spark, candles, times, interval="4h", period="2024-01-01"):
    asked = spark.createDataFrame(
        [("BTCUSDT", interval, period, False, False)],
        "symbol string, interval string, period string, is_monthly boolean, replace_existing boolean",
    )
    rows = candles([candle(ts, interval=interval) for ts in times])
    return pl.candle_period_status(asked, rows).first()["complete"]


def test_candle_period_completeness(spark, candles):
    full = every(4, 6, START + timedelta(hours=4))
    assert kline_status(spark, candles, full)
    assert not kline_status(spark, candles, full[:-1])
    assert not kline_status(spark, candles, full[1:])
    assert not kline_status(spark, candles, full[:2] + full[3:])
    assert not kline_status(spark, candles, [START])
    assert kline_status(spark, candles, [START + timedelta(days=31)], "1M", "2024-01")


def test_metric_period_completeness(spark, metrics):
    asked = spark.createDataFrame(
        [("BTCUSDT", None, "2024-01-01", False, False)],
        "symbol string, interval string, period string, is_monthly boolean, replace_existing boolean",
    )

    def complete(times):
        rows = metrics("funding_rates", [("BTCUSDT", ts, 0.0) for ts in times])
        return pl.metric_period_status(asked, rows, "funding_rates").first()["complete"]

    assert complete(every(8, 3))
    assert complete([START + timedelta(hours=8), START + timedelta(hours=16)])
    assert not complete([START])
    assert not complete([START, START + timedelta(hours=16)])
    assert not complete([START - timedelta(hours=8), START, START + timedelta(hours=8)])


@pytest.mark.parametrize(
    ("statuses", "threshold", "kept"),
    [
        ("nnsssnnn", 3, 5),
        ("nnsssnnf", 3, 8),
        ("snnsnnns", 3, 4),
        ("nnnnn", 2, 5),
        ("snnnn", 0, 5),
        ("snnfnn", 3, 6),
    ],
)
def test_end_of_life(spark, statuses, threshold, kept):
    names = {"s": "success", "n": "not_found", "f": "failed"}
    rows = [("A", f"2024-01-{i + 1:02d}", names[s]) for i, s in enumerate(statuses)]
    df = spark.createDataFrame(rows, "symbol string, period string, status string")
    assert pl.cut_after_end_of_life(df, threshold).count() == kept


def test_effective_symbols(spark):
    schema = "table string, symbol string, interval string, period string"
    asked = spark.createDataFrame(
        [("futures", s, "4h", "2024-01") for s in ("PEPEUSDT", "BTCUSDT", "1INCHUSDT")]
        + [("spot", "PEPEUSDT", "4h", "2024-01")],
        schema,
    )
    have = spark.createDataFrame(
        [(t, s, "4h", "2023-01") for t in ("futures", "spot")
         for s in ("1000PEPEUSDT", "BTCUSDT", "1000BTCUSDT", "10001INCHUSDT")],
        schema,
    )
    got = {(r["table"], r["symbol"]): r["effective_symbol"] for r in pl.effective_symbols(asked, have).collect()}
    assert got == {
        ("futures", "PEPEUSDT"): "1000PEPEUSDT",
        ("futures", "BTCUSDT"): "BTCUSDT",
        ("futures", "1INCHUSDT"): "1INCHUSDT",
        ("spot", "PEPEUSDT"): "PEPEUSDT",
    }


# ---------------------------------------------------------------------------
# Upserts and validation
# ---------------------------------------------------------------------------
def test_partial_overlap_and_idempotence(candles):
    times = every(4, 3)
    incoming = candles([candle(ts) for ts in times])
    assert up.new_rows(incoming, candles([candle(times[0])]), "spot").count() == 2
    assert up.new_rows(incoming, incoming, "spot").count() == 0


def test_replace_day_refreshes_and_keeps_neighbours(spark, candles):
    times = every(4, 18)
    stored = candles([candle(ts) for ts in times])
    fresh = candles([candle(ts, open=99.5) for ts in times[7:10]])
    days = spark.createDataFrame([("BTCUSDT", "4h", day("2024-01-02"))], "symbol string, interval string, day date")
    rows = {r["timestamp"]: r["open"] for r in up.replace_days(stored, fresh, days).collect()}
    # 04:00 of day two to midnight of day three belong to day two.
    assert [ts for ts in times if ts not in rows] == times[10:13]
    assert {ts for ts, o in rows.items() if o == 99.5} == set(times[7:10])


def test_keep_first_takes_line_order(spark):
    df = spark.createDataFrame(
        [("f", 1, 2, "b"), ("f", 1, 1, "a"), ("f", 2, 3, "c")], "file string, k int, line int, v string"
    )
    rows = {r["k"]: (r["v"], r[up.COPIES]) for r in up.keep_first(df, ["file", "k"], ["line"]).collect()}
    assert rows == {1: ("a", 2), 2: ("c", 1)}


def test_strict_and_lazy_validation(candles):
    good, bad = candle(START), candle(START + timedelta(hours=4), high=50.0, volume=-1.0)
    assert va.validate(candles([good]), "spot").count() == 1
    with pytest.raises(va.ContractError):
        va.validate(candles([good, bad]), "spot")
    rules = {(r["rule"], r["column"]) for r in va.validate(candles([good, bad]), "spot", strict=False).collect()}
    assert rules == {
        ("high_vs_low", "high"), ("high_vs_open", "high"), ("high_vs_close", "high"), ("minimum", "volume"),
    }


def test_columns_are_checked(candles):
    df = candles([candle(START)])
    with pytest.raises(va.ContractError, match="unknown column extra"):
        va.validate(df.withColumn("extra", F.lit(1)), "spot")
    with pytest.raises(va.ContractError, match="missing column close"):
        va.validate(df.drop("close"), "spot")
    assert va.validate(df.select(*reversed(df.columns)), "spot").count() == 1


@pytest.mark.parametrize(
    ("changes", "rule"),
    [
        ({"exchange": "kraken"}, "constant"),
        ({"symbol": "btcusdt"}, "pattern"),
        ({"symbol": "BT"}, "length"),
        ({"interval": "7m"}, "known"),
        ({"close": None}, "not_null"),
        ({"open": float("nan")}, "not_null"),
        ({"low": 0.0}, "positive"),
        ({"trades_count": -1}, "minimum"),
    ],
)
def test_candle_rules(candles, changes, rule):
    found = va.validate(candles([candle(START, **changes)]), "spot", strict=False)
    assert [r["rule"] for r in found.collect()] == [rule]


def test_metric_rules(metrics):
    interest = metrics("open_interest", [("BTCUSDT", START, float("inf")), ("BTCUSDT", START, 1.0)])
    assert sorted(r["rule"] for r in va.violations(interest, "open_interest").collect()) == ["finite", "unique"]
    funding = metrics("funding_rates", [("BTCUSDT", START, 5.0), ("ETHUSDT", START, None)])
    assert [r["rule"] for r in va.violations(funding, "funding_rates").collect()] == ["not_null"]


# ---------------------------------------------------------------------------
# Gaps and repair
# ---------------------------------------------------------------------------
def gap_case(candles, fetched, **changes):
    """Five closes, a hole of five, five closes; ``fetched`` of the five are in the source."""
    before = every(4, 5)
    after = every(4, 5, START + timedelta(hours=40))
    inside = every(4, 5, START + timedelta(hours=20))
    target = candles([candle(ts) for ts in before + after])
    source = candles([candle(ts, **changes) for ts in before + inside[:fetched] + after])
    return target, source


@pytest.mark.parametrize(
    ("fetched", "outcome", "missing"), [(5, "repaired", 0), (2, "partial_fill", 3), (0, "partial_fill", 5)]
)
def test_repair_outcomes(candles, fetched, outcome, missing):
    target, source = gap_case(candles, fetched)
    fixed = rp.repair(target, source, "spot")
    row = fixed.outcomes.first()
    assert (row["outcome"], row["missing_count"]) == (outcome, missing)
    assert fixed.rows.count() == fetched
    again = rp.repair(target.unionByName(fixed.rows), source, "spot")
    assert again.rows.count() == 0


def test_repair_rejects_a_gap_with_a_bad_row(candles):
    target, source = gap_case(candles, 5, high=1.0)
    fixed = rp.repair(target, source, "spot")
    assert fixed.outcomes.first()["outcome"] == "network_error"
    assert fixed.rows.count() == 0


def test_repair_keeps_off_grid_rows_of_the_source(candles):
    target, source = gap_case(candles, 2)
    odd = candles([candle(START + timedelta(hours=29))])
    fixed = rp.repair(target, source.unionByName(odd), "spot")
    assert fixed.rows.count() == 3 and fixed.outcomes.first()["missing_count"] == 3


def test_repair_guards(candles):
    odd = candles([candle(START + timedelta(seconds=7)), candle(START + timedelta(hours=12))])
    assert rp.with_guards(gp.candle_gaps(odd)).first()["off_grid"]
    wide = candles([candle(START), candle(START + timedelta(hours=4 * 1_002))])
    row = rp.with_guards(gp.candle_gaps(wide), specs.REPAIR_ROW_LIMITS).first()
    assert row["expected_missing"] == 1_001 and row["too_large"]
    futures = rp.with_guards(gp.candle_gaps(wide, "futures"), specs.REPAIR_ROW_LIMITS).first()
    assert not futures["too_large"]


def test_prefixed_rows_leave_the_gap_open(candles):
    target, source = gap_case(candles, 5)
    renamed = source.withColumn("symbol", F.concat(F.lit("1000"), "symbol"))
    fixed = rp.repair(target, renamed, "futures")
    assert {r["symbol"] for r in fixed.rows.collect()} == {"1000BTCUSDT"}
    assert fixed.outcomes.first()["outcome"] == "partial_fill"
    assert rp.repair(target, renamed, "spot").rows.count() == 0


def test_only_repairable_tables(metrics):
    with pytest.raises(ValueError):
        rp.table_gaps(metrics("open_interest", []), "open_interest")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_deleted_rows_are_found_and_restored(candles, seed):
    """Delete random rows: gap enumeration finds exactly them and repair restores them."""
    rng = random.Random(seed)
    times = every(4, 150)
    gone = set(rng.sample(times[1:-1], 40))
    full = candles([candle(ts, close=100.0 + i % 2) for i, ts in enumerate(times)])
    target = full.where(~F.col("timestamp").isin(sorted(gone)))
    missing = gp.missing_keys(gp.candle_gaps(target))
    assert {r["timestamp"] for r in missing.collect()} == gone
    fixed = rp.repair(target, full, "spot")
    assert {r["outcome"] for r in fixed.outcomes.collect()} == {"repaired"}
    whole = target.unionByName(fixed.rows)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, full.collect()))


def test_trailing_rows(candles):
    times = every(4, 60)
    source = candles([candle(ts) for ts in times])
    target = candles([candle(ts) for ts in times[:45]])
    fresh = rp.trailing_rows(source, target, "spot", days=3)
    assert {r["timestamp"] for r in fresh.collect()} == set(times[45:])
    assert rp.trailing_rows(source, target.unionByName(fresh), "spot").count() == 0


# ---------------------------------------------------------------------------
# Resampling, rankings, reconciliation
# ---------------------------------------------------------------------------
def test_resample_boundary_belongs_to_its_bucket(candles):
    rows = [
        candle(START + timedelta(hours=h), interval="1h", open=float(h), close=h + 0.5, high=50.0 + h)
        for h in range(1, 9)
    ]
    got = {r["timestamp"]: r for r in rs.resample(candles(rows), "4h", rows[0][2]).collect()}
    first = got[START + timedelta(hours=4)]
    assert sorted(got) == [START + timedelta(hours=4), START + timedelta(hours=8)]
    assert (first["open"], first["close"], first["high"], first["volume"]) == (1.0, 4.5, 54.0, 400.0)


def test_week_closes_on_monday(candles):
    df = candles([candle(datetime(2024, 1, 8), interval="1d"), candle(datetime(2024, 1, 9), interval="1d")])
    closes = sorted(r["timestamp"] for r in rs.resample(df, "1w", df.first()["interval"]).collect())
    assert closes == [datetime(2024, 1, 8), datetime(2024, 1, 15)]


def test_superset_drops_a_symbol_tagged_once(ranking):
    df = ranking(
        [
            (JAN, "BTC", 1, 9.0, "pow", 1), (JAN, "USDT", 2, 8.0, "payments, Stablecoin", 2),
            (FEB, "USDT", 2, 8.0, None, 2), (FEB, "SOL", 3, 7.0, "stablecoin-protocol", 3),
            (FEB, "DOGE", 4, 6.0, "", 4), (MAR, "ADA", 1, 6.0, "", 5),
        ]
    )
    rows = un.symbol_superset(df, "2024-01-01", "2024-02-29", 3).collect()
    assert [r["symbol"] for r in rows] == ["BTCUSDT", "SOLUSDT"]


def test_no_look_ahead(ranking, candles):
    """A snapshot dated the trading day itself is not used that day."""
    universe = ranking([(JAN, "BTC", 1, 9.0, "", 1), (day("2024-01-03"), "BTC", 2, 8.0, "", 1)])
    closes = [datetime(2024, 1, d) for d in (2, 3, 4, 5)]
    joined = un.join_latest_snapshot(universe, candles([candle(ts, interval="1d") for ts in closes]))
    used = {r["day"]: r["rank"] for r in joined.collect()}
    assert used == {date(2024, 1, 2): 1, date(2024, 1, 3): 1, date(2024, 1, 4): 2}


def test_month_join_uses_the_month_just_closed(ranking, candles):
    universe = ranking([(JAN, "BTC", 1, 9.0, "", 1), (FEB, "BTC", 2, 8.0, "", 1)])
    df = candles([candle(datetime(2024, 2, 1)), candle(datetime(2024, 2, 1, 4))])
    got = {r["timestamp"]: r["rank"] for r in un.join_month_snapshot(universe, df).collect()}
    assert got == {datetime(2024, 2, 1): 1, datetime(2024, 2, 1, 4): 2}


def test_renames_keep_assets_apart(ranking):
    df = ranking(
        [(JAN, "MATIC", 10, 9.0, "", 1), (FEB, "POL", 10, 9.0, "", 1), (FEB, "MATIC", 99, 1.0, "", 2)]
    )
    rows = [(r["provider_id"], r["old_symbol"], r["new_symbol"]) for r in un.renames(df).collect()]
    assert rows == [(1, "MATIC", "POL")]


def test_snapshot_build(spark, ranking):
    listings = ranking(
        [
            (JAN, "BTC", 1, 9.0, "", 1), (JAN, "BTC", 2, 9.5, "", 1), (JAN, "USDT", 3, 8.0, "stablecoin", 2),
            (JAN, "FTT", 4, 1.0, "", 3), (FEB, "ETH", 2, 9.0, "", 4), (FEB, "SOL", 2, 8.0, "", 5),
        ]
    )
    dates = spark.createDataFrame([(JAN,), (FEB,), (MAR,)], "date date")
    build = un.build_snapshots(listings, dates, None, ["ftt"])
    assert [(r["symbol"], r["rank"]) for r in build.rows.collect()] == [("BTC", 1)]
    assert {tuple(r) for r in build.excluded.collect()} == {("tag", "USDT"), ("symbol", "FTT")}
    assert {tuple(r) for r in build.failed_dates.collect()} == {
        (FEB, "validation_failed"), (MAR, "no_listings"),
    }


def test_digests_leave_only_the_differing_days_to_compare(candles):
    times = every(4, 60)
    rows = [candle(t, symbol) for t in times for symbol in ("BTCUSDT", "ETHUSDT")]
    twice = rows + [rows[3]]
    changed = [candle(t, "BTCUSDT", close=99.5) if (t, s) == (times[20], "BTCUSDT") else candle(t, s) for t in times for s in ("BTCUSDT", "ETHUSDT")]
    days = ["symbol", "_day"]
    fields = ["symbol", "timestamp", *rc.CANDLE_TOLERANCES]
    stored, source = (candles(x).withColumn("_day", F.to_date("timestamp")) for x in (rows, changed))
    parts = rc.differing_parts(stored, source, days, fields).collect()
    assert [tuple(p) for p in parts] == [("BTCUSDT", times[20].date())]
    keys = ["exchange", "symbol", "interval", "timestamp"]
    found = rc.reconcile_by_day(candles(rows), candles(changed), keys, rc.CANDLE_TOLERANCES).collect()
    assert [(r["symbol"], r["timestamp"], r["field"]) for r in found] == [("BTCUSDT", times[20], "close")]
    assert rc.reconcile_by_day(candles(rows), candles(list(reversed(rows))), keys, rc.CANDLE_TOLERANCES).count() == 0
    assert rc.differing_parts(candles(twice), candles(rows), ["symbol"], fields).count() == 1


def test_reconciling_by_day_finds_what_a_full_comparison_finds(candles):
    times = every(4, 40)
    rows = [candle(t, s, close=None if i % 11 == 0 else 100.0 + i) for i, t in enumerate(times) for s in ("BTCUSDT", "ETHUSDT")]
    other = [candle(t, s, close=100.0 + i + (i % 7 == 0), volume=100.0 + (i % 5 == 0) * 1e-9) for i, t in enumerate(times[3:], 3) for s in ("BTCUSDT", "XRPUSDT")]
    keys = ["exchange", "symbol", "interval", "timestamp"]
    full = rc.reconcile(candles(rows), candles(other), keys, rc.CANDLE_TOLERANCES).collect()
    by_day = rc.reconcile_by_day(candles(rows), candles(other), keys, rc.CANDLE_TOLERANCES).collect()
    assert sorted(map(str, by_day)) == sorted(map(str, full)) and len(full) > 80


def test_reconcile_skips_missing_values(candles):
    stored = candles([candle(START, trades_count=None, volume=100.005), candle(START + timedelta(hours=4))])
    source = candles([candle(START, close=100.6), candle(START + timedelta(hours=8))])
    keys = ["exchange", "symbol", "interval", "timestamp"]
    found = rc.reconcile(stored, source, keys, rc.CANDLE_TOLERANCES)
    assert {(r["timestamp"].hour, r["field"], r["kind"]) for r in found.collect()} == {
        (0, "close", "mismatch"), (4, "row", "missing_in_source"), (8, "row", "missing_in_stored"),
    }


def test_stratified_sample(candles):
    rows = [candle(ts, symbol=s) for s, n in (("AAAUSDT", 100), ("BBBUSDT", 40), ("CCCUSDT", 3)) for ts in every(4, n)]
    df = candles(rows)
    sample = rc.stratified_rows(df, 0.2, 12, seed=4)
    counts = {r["symbol"]: r["count"] for r in sample.groupBy("symbol").count().collect()}
    # A budget of 28 over three symbols; the smallest has only three rows to give.
    assert counts["CCCUSDT"] == 3 and sorted(counts.values())[1:] in ([9, 9], [9, 10])
    assert sample.distinct().count() == sample.count()
    assert sorted(map(tuple, sample.collect())) == sorted(map(tuple, rc.stratified_rows(df, 0.2, 12, seed=4).collect()))
    assert rc.stratified_rows(df, 0.2, 2).select("symbol").distinct().count() == 2
    with pytest.raises(ValueError):
        rc.stratified_rows(df, 0.0, 2)
