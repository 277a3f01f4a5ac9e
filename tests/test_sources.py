"""Files: zipped and plain archives, payloads, stores, reports, warehouse builds, streams."""

from __future__ import annotations

import io
import json
import tempfile
import zipfile
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from conftest import START, candle, day, every
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark import specs
from tidemark.operators import normalize as nz
from tidemark.operators import upsert as up
from tidemark.operators.validate import ContractError
from tidemark.plans import warehouse as wh
from tidemark.sources import archives, payloads, reports, tables
from tidemark.streaming.ingest import ingest_new_archives

HEADER = "open_time,open,high,low,close,volume,close_time,quote_volume,count,taker_buy_volume,taker_buy_quote_volume,ignore"


@pytest.fixture
def folder():
    return Path(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))


def line(close, unit=1_000, price=100.5):
    """A raw candle line closing one millisecond before ``close``."""
    end = int((close - datetime(1970, 1, 1)).total_seconds() * 1_000) - 1
    end = end * (unit // 1_000)
    return f"{end - 299_999},100.0,101.0,99.0,{price},12.5,{end},1250.0,42,6.0,600.0,0"


def zipped(path, text, member=None):
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w") as archive:
        archive.writestr("readme.txt", "nothing")
        archive.writestr(member or path.with_suffix(".csv").name, text)
    return str(path)


def stamps(df):
    return sorted(r["timestamp"] for r in df.collect())


def test_zipped_candles_without_header(spark, folder):
    closes = [START + timedelta(minutes=5 * i) for i in (1, 2, 3)]
    text = "\n".join([line(c) for c in closes] + [line(closes[0], price=77.0)])
    path = zipped(folder / "BTCUSDT-5m-2024-01.zip", text)
    done = nz.normalise(archives.read_zipped(spark, path, "spot"), "spot")
    rows = done.rows.orderBy("timestamp").collect()
    assert [r["timestamp"] for r in rows] == closes
    assert (rows[0]["symbol"], rows[0]["interval"], rows[0]["period"]) == ("BTCUSDT", "5m", "2024-01")
    # The first of the copied lines is the one that stays.
    assert rows[0]["close"] == 100.5 and rows[0]["trades_count"] == 42
    anomaly = done.anomalies.first()
    assert (anomaly["check_name"], anomaly["count"]) == ("import_dropped_duplicate_rows", 1)


def test_microseconds_decide_for_the_whole_file(spark, folder):
    closes = [START + timedelta(minutes=5 * i) for i in (1, 2)]
    text = "\n".join(line(c, unit=1_000_000) for c in closes)
    path = zipped(folder / "BTCUSDT-5m-2024-01-01.zip", text)
    assert stamps(nz.normalise(archives.read_zipped(spark, path, "futures"), "futures").rows) == closes


def test_header_and_missing_takers(spark, folder):
    names = HEADER.upper().replace("COUNT", "Count")
    path = zipped(folder / "BTCUSDT-5m-2024-01.zip", names + "\n" + line(START))
    row = nz.normalise(archives.read_zipped(spark, path, "spot"), "spot").rows.first()
    assert row["trades_count"] == 42
    # The header names the taker base column differently, so it is absent.
    assert row["taker_buy_base_volume"] is None and row["taker_buy_quote_volume"] == 600.0


def test_missing_column_rejects_the_file(spark, folder):
    path = zipped(folder / "BTCUSDT-5m-2024-01.zip", "open_time,open,close_time\n1,2,3")
    done = nz.normalise(archives.read_zipped(spark, path, "spot"), "spot")
    assert set(done.rejected.first()["missing_columns"]) == {"high", "low", "close", "volume"}
    assert done.rows.count() == 0


def test_archives_without_csv_are_rejected_and_the_others_read(spark, folder):
    zipped(folder / "BTCUSDT-5m-2024-01.zip", "x", member="data.txt")
    (folder / "ETHUSDT-5m-2024-01.zip").write_bytes(b"no archive")
    zipped(folder / "SOLUSDT-5m-2024-01.zip", line(START + timedelta(minutes=5)))
    for table in ("spot", "open_interest"):
        done = nz.normalise(archives.read_zipped(spark, str(folder), "spot"), table)
        reasons = {r["file"].rsplit("/", 1)[1][:3]: r["reason"] for r in done.rejected.collect()}
        assert reasons["BTC"] == reasons["ETH"] == "no CSV lines"
    assert nz.normalise(archives.read_zipped(spark, str(folder), "spot"), "spot").rows.count() == 1


def test_damaged_archives_are_rejected_and_the_others_read(spark, folder):
    closes = [START + timedelta(minutes=5 * i) for i in range(1, 2_000)]
    text = "\n".join(line(c) for c in closes)
    damaged = Path(zipped(folder / "AUSDT-5m-2024-01.zip", text))
    with zipfile.ZipFile(damaged, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("AUSDT-5m-2024-01.csv", text)
    content = bytearray(damaged.read_bytes())
    content[len(content) // 2] ^= 0xFF
    damaged.write_bytes(content)
    zipped(folder / "BUSDT-5m-2024-01.zip", (text + "\n").encode() + b"\xff\xfe broken")
    zipped(folder / "CUSDT-5m-2024-01.zip", "")
    (folder / "DUSDT-5m-2024-01.zip").write_bytes(Path(zipped(folder / "x" / "D.zip", text)).read_bytes()[:-40])
    zipped(folder / "EUSDT-5m-2024-01.zip", text)
    done = nz.normalise(archives.read_zipped(spark, str(folder / "*.zip"), "spot"), "spot")
    reasons = {r["file"].rsplit("/", 1)[1][0]: r["reason"] for r in done.rejected.collect()}
    assert reasons == dict.fromkeys("ABCD", "no CSV lines")
    assert {r["symbol"] for r in done.rows.collect()} == {"EUSDT"} and done.rows.count() == len(closes)


def test_a_stream_goes_on_past_damaged_archives(spark, folder):
    closes = [START + timedelta(minutes=5 * i) for i in range(1, 4)]
    zipped(folder / "in" / "AUSDT-5m-2024-01.zip", b"1,2,\xff")
    zipped(folder / "in" / "BUSDT-5m-2024-01.zip", "\n".join(map(line, closes)))
    query = ingest_new_archives(spark, str(folder / "in"), str(folder / "db"), "spot", str(folder / "state"))
    query.awaitTermination()
    assert query.exception() is None
    assert {r["symbol"] for r in tables.read_table(spark, str(folder / "db"), "spot").collect()} == {"BUSDT"}


def test_findings_are_lines_or_one_array_and_nothing_else(spark, folder):
    record = '{"severity": "WARN", "table": "spot", "check_name": "c", "message": "m", "count": 2}'
    for name, text in (("lines", f"{record}\n{record}"), ("array", f"[{record},\n{record}]")):
        (folder / name).mkdir()
        (folder / name / "part.json").write_text(text)
        assert [r["count"] for r in reports.read_findings(spark, str(folder / name)).collect()] == [2, 2]
    (folder / "broken").mkdir()
    (folder / "broken" / "part.json").write_text(record + "\n{broken")
    with pytest.raises((PySparkException, Py4JJavaError)):
        reports.read_findings(spark, str(folder / "broken")).collect()


def test_plain_files_keep_line_order(spark, folder):
    closes = [START + timedelta(minutes=5 * (i % 50)) for i in range(200)]
    file = folder / "BTCUSDT-5m-2024-01.csv"
    file.write_text("\n".join(line(c, price=100.0 + i * 0.001) for i, c in enumerate(closes)))
    rows = nz.normalise(archives.read_plain(spark, str(file), "spot"), "spot").rows.collect()
    assert len(rows) == 50
    assert max(r["close"] for r in rows) == pytest.approx(100.049)


def test_open_interest_files(spark, folder):
    head = "create_time,symbol,sum_open_interest\n"
    zipped(folder / "AUSDT-metrics-2024-01-01.zip", head + "2024-01-01 00:00:00,A,5.0\n2024-01-01 00:05:00,A,0\n")
    zipped(folder / "BUSDT-metrics-2024-01-01.zip", head + "1704067200123,B,7.0\n1704067200123,B,8.0\n")
    zipped(folder / "CUSDT-metrics-2024-01-01.zip", head + "1704067200123456,C,9.0\n")
    done = nz.normalise(
        archives.read_zipped(spark, str(folder / "*.zip"), "open_interest"), "open_interest"
    )
    got = {r["symbol"]: (r["timestamp"], r["open_interest"]) for r in done.rows.collect()}
    assert got == {
        "AUSDT": (datetime(2024, 1, 1), 5.0),
        "BUSDT": (datetime(2024, 1, 1, 0, 0, 0, 123_000), 7.0),
        "CUSDT": (datetime(2024, 1, 1, 0, 0, 0, 123_456), 9.0),
    }
    anomalies = {(r["symbol"], r["check_name"]): r["count"] for r in done.anomalies.collect()}
    assert anomalies == {
        ("AUSDT", "import_dropped_zero_open_interest_rows"): 1,
        ("BUSDT", "import_dropped_duplicate_rows"): 1,
    }


def test_empty_after_window(spark, folder):
    path = zipped(folder / "BTCUSDT-5m-2024-01.zip", line(START))
    lines = archives.read_zipped(spark, path, "spot")
    low, high = up.close_window(F.lit("2024-01-01").cast("date"), F.lit("2024-01-31").cast("date"))
    windows = lines.select("file").distinct().select("file", low.alias("window_start"), high.alias("window_end"))
    done = nz.normalise(lines, "spot", windows)
    # A close at midnight belongs to the day before.
    assert done.rows.count() == 0
    assert [r["check_name"] for r in done.anomalies.collect()] == ["import_empty_after_parse"]


def test_payload_files(spark, folder):
    ms = 1_704_067_499_999
    item = [ms - 299_999, "1", "2", "0.5", "1.5", "10", ms, "15", 7, "5", "7.5", "0"]
    (folder / "BTCUSDT-5m-a.json").write_text(json.dumps([item, item]))
    (folder / "ETHUSDT-5m-b.json").write_text("[]")
    row = payloads.read_candle_payloads(spark, str(folder / "*-5m-*.json")).collect()
    assert [(r["symbol"], r["interval"], r["timestamp"], r["close"]) for r in row] == [
        ("BTCUSDT", "5m", datetime(2024, 1, 1, 0, 5), 1.5)
    ]
    (folder / "BTCUSDT.json").write_text(json.dumps([{"fundingTime": ms, "fundingRate": "-0.0001"}]))
    row = payloads.read_funding_payloads(spark, str(folder / "BTCUSDT.json")).first()
    assert row["timestamp"] == datetime(2024, 1, 1, 0, 4, 59, 999_000) and row["funding_rate"] == -0.0001


def listing(pid, symbol, rank, tags=(), **more):
    coin = {
        "id": pid, "name": symbol.title(), "symbol": symbol, "slug": symbol.lower(), "cmcRank": rank,
        "circulatingSupply": 10.0, "dateAdded": "2013-04-28T00:00:00.000Z", "tags": list(tags),
        "platform": None, "quotes": [{"marketCap": 100.0 / rank, "fullyDilutedMarketCap": 1.0}],
    }
    return coin | more


def test_listing_files(spark, folder):
    coins = [
        listing(1, "btc", 1, ["mineable", "pow"]),
        listing(2, "eth", 2, platform={"name": "Chain", "id": 3}, quotes=[], dateAdded="soon", tags=[]),
    ]
    (folder / "2024-01-01.json").write_text(json.dumps({"data": coins}))
    rows = {r["symbol"]: r for r in payloads.read_listings(spark, str(folder / "*.json")).collect()}
    assert rows["BTC"]["tags"] == "mineable,pow" and rows["BTC"]["date"] == day("2024-01-01")
    assert rows["BTC"]["date_added"] == day("2013-04-28") and rows["BTC"]["platform"] is None
    eth = rows["ETH"]
    assert (eth["platform"], eth["market_cap"], eth["date_added"], eth["tags"]) == ("Chain", None, None, "")


# ---------------------------------------------------------------------------
# Stores
# ---------------------------------------------------------------------------
def test_store_inserts_once_and_replaces_days(spark, folder, candles):
    root = str(folder)
    rows = candles([candle(ts) for ts in every(4, 12, START + timedelta(hours=4))])
    assert tables.insert_new(spark, root, "spot", rows.limit(5)) == 5
    assert tables.insert_new(spark, root, "spot", rows) == 7
    assert tables.insert_new(spark, root, "spot", rows) == 0
    day_two = rows.where(up.close_day("timestamp") == F.lit("2024-01-02").cast("date"))
    changed = day_two.withColumn("open", F.lit(99.5))
    days = day_two.select("symbol", "interval", up.close_day("timestamp").alias("day"))
    tables.replace_days(spark, root, "spot", changed, days)
    stored = tables.read_table(spark, root, "spot")
    assert stored.count() == 12 and stored.where("open = 99.5").count() == 6
    assert tables.register_views(spark, root) == ["spot"]
    counted = spark.sql("SELECT symbol, count(*) AS n FROM spot WHERE interval = '4h' GROUP BY symbol")
    assert [tuple(r) for r in counted.collect()] == [("BTCUSDT", 12)]
    scanned = tables.read_table(spark, root, "spot", ["BTCUSDT"], ["4h"])
    plan = scanned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(interval" in plan and "EqualTo(symbol,BTCUSDT)" in plan


def two_symbols(candles):
    january = [candle(ts, "AAAUSDT", "1h") for ts in every(1, 23, START + timedelta(days=30, hours=1))]
    february = [candle(ts, "BBBUSDT", "1h") for ts in every(1, 19, START + timedelta(days=40))]
    return candles(january + february)


def test_a_stray_row_keeps_the_other_rows_of_its_month(spark, folder, candles):
    root = str(folder)
    assert tables.insert_new(spark, root, "spot", two_symbols(candles)) == 42
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        stray = candles([candle(START + timedelta(days=31, hours=1), "AAAUSDT", "1h")])
        days = spark.createDataFrame([("AAAUSDT", "1h", day("2024-01-31"))], "symbol string, interval string, day date")
        tables.replace_days(spark, root, "spot", stray, days)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    stored = tables.read_table(spark, root, "spot")
    assert stored.where("symbol = 'BBBUSDT'").count() == 19
    assert stored.where("symbol = 'AAAUSDT'").count() == 1


def test_writes_enforce_keys_and_rules(spark, folder, candles, ranking):
    root = str(folder)
    rows = two_symbols(candles)
    tables.insert_new(spark, root, "spot", rows)
    days = spark.createDataFrame([("AAAUSDT", "1h", day("2024-01-31"))], "symbol string, interval string, day date")
    fresh = rows.where("symbol = 'AAAUSDT'")
    for bad in (
        fresh.unionByName(fresh.limit(1)),
        fresh.unionByName(rows.where("symbol = 'BBBUSDT'").limit(1)),
        fresh.withColumn("close", F.lit(-1.0)),
        fresh.withColumn("volume", F.lit("many")),
        fresh.drop("open"),
    ):
        with pytest.raises(ContractError):
            tables.replace_days(spark, root, "spot", bad, days)
    with pytest.raises(ContractError):
        tables.insert_new(spark, root, "spot", candles([candle(START, open=None)]))
    assert tables.read_table(spark, root, "spot").count() == 42
    jan = day("2024-01-01")
    with pytest.raises(ContractError):
        twice = ranking([(jan, "BTC", 1, 9.0, "", 1), (jan, "ETH", 1, 8.0, "", 2)])
        tables.replace_dates(spark, root, twice, spark.createDataFrame([(jan,)], "date date"))


def test_replacing_a_date_with_nothing_empties_it(spark, folder, ranking):
    root = str(folder)
    jan, feb = day("2024-01-01"), day("2025-02-01")
    tables.replace_dates(
        spark,
        root,
        ranking([(jan, "BTC", 1, 9.0, "", 1), (feb, "BTC", 1, 9.0, "", 1)]),
        spark.createDataFrame([(jan,), (feb,)], "date date"),
    )
    tables.replace_dates(spark, root, ranking([]), spark.createDataFrame([(feb,)], "date date"))
    left = tables.read_table(spark, root, "crypto_universe").collect()
    assert [r["date"] for r in left] == [jan]


def test_first_write_checks_the_contract(spark, folder, candles):
    with pytest.raises(ContractError):
        tables.create_table(candles([candle(START, low=-1.0)]), str(folder), "spot")
    tables.create_table(candles([candle(START)]), str(folder), "spot")
    assert tables.read_table(spark, str(folder), "spot").count() == 1


def test_anomaly_lines(spark, folder):
    path = folder / "lines.jsonl"
    path.write_text(
        '{"table": "spot", "symbol": "A", "interval": "5m", "check_name": "x", "count": 3}\n\n'
        '{"table_name": "futures", "symbol": "B", "count": 2, "metadata": {"k": "v"}}\n'
    )
    rows = reports.anomaly_findings(spark, str(path)).orderBy("symbol").collect()
    assert [(r["table"], r["check_name"], r["count"], r["severity"]) for r in rows] == [
        ("spot", "x", 3, "WARN"), ("futures", "import_anomaly", 2, "WARN"),
    ]
    assert json.loads(rows[1]["metadata"])["k"] == "v"
    assert rows[0]["message"] == "3 rows were handled during import before database insert"
    assert reports.anomaly_findings(spark, str(path), tables=["spot"], symbols=["B"]).count() == 0
    path.write_text("{broken\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        reports.anomaly_findings(spark, str(path)).collect()


# ---------------------------------------------------------------------------
# Warehouse
# ---------------------------------------------------------------------------
def five_minutes(start, n):
    return [start + timedelta(minutes=5 * (i + 1)) for i in range(n)]


def test_ingest_is_all_or_nothing_per_file(spark, folder):
    good = "\n".join(line(c) for c in five_minutes(START, 3))
    bad = "\n".join([line(START + timedelta(hours=9)), line(START + timedelta(hours=10), price=-5.0)])
    zipped(folder / "in" / "AUSDT-5m-2024-01.zip", good)
    zipped(folder / "in" / "BUSDT-5m-2024-01.zip", bad)
    lines = archives.read_zipped(spark, str(folder / "in"), "spot")
    root = str(folder / "db")
    with pytest.raises(ContractError):
        wh.ingest_lines(spark, root, "spot", lines)
    assert not tables.table_exists(spark, root, "spot")
    summary = wh.ingest_lines(spark, root, "spot", lines, strict=False)
    assert summary.rejected_files == 1 and summary.inserted == {"spot": 3}
    assert {r["symbol"] for r in tables.read_table(spark, root, "spot").collect()} == {"AUSDT"}


def test_daily_files_replace_their_day(spark, folder):
    root = str(folder / "db")
    month = "\n".join(line(c) for c in five_minutes(START, 600))
    wh.ingest_lines(
        spark, root, "spot",
        archives.read_zipped(spark, zipped(folder / "a" / "AUSDT-5m-2024-01.zip", month), "spot"),
    )
    second = "\n".join(line(c, price=100.75) for c in five_minutes(START + timedelta(days=1), 2))
    summary = wh.ingest_lines(
        spark, root, "spot",
        archives.read_zipped(spark, zipped(folder / "b" / "AUSDT-5m-2024-01-02.zip", second), "spot"),
    )
    assert summary.replaced_days == 1
    stored = tables.read_table(spark, root, "spot")
    assert stored.count() == 600 - 288 + 2 and stored.where("close = 100.75").count() == 2


def test_build_warehouse(spark, folder):
    coins = [listing(1, "AAA", 1), listing(2, "USDX", 2, ["stablecoin"]), listing(3, "BBB", 3)]
    (folder / "lists").mkdir()
    (folder / "lists" / "2024-01-01.json").write_text(json.dumps({"data": coins}))
    closes = five_minutes(START, 12)
    holed = [c for i, c in enumerate(closes) if i not in (5, 6)]
    for symbol in ("AAAUSDT", "USDXUSDT", "ZZZUSDT"):
        zipped(folder / "files" / f"{symbol}-5m-2024-01.zip", "\n".join(map(line, holed)))
    lines = archives.read_zipped(spark, str(folder / "files"), "spot")
    backfill = nz.normalise(
        archives.read_zipped(
            spark, zipped(folder / "full" / "AAAUSDT-5m-2024-01.zip", "\n".join(map(line, closes))), "spot"
        ),
        "spot",
    ).rows.select(*specs.CANDLE_SCHEMA.fieldNames())
    root = str(folder / "db")
    dates = spark.createDataFrame([(day("2024-01-01"),)], "date date")
    listings = payloads.read_listings(spark, str(folder / "lists" / "*.json"))
    made = wh.build_warehouse(
        spark, root, listings, dates, {"spot": str(folder / "files")}, "2024-01-01", "2024-01-31", 10, {"spot": backfill}
    )
    assert made.symbols == 2 and made.periods == {"spot": {"success": 1, "not_found": 1}}
    assert made.ingests["spot"].inserted == {"spot": 10} and made.pruned == {"spot": 0}
    # Again: nothing is pruned or inserted twice, and a narrower range prunes what is outside.
    again = wh.build_warehouse(spark, root, listings, dates, {"spot": lines}, "2024-01-01", "2024-01-31", 10)
    assert sum(again.ingests["spot"].inserted.values()) == 0
    assert tables.prune(
        spark, root, "spot", spark.createDataFrame([("ZZZUSDT",)], "symbol string"), ["5m"],
        F.lit(closes[3]).cast("timestamp_ntz"), F.lit(closes[8]).cast("timestamp_ntz"),
    ) == 0
    stored = tables.read_table(spark, root, "spot")
    assert stamps(stored) == closes and {r["symbol"] for r in stored.collect()} == {"AAAUSDT"}
    # Stored dates are not fetched again, and a date that cannot be built is an error.
    assert wh.refresh_universe(spark, root, listings, dates) is None
    other = spark.createDataFrame([(day("2024-02-01"),)], "date date")
    with pytest.raises(RuntimeError):
        wh.refresh_universe(spark, root, listings, other)


def test_stream_ingests_new_files_once(spark, folder):
    root, state, arriving = str(folder / "db"), str(folder / "state"), folder / "in"

    def run():
        ingest_new_archives(spark, str(arriving), root, "spot", state).awaitTermination()
        return tables.read_table(spark, root, "spot").count()

    zipped(arriving / "AUSDT-5m-2024-01.zip", "\n".join(map(line, five_minutes(START, 10))))
    assert run() == 10
    assert run() == 10
    later = five_minutes(START + timedelta(minutes=25), 10)
    zipped(arriving / "AUSDT-5m-2024-02.zip", "\n".join(map(line, later)))
    assert run() == 15


def test_zip_member_is_read_in_batches(monkeypatch):
    import pandas as pd

    monkeypatch.setattr(archives, "BATCH_LINES", 7)
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        archive.writestr("a.csv", "".join(f"{i}\r\n" for i in range(20)))
    batch = pd.DataFrame({"path": ["p"], "content": [buffer.getvalue()]})
    parts = list(archives.unzip_lines(iter([batch])))
    assert [len(p) for p in parts] == [7, 7, 6]
    whole = pd.concat(parts)
    assert list(whole["line_no"]) == list(range(20)) and list(whole["line"]) == [str(i) for i in range(20)]


def test_a_cluster_session_without_shared_folder_is_refused(spark, monkeypatch):
    from tidemark import session

    class Settings:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Settings()

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Settings(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())
    stored = session.materialise(spark.range(3), "three")
    assert stored.count() == 3 and Path(stored._stored_at.removeprefix("file:")).exists()
    session.discard(stored)
    assert not Path(stored._stored_at.removeprefix("file:")).exists()
