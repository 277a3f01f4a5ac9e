"""Queries over the life of stored data: raw lines, plans, completeness, upserts, stores, streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import specs
from tidemark.functions.scalars import epoch_micros, epoch_seconds, interval_label
from tidemark.operators import coverage
from tidemark.operators import findings as fd
from tidemark.operators import normalize as nz
from tidemark.operators import planning as pl
from tidemark.operators import universe as un
from tidemark.operators import upsert as up
from tidemark.operators import validate as va
from tidemark.operators.audit_metrics import audit_funding_rates
from tidemark.plans import views, warehouse
from tidemark.plans.market_queries import IS_TAGGED
from tidemark.plans.query import Registry, rounded
from tidemark.plans.view_sql import with_views
from tidemark.session import materialise, scratch_path
from tidemark.sources import archives, reports, tables
from tidemark.streaming import ingest as stream
from tidemark.streaming.candles import open_candles, run_to_table, store_updates, streaming_candles

REGISTRY = Registry()
add = REGISTRY.add

_CANDLE_KEYS = ["symbol", "timestamp"]


def _hour():
    return (epoch_seconds("timestamp") / 3_600).cast("bigint")


# ---------------------------------------------------------------------------
# Raw lines. Files are made by Spark from the candle views: one per symbol and day, with and
# without header, in milliseconds or microseconds, with copies of lines.
# ---------------------------------------------------------------------------
def candle_lines(spark, folder):
    """Archive lines: CLICK files have a header with ``count`` and no taker columns, VIEW files
    are in microseconds, ERROR files lack the close column; each 23rd line is there twice."""
    rows = views.hourly_candles(spark, folder)
    close_ms = F.floor(epoch_micros("timestamp") / 1_000).cast("bigint") - 1
    close_time = F.when(F.col("symbol") == "VIEWUSDT", close_ms * 1_000).otherwise(close_ms)
    day = F.date_format(F.col("timestamp") - F.expr("interval 1 second"), "yyyy-MM-dd")
    file = F.concat("symbol", F.lit("-1h-"), day, F.lit(".csv"))
    text = [F.col(c).cast("string") for c in ("open", "high", "low", "close", "volume")]
    tail = [close_time.cast("string"), F.col("quote_volume").cast("string"), F.col("trades_count").cast("string")]
    takers = [F.col("taker_buy_base_volume").cast("string"), F.col("taker_buy_quote_volume").cast("string")]
    opened = (close_time - 3_599_999).cast("string")
    full = F.concat_ws(",", opened, *text, *tail, *takers, F.lit("0"))
    short = F.concat_ws(",", opened, *text, *tail)
    broken = F.concat_ws(",", opened, *text[:3], text[4], *tail)
    headed = F.col("symbol").isin("CLICKUSDT", "ERRORUSDT")
    body = rows.select(
        file.alias("file"),
        _hour().alias("hour"),
        F.when(F.col("symbol") == "CLICKUSDT", short)
        .when(F.col("symbol") == "ERRORUSDT", broken)
        .otherwise(full)
        .alias("line"),
    ).withColumn(
        "_copy", F.explode(F.sequence(F.lit(0), F.when(F.col("hour") % 23 == 3, 1).otherwise(0)))
    )
    header = rows.where(headed).select(
        file.alias("file"),
        F.lit(-1).cast("bigint").alias("hour"),
        F.when(
            F.col("symbol") == "CLICKUSDT",
            "Open_Time,open,high,low,close,volume,close_time,quote_volume,count",
        )
        .otherwise("open_time,open,high,low,volume,close_time,quote_volume,count")
        .alias("line"),
    ).distinct()
    lines = body.select("file", (F.col("hour") * 2 + F.col("_copy")).alias("line_no"), "line").unionByName(
        header.select("file", F.col("hour").alias("line_no"), "line")
    )
    return archives.with_file_parts(lines, "spot")


NORMALISED_SQL = """
SELECT symbol, "interval", "timestamp", open, high, low, close, volume, quote_volume, trades_count,
       CASE WHEN symbol <> 'CLICKUSDT' THEN taker_buy_base_volume END AS taker_buy_base_volume,
       strftime("timestamp" - INTERVAL 1 SECOND, '%Y-%m-%d') AS period
FROM k1h WHERE symbol <> 'ERRORUSDT'
"""


@add("parse_candle_lines", with_views(NORMALISED_SQL, "k1h"))
def parse_candle_lines(spark, folder):
    found = nz.normalise(candle_lines(spark, folder), "spot").rows
    return found.select(
        "symbol", "interval", "timestamp", "open", "high", "low", "close", "volume", "quote_volume",
        "trades_count", "taker_buy_base_volume", "period",
    )


@add(
    "parse_candle_anomalies",
    with_views(
        """
SELECT 'spot' AS "table", symbol, "interval", 'import_dropped_duplicate_rows' AS check_name,
       symbol || '-1h-' || strftime("timestamp" - INTERVAL 1 SECOND, '%Y-%m-%d') || '.csv' AS source_file,
       count(*) AS count FROM k1h
WHERE symbol <> 'ERRORUSDT' AND CAST(epoch("timestamp") AS BIGINT) // 3600 % 23 = 3
GROUP BY ALL
""",
        "k1h",
    ),
)
def parse_candle_anomalies(spark, folder):
    found = nz.normalise(candle_lines(spark, folder), "spot").anomalies
    return found.select("table", "symbol", "interval", "check_name", "source_file", "count")


@add(
    "parse_rejected_files",
    with_views(
        """
SELECT DISTINCT symbol || '-1h-' || strftime("timestamp" - INTERVAL 1 SECOND, '%Y-%m-%d') || '.csv' AS file,
       'close' AS missing FROM k1h WHERE symbol = 'ERRORUSDT'
""",
        "k1h",
    ),
)
def parse_rejected_files(spark, folder):
    found = nz.normalise(candle_lines(spark, folder), "spot").rejected
    return found.select("file", F.array_join("missing_columns", ",").alias("missing"))


@add(
    "parse_bad_fields",
    with_views(
        """
SELECT symbol, "timestamp", 'type' AS rule, bad AS "column" FROM (
    SELECT symbol, "timestamp", CAST(epoch("timestamp") AS BIGINT) // 3600 % 11 AS n FROM k1h WHERE symbol = 'VIEWUSDT')
JOIN (VALUES (2, 'trades_count'), (5, 'taker_buy_base_volume'), (7, 'trades_count')) AS t(hit, bad) ON n = hit
""",
        "k1h",
    ),
)
def parse_bad_fields(spark, folder):
    """Text in optional numbers, and a count beyond 32 bits: each is a broken type of its row."""
    lines = candle_lines(spark, folder).where(
        (F.col("symbol") == "VIEWUSDT") & (F.col("line_no") % 2 == 0)
    )
    parts = F.split("line", ",")
    n = F.floor(F.col("line_no") / 2) % 11
    fields = [
        F.when((F.lit(at) == 8) & (n == 2), "abc")
        .when((F.lit(at) == 9) & (n == 5), "x1")
        .when((F.lit(at) == 8) & (n == 7), "9000000000")
        .otherwise(F.get(parts, F.lit(at)))
        for at in range(len(specs.CANDLE_FILE_COLUMNS))
    ]
    rows = nz.normalise(lines.withColumn("line", F.concat_ws(",", *fields)), "spot").rows
    found = va.row_violations(rows, "spot", ["file"])
    return found.select("symbol", "timestamp", "rule", "column")


@add(
    "parse_close_window",
    with_views(
        """
SELECT symbol, "timestamp" FROM k1h WHERE symbol <> 'ERRORUSDT'
  AND "timestamp" > TIMESTAMP '2024-01-05 00:00:00' AND "timestamp" <= TIMESTAMP '2024-01-12 00:00:00'
""",
        "k1h",
    ),
)
def parse_close_window(spark, folder):
    lines = candle_lines(spark, folder)
    low, high = up.close_window(F.lit("2024-01-05").cast("date"), F.lit("2024-01-11").cast("date"))
    windows = lines.select("file").distinct().select(
        "file", low.alias("window_start"), high.alias("window_end")
    )
    return nz.normalise(lines, "spot", windows).rows.select("symbol", "timestamp")


@add(
    "parse_empty_files",
    with_views(
        """
SELECT symbol, strftime("timestamp" - INTERVAL 1 SECOND, '%Y-%m-%d') AS period, CAST(1 AS BIGINT) AS count
FROM k1h WHERE symbol <> 'ERRORUSDT' GROUP BY 1, 2 HAVING count(*) FILTER (
    WHERE "timestamp" > TIMESTAMP '2024-01-05 00:00:00' AND "timestamp" <= TIMESTAMP '2024-01-12 00:00:00') = 0
""",
        "k1h",
    ),
)
def parse_empty_files(spark, folder):
    lines = candle_lines(spark, folder)
    low, high = up.close_window(F.lit("2024-01-05").cast("date"), F.lit("2024-01-11").cast("date"))
    windows = lines.select("file").distinct().select(
        "file", low.alias("window_start"), high.alias("window_end")
    )
    found = nz.normalise(lines, "spot", windows).anomalies
    return found.where(F.col("check_name") == "import_empty_after_parse").select(
        "symbol", "period", "count"
    )


def metric_lines(spark, folder):
    """Metric files per symbol and day: CLICK times are text, VIEW microseconds, else
    milliseconds; every ninth value is zero and every fourteenth line is there twice."""
    rows = views.open_interest(spark, folder)
    number = (epoch_seconds("timestamp") / 300).cast("bigint")
    ms = F.floor(epoch_micros("timestamp") / 1_000).cast("bigint")
    stamp = (
        F.when(F.col("symbol") == "CLICKUSDT", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
        .when(F.col("symbol") == "VIEWUSDT", (ms * 1_000).cast("string"))
        .otherwise(ms.cast("string"))
    )
    value = F.when(number % 9 == 2, F.lit(0.0)).otherwise(F.col("open_interest"))
    file = F.concat("symbol", F.lit("-metrics-"), F.date_format("timestamp", "yyyy-MM-dd"), F.lit(".csv"))
    body = rows.select(
        file.alias("file"),
        number.alias("n"),
        F.concat_ws(",", stamp, "symbol", value.cast("string"), F.lit("1.0")).alias("line"),
    ).withColumn("_copy", F.explode(F.sequence(F.lit(0), F.when(F.col("n") % 14 == 3, 1).otherwise(0))))
    header = rows.select(
        file.alias("file"),
        F.lit(-1).cast("bigint").alias("line_no"),
        F.lit("create_time,symbol,sum_open_interest,sum_open_interest_value").alias("line"),
    ).distinct()
    lines = body.select("file", (F.col("n") * 2 + F.col("_copy")).alias("line_no"), "line")
    return archives.with_file_parts(lines.unionByName(header), "open_interest")


@add(
    "parse_open_interest_lines",
    with_views(
        'SELECT exchange, symbol, "timestamp", open_interest FROM oi '
        'WHERE CAST(epoch("timestamp") AS BIGINT) // 300 % 9 <> 2 AND open_interest <> 0',
        "oi",
    ),
)
def parse_open_interest_lines(spark, folder):
    found = nz.normalise(metric_lines(spark, folder), "open_interest").rows
    return found.select("exchange", "symbol", "timestamp", "open_interest")


@add(
    "parse_open_interest_anomalies",
    with_views(
        """
SELECT symbol, strftime("timestamp", '%Y-%m-%d') AS period, 'import_dropped_zero_open_interest_rows'
       AS check_name, CAST(sum(CASE WHEN n % 14 = 3 THEN 2 ELSE 1 END) AS BIGINT) AS count
FROM (SELECT *, CAST(epoch("timestamp") AS BIGINT) // 300 AS n FROM oi)
WHERE n % 9 = 2 OR open_interest = 0 GROUP BY 1, 2
UNION ALL SELECT symbol, strftime("timestamp", '%Y-%m-%d'), 'import_dropped_duplicate_rows', count(*)
FROM (SELECT *, CAST(epoch("timestamp") AS BIGINT) // 300 AS n FROM oi)
WHERE n % 14 = 3 AND n % 9 <> 2 AND open_interest <> 0 GROUP BY 1, 2
""",
        "oi",
    ),
)
def parse_open_interest_anomalies(spark, folder):
    found = nz.normalise(metric_lines(spark, folder), "open_interest").anomalies
    return found.where(F.col("check_name") != "import_empty_after_parse").select(
        "symbol", "period", "check_name", "count"
    )


@add(
    "parse_funding_lines",
    with_views('SELECT exchange, symbol, "timestamp" + INTERVAL 7 MILLISECOND AS "timestamp", funding_rate FROM fr', "fr"),
)
def parse_funding_lines(spark, folder):
    """Monthly funding files, times kept to the millisecond, VIEW files in microseconds."""
    rows = views.funding_rates(spark, folder)
    ms = F.floor(epoch_micros("timestamp") / 1_000).cast("bigint") + 7
    stamp = F.when(F.col("symbol") == "VIEWUSDT", ms * 1_000).otherwise(ms)
    file = F.concat("symbol", F.lit("-fundingRate-"), F.date_format("timestamp", "yyyy-MM"), F.lit(".csv"))
    body = rows.select(
        file.alias("file"),
        ms.alias("line_no"),
        F.concat_ws(",", stamp.cast("string"), F.lit("8"), F.col("funding_rate").cast("string")).alias("line"),
    )
    header = rows.select(
        file.alias("file"),
        F.lit(-1).cast("bigint").alias("line_no"),
        F.lit("calc_time,funding_interval_hours,last_funding_rate").alias("line"),
    ).distinct()
    lines = archives.with_file_parts(body.unionByName(header), "funding_rates")
    return nz.normalise(lines, "funding_rates").rows.select(
        "exchange", "symbol", "timestamp", "funding_rate"
    )


# ---------------------------------------------------------------------------
# Payloads
# ---------------------------------------------------------------------------
@add(
    "parse_candle_payload",
    with_views(
        'SELECT symbol, "interval", "timestamp", open, close, volume, quote_volume, trades_count FROM k1h',
        "k1h",
    ),
)
def parse_candle_payload(spark, folder):
    """One payload per symbol and day: a JSON array of 12-element arrays, numbers as text."""
    close_ms = F.floor(epoch_micros("timestamp") / 1_000).cast("bigint") - 1
    fields = [
        (close_ms - 3_599_999), "open", "high", "low", "close", "volume", close_ms, "quote_volume",
        "trades_count", "taker_buy_base_volume", "taker_buy_quote_volume", F.lit("0"),
    ]
    texts = [(F.col(f) if isinstance(f, str) else f).cast("string") for f in fields]
    # At most 24 candles per symbol and day in one payload.
    payloads = (
        views.hourly_candles(spark, folder)
        .groupBy("symbol", "interval", up.close_day("timestamp").alias("day"))
        .agg(F.to_json(F.sort_array(F.collect_list(F.array(*texts)))).alias("payload"))
    )
    return nz.candle_payload_rows(payloads).select(
        "symbol", "interval", "timestamp", "open", "close", "volume", "quote_volume", "trades_count"
    )


@add(
    "parse_bad_payloads",
    with_views(
        """
SELECT symbol, day, ['not a JSON array of records', 'record with missing fields', 'unreadable field'][bad::INT] AS reason
FROM (SELECT DISTINCT symbol, CAST("timestamp" - INTERVAL 1 MICROSECOND AS DATE) AS day,
             day(CAST("timestamp" - INTERVAL 1 MICROSECOND AS DATE)) % 5 AS bad FROM k1h) WHERE bad BETWEEN 1 AND 3
""",
        "k1h",
    ),
)
def parse_bad_payloads(spark, folder):
    """Cut-off JSON, records with too few fields and unreadable numbers: the payload is rejected."""
    days = views.hourly_candles(spark, folder).select(
        "symbol", "interval", up.close_day("timestamp").alias("day")
    ).distinct()
    good = '["1704067200000","1","2","1","2","5","1704070799999","9","3","1","1","0"]'
    bad = F.dayofmonth("day") % 5
    payload = (
        F.when(bad == 1, "[" + good + ",[")
        .when(bad == 2, "[" + good + ',["1704067200000","1"]]')
        .when(bad == 3, "[" + good.replace('"5"', '"five"') + "]")
        .otherwise("[" + good + "]")
    )
    return nz.rejected_payloads(days.withColumn("payload", payload), "spot").drop("interval")


@add("parse_funding_payload", with_views("SELECT exchange, symbol, \"timestamp\", funding_rate FROM fr", "fr"))
def parse_funding_payload(spark, folder):
    """One payload per symbol and day: a JSON array of objects."""
    ms = F.floor(epoch_micros("timestamp") / 1_000).cast("bigint")
    item = F.struct(ms.alias("fundingTime"), F.col("funding_rate").cast("string").alias("fundingRate"))
    payloads = (
        views.funding_rates(spark, folder)
        .groupBy("symbol", F.to_date("timestamp").alias("day"))
        .agg(F.to_json(F.collect_list(item)).alias("payload"))
    )
    return nz.funding_payload_rows(payloads)


@add(
    "parse_listings",
    with_views(
        "SELECT provider_id, \"date\", symbol, name, slug, rank, market_cap, fully_diluted_market_cap, "
        "replace(tags, ', ', ',') AS tags, platform, DATE '2020-05-06' AS date_added FROM uni",
        "uni",
    ),
)
def parse_listings(spark, folder):
    """One JSON document per snapshot date, read back through the listing schema."""
    coin = F.struct(
        F.col("provider_id").alias("id"),
        "name",
        F.lower("symbol").alias("symbol"),
        "slug",
        F.col("rank").alias("cmcRank"),
        F.split("tags", ", ").alias("tags"),
        F.when(F.col("platform").isNotNull(), F.struct(F.col("platform").alias("name"))).alias("platform"),
        F.array(
            F.struct(
                F.col("market_cap").alias("marketCap"),
                F.col("fully_diluted_market_cap").alias("fullyDilutedMarketCap"),
            )
        ).alias("quotes"),
        F.lit("2020-05-06T07:08:09.000Z").alias("dateAdded"),
    )
    documents = (
        views.rankings(spark, folder)
        .groupBy("date")
        .agg(F.to_json(F.struct(F.collect_list(coin).alias("data"))).alias("text"))
    )
    parsed = documents.select(
        "date", F.from_json("text", f"data array<{nz.LISTING_SHAPE}>").alias("d")
    ).select("date", "d.data")
    return nz.listing_rows(parsed).drop("provider", "circulating_supply", "max_supply")


# ---------------------------------------------------------------------------
# Calendars and plans
# ---------------------------------------------------------------------------
_RANGES = """
SELECT symbol, CAST(min("timestamp") AS DATE) AS "start", CAST(max("timestamp") AS DATE) AS "end"
FROM k1d GROUP BY 1
"""


def _ranges(spark, folder):
    return (
        views.daily_candles(spark, folder)
        .groupBy("symbol")
        .agg(
            F.to_date(F.min("timestamp")).alias("start"), F.to_date(F.max("timestamp")).alias("end")
        )
    )


_MONTHS = """
SELECT symbol, unnest(generate_series(date_trunc('month', CAST("start" AS TIMESTAMP)),
       date_trunc('month', CAST("end" AS TIMESTAMP)), INTERVAL 1 MONTH)) AS m, "start", "end" FROM ranges
"""
_DAYS = """
SELECT symbol, unnest(generate_series(CAST("start" AS TIMESTAMP), CAST("end" AS TIMESTAMP),
       INTERVAL 1 DAY)) AS d, "start", "end" FROM ranges
"""
RANGE_CTES = {"ranges": _RANGES, "months": _MONTHS, "days": _DAYS}


@add(
    "plan_months",
    with_views("SELECT symbol, strftime(m, '%Y-%m') AS period FROM months", "k1d", extra=RANGE_CTES),
)
def plan_months(spark, folder):
    return pl.months(_ranges(spark, folder))


@add(
    "plan_snapshot_dates",
    with_views(
        """
SELECT symbol, 'monthly' AS frequency, CAST(m AS DATE) AS "date" FROM months
UNION ALL SELECT symbol, 'weekly', CAST(d AS DATE) FROM days WHERE isodow(d) = 1
UNION ALL SELECT symbol, 'daily', CAST(d AS DATE) FROM days
""",
        "k1d",
        extra=RANGE_CTES,
    ),
)
def plan_snapshot_dates(spark, folder):
    ranges = _ranges(spark, folder)
    parts = [
        pl.calendar(ranges, f).select("symbol", F.lit(f).alias("frequency"), "date")
        for f in ("monthly", "weekly", "daily")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_AS_OF = "2001-06-20"
PLAN_SQL = f"""
SELECT symbol, strftime(m, '%Y-%m') AS period, TRUE AS is_monthly, FALSE AS replace_existing FROM months
WHERE m + INTERVAL 1 MONTH - INTERVAL 1 DAY < TIMESTAMP '{_AS_OF}'
UNION ALL SELECT symbol, strftime(d, '%Y-%m-%d'), FALSE, d >= TIMESTAMP '{_AS_OF}' - INTERVAL 3 DAY FROM days
WHERE last_day(d) >= DATE '{_AS_OF}' AND d < TIMESTAMP '{_AS_OF}'
"""


@add("plan_candle_files", with_views(PLAN_SQL, "k1d", extra=RANGE_CTES))
def plan_candle_files(spark, folder):
    return pl.candle_periods(_ranges(spark, folder), _AS_OF)


@add(
    "plan_metric_files",
    with_views(
        """
SELECT symbol, 'open_interest' AS "table", strftime(d, '%Y-%m-%d') AS period, FALSE AS is_monthly,
       FALSE AS replace_existing FROM days
UNION ALL SELECT symbol, 'funding_rates', strftime(m, '%Y-%m'), TRUE, FALSE FROM months
""",
        "k1d",
        extra=RANGE_CTES,
    ),
)
def plan_metric_files(spark, folder):
    ranges = _ranges(spark, folder)
    parts = [
        pl.metric_periods(ranges, t).withColumn("table", F.lit(t))
        for t in ("open_interest", "funding_rates")
    ]
    return parts[0].unionByName(parts[1])


@add(
    "archive_paths",
    with_views(
        """
SELECT symbol, month AS period,
       'data/spot/monthly/klines/' || symbol || '/1d/' || symbol || '-1d-' || month || '.zip' AS spot,
       'data/futures/um/monthly/klines/' || symbol || '/1d/' || symbol || '-1d-' || month || '.zip' AS futures,
       'data/futures/um/monthly/fundingRate/' || symbol || '/' || symbol || '-fundingRate-' || month || '.zip'
           AS funding_rates,
       'data/spot/daily/klines/' || symbol || '/1d/' || symbol || '-1d-' || month || '-15.zip' AS spot_day,
       'data/futures/um/daily/klines/' || symbol || '/1d/' || symbol || '-1d-' || month || '-15.zip' AS futures_day,
       'data/futures/um/daily/metrics/' || symbol || '/' || symbol || '-metrics-' || month || '-15.zip' AS open_interest
FROM (SELECT symbol, strftime(m, '%Y-%m') AS month FROM months)
""",
        "k1d",
        extra=RANGE_CTES,
    ),
)
def archive_paths(spark, folder):
    """Monthly files of candles and funding, daily files of candles and open interest."""
    months = pl.months(_ranges(spark, folder))
    day = F.concat("period", F.lit("-15"))
    shapes = {
        "spot": ("spot", True),
        "futures": ("futures", True),
        "funding_rates": ("funding_rates", True),
        "spot_day": ("spot", False),
        "futures_day": ("futures", False),
        "open_interest": ("open_interest", False),
    }
    return months.withColumns(
        {
            name: archives.archive_path(
                table, F.col("symbol"), F.lit("1d"), F.col("period") if monthly else day, F.lit(monthly)
            )
            for name, (table, monthly) in shapes.items()
        }
    )


def _day_requests(df):
    days = df.groupBy("symbol", "interval").agg(
        F.to_date(F.min("timestamp")).alias("start"), F.to_date(F.max("timestamp")).alias("end")
    )
    return pl.calendar(days, "daily").select(
        "symbol",
        "interval",
        F.date_format("date", "yyyy-MM-dd").alias("period"),
        F.lit(False).alias("is_monthly"),
        (F.dayofmonth("date") % 10 == 0).alias("replace_existing"),
    )


DAY_STATUS = """
SELECT r.symbol, r."interval", strftime(r.d, '%Y-%m-%d') AS period, day(r.d) % 10 = 0 AS replace_existing,
       count(k."timestamp") AS row_count,
       coalesce(count(k."timestamp") >= floor(date_diff('second', min(k."timestamp"), max(k."timestamp"))
           / 3600) + 1 AND min(k."timestamp") <= r.d + INTERVAL 1 HOUR
           AND max(k."timestamp") >= r.d + INTERVAL 1 DAY, FALSE) AS complete
FROM (SELECT symbol, "interval", unnest(generate_series(date_trunc('day', min("timestamp")),
             date_trunc('day', max("timestamp")), INTERVAL 1 DAY)) AS d FROM dirty GROUP BY 1, 2) AS r
LEFT JOIN dirty AS k ON k.symbol = r.symbol AND k."interval" = r."interval" AND k."timestamp" > r.d
 AND k."timestamp" <= r.d + INTERVAL 1 DAY GROUP BY 1, 2, 3, 4, r.d
"""


@add("period_complete_kline", with_views(DAY_STATUS, "dirty"))
def period_complete_kline(spark, folder):
    candles = views.dirty_candles(spark, folder)
    found = pl.candle_period_status(_day_requests(candles), candles)
    return found.select("symbol", "interval", "period", "replace_existing", "row_count", "complete")


@add(
    "missing_periods",
    with_views(
        f"SELECT symbol, \"interval\", period FROM ({DAY_STATUS}) WHERE replace_existing OR NOT complete",
        "dirty",
    ),
)
def missing_periods(spark, folder):
    candles = views.dirty_candles(spark, folder)
    found = pl.missing_periods(pl.candle_period_status(_day_requests(candles), candles))
    return found.select("symbol", "interval", "period")


@add(
    "period_complete_metric",
    with_views(
        """
SELECT r.symbol, strftime(r.d, '%Y-%m-%d') AS period, count(f."timestamp") AS row_count,
       coalesce(count(f."timestamp") >= 2 AND min(f."timestamp") <= r.d + INTERVAL 8 HOUR
           AND max(f."timestamp") >= r.d + INTERVAL 1 DAY - INTERVAL 8 HOUR
           AND max(date_diff('second', prev, f."timestamp")) <= 28800, FALSE) AS complete
FROM (SELECT symbol, unnest(generate_series(date_trunc('day', min("timestamp")),
             date_trunc('day', max("timestamp")), INTERVAL 1 DAY)) AS d FROM fr GROUP BY 1) AS r
LEFT JOIN (SELECT *, lag("timestamp") OVER (PARTITION BY symbol, date_trunc('day', "timestamp")
                                            ORDER BY "timestamp") AS prev FROM fr) AS f
  ON f.symbol = r.symbol AND date_trunc('day', f."timestamp") = r.d GROUP BY 1, 2, r.d
""",
        "fr",
    ),
)
def period_complete_metric(spark, folder):
    rates = views.funding_rates(spark, folder)
    asked = _day_requests(rates.withColumn("interval", F.lit(None).cast("string")))
    found = pl.metric_period_status(asked, rates, "funding_rates")
    return found.select("symbol", "period", "row_count", "complete")


@add(
    "missing_snapshot_dates",
    with_views(
        """
SELECT "date" FROM (
    SELECT CAST(unnest(generate_series(CAST(min("date") AS TIMESTAMP), CAST(max("date") AS TIMESTAMP),
                INTERVAL 1 MONTH)) AS DATE) AS "date" FROM uni)
WHERE "date" NOT IN (SELECT "date" FROM duni)
""",
        "uni",
        "duni",
    ),
)
def missing_snapshot_dates(spark, folder):
    span = views.rankings(spark, folder).agg(F.min("date").alias("start"), F.max("date").alias("end"))
    return pl.missing_snapshot_dates(
        pl.calendar(span, "monthly"), views.dirty_rankings(spark, folder)
    )


FILE_STATUS = """
SELECT symbol, strftime(d, '%Y-%m-%d') AS period,
       CASE WHEN n > 0 THEN 'success' WHEN day(d) % 13 = 5 THEN 'failed' ELSE 'not_found' END AS status
FROM (SELECT r.symbol, r.d, count(k."timestamp") AS n FROM days AS r LEFT JOIN k1d AS k
        ON k.symbol = r.symbol AND k."timestamp" = r.d + INTERVAL 1 DAY GROUP BY 1, 2)
"""


def _file_status(spark, folder):
    """Availability of daily files: a day without candle was not found, or failed now and then."""
    days = pl.calendar(_ranges(spark, folder), "daily").select(
        "symbol", "date", F.date_format("date", "yyyy-MM-dd").alias("period")
    )
    have = views.daily_candles(spark, folder).select(
        "symbol", up.close_day("timestamp").alias("date"), F.lit(True).alias("have")
    )
    return days.join(have, ["symbol", "date"], "left").select(
        "symbol",
        "period",
        F.when(F.col("have"), "success")
        .when(F.dayofmonth("date") % 13 == 5, "failed")
        .otherwise("not_found")
        .alias("status"),
    )


@add(
    "end_of_life",
    with_views(
        """
SELECT symbol, count(*) AS periods, max(period) AS last_period FROM (
    SELECT s.*, min(CASE WHEN run >= 4 THEN first_miss END) OVER (PARTITION BY s.symbol) AS cut
    FROM (SELECT *, count(*) FILTER (WHERE status = 'not_found' AND alive) OVER (PARTITION BY symbol, block)
                AS run, min(CASE WHEN status = 'not_found' AND alive THEN period END)
                OVER (PARTITION BY symbol, block) AS first_miss
          FROM (SELECT *, sum(CASE WHEN status <> 'not_found' THEN 1 ELSE 0 END) OVER w AS block,
                       max(CASE WHEN status = 'success' THEN 1 ELSE 0 END) OVER w = 1 AS alive
                FROM status WINDOW w AS (PARTITION BY symbol ORDER BY period ROWS UNBOUNDED PRECEDING)))
         AS s) WHERE cut IS NULL OR period < cut GROUP BY 1
""",
        "k1d",
        extra={**RANGE_CTES, "status": FILE_STATUS},
    ),
)
def end_of_life(spark, folder):
    kept = pl.cut_after_end_of_life(_file_status(spark, folder), 4)
    return kept.groupBy("symbol").agg(
        F.count("*").alias("periods"), F.max("period").alias("last_period")
    )


@add(
    "ingest_counters",
    with_views(
        "SELECT status, count(*) AS periods FROM status GROUP BY 1",
        "k1d",
        extra={**RANGE_CTES, "status": FILE_STATUS},
    ),
)
def ingest_counters(spark, folder):
    return pl.status_counts(_file_status(spark, folder))


@add(
    "effective_symbols",
    """
WITH requests AS (SELECT DISTINCT 'futures' AS "table", upper(event_type) || 'USDT' AS symbol, day(ts) AS d FROM events
                  UNION SELECT DISTINCT 'spot', upper(event_type) || 'USDT', day(ts) FROM events)
SELECT "table", symbol, d, CASE WHEN "table" = 'futures' AND symbol IN ('VIEWUSDT', 'CLICKUSDT')
       THEN '1000' || symbol ELSE symbol END AS effective_symbol FROM requests
""",
)
def effective_symbols(spark, folder):
    """VIEW and CLICK have prefixed futures files only; SIGNUP has both kinds."""
    names = views.read_table(spark, folder, "events").select(
        F.concat(F.upper("event_type"), F.lit("USDT")).alias("symbol"), F.dayofmonth("ts").alias("d")
    ).distinct()
    requests = names.withColumn("table", F.explode(F.array(F.lit("futures"), F.lit("spot"))))
    prefixed = F.col("symbol").isin("VIEWUSDT", "CLICKUSDT")
    files = names.where(~prefixed).select("symbol").unionByName(
        names.where(prefixed | (F.col("symbol") == "SIGNUPUSDT")).select(
            F.concat(F.lit("1000"), "symbol").alias("symbol")
        )
    )
    available = files.distinct().withColumn(
        "table", F.explode(F.array(F.lit("futures"), F.lit("spot")))
    )
    found = pl.effective_symbols(requests, available)
    return found.select("table", "symbol", F.col("d").cast("bigint").alias("d"), "effective_symbol")


AVAILABLE = """
SELECT symbol, 'spot' AS data_type, CAST(min("timestamp") AS DATE) AS first_date,
       CAST(max("timestamp") AS DATE) AS last_date FROM k1h GROUP BY 1
UNION ALL SELECT symbol, 'futures', CAST(min("timestamp") AS DATE), CAST(max("timestamp") AS DATE)
FROM holed WHERE symbol <> 'VIEWUSDT' GROUP BY 1
UNION ALL SELECT symbol, 'open_interest', CAST(min("timestamp") AS DATE), CAST(max("timestamp") AS DATE)
FROM oi GROUP BY 1
UNION ALL SELECT symbol, 'funding_rates', CAST(min("timestamp") AS DATE), CAST(max("timestamp") AS DATE)
FROM fr WHERE symbol <> 'ERRORUSDT' GROUP BY 1
"""


def _available(spark, folder):
    return pl.availability(
        {
            "spot": views.hourly_candles(spark, folder),
            "futures": views.holed_candles(spark, folder).where(F.col("symbol") != "VIEWUSDT"),
            "open_interest": views.open_interest(spark, folder),
            "funding_rates": views.funding_rates(spark, folder).where(F.col("symbol") != "ERRORUSDT"),
        },
        "1h",
    )


@add("availability", with_views(AVAILABLE, "k1h", "holed", "oi", "fr"))
def availability(spark, folder):
    return _available(spark, folder)


@add(
    "coverage_pct",
    with_views(
        """
SELECT symbol, data_type, first_date, last_date, CAST(covered AS INTEGER) AS covered,
       CAST(total AS INTEGER) AS total, CAST(floor(covered / total * 100) AS INTEGER) AS percent FROM (
    SELECT *, CASE WHEN data_type = 'open_interest' THEN 61 ELSE 3 END AS total,
           CASE WHEN data_type = 'open_interest'
                THEN date_diff('day', greatest(first_date, DATE '2023-12-10'), least(last_date, DATE '2024-02-08')) + 1
                ELSE (year(least(last_date, DATE '2024-02-08')) - year(greatest(first_date, DATE '2023-12-10'))) * 12
                     + month(least(last_date, DATE '2024-02-08')) - month(greatest(first_date, DATE '2023-12-10')) + 1
           END AS covered FROM available)
""",
        "k1h",
        "holed",
        "oi",
        "fr",
        extra={"available": AVAILABLE},
    ),
)
def coverage_pct(spark, folder):
    return pl.coverage(_available(spark, folder), "2023-12-10", "2024-02-08")


@add(
    "missing_data_types",
    "SELECT 'VIEWUSDT' AS symbol, 'futures' AS missing UNION ALL SELECT 'ERRORUSDT', 'funding_rates'",
)
def missing_data_types(spark, folder):
    return pl.missing_data_types(
        _available(spark, folder), ["spot", "futures", "open_interest", "funding_rates"]
    )


# ---------------------------------------------------------------------------
# Upserts
# ---------------------------------------------------------------------------
@add(
    "upsert_new_rows",
    with_views(
        """
SELECT DISTINCT d.symbol, d."timestamp" FROM dirty AS d WHERE NOT EXISTS (
    SELECT 1 FROM holed AS t WHERE t.symbol = d.symbol AND t."timestamp" = d."timestamp")
""",
        "dirty",
        "holed",
    ),
)
def upsert_new_rows(spark, folder):
    found = up.new_rows(
        views.dirty_candles(spark, folder), views.holed_candles(spark, folder), "spot"
    )
    return found.select("symbol", "timestamp")


@add(
    "dedupe_incoming",
    with_views(
        """
SELECT symbol, "timestamp", min(open) - CASE WHEN CAST(epoch("timestamp") AS BIGINT) // 3600 % 2 = 0 THEN 1 ELSE 0 END AS open,
       any_value(volume) AS volume
FROM dirty GROUP BY exchange, symbol, "interval", "timestamp"
""",
        "dirty",
    ),
)
def dedupe_incoming(spark, folder):
    """Every row comes a second time with another open, lower in even hours and higher in odd ones."""
    rows = views.dirty_candles(spark, folder)
    other = F.col("open") + F.when(_hour() % 2 == 0, -1).otherwise(1)
    found = up.dedupe_incoming(rows.unionByName(rows.withColumn("open", other)), "spot")
    return found.select("symbol", "timestamp", "open", "volume")


@add(
    "keep_first_row",
    """
SELECT user_id, event_type, event_id, value, n FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS nth,
           count(*) OVER (PARTITION BY user_id, event_type) AS n FROM events) WHERE nth = 1
""",
)
def keep_first_row(spark, folder):
    events = views.read_table(spark, folder, "events").select(
        "user_id", "event_type", "event_id", "value"
    )
    return up.keep_first(events, ["user_id", "event_type"], ["event_id"]).withColumnRenamed(
        up.COPIES, "n"
    )


@add(
    "replace_day",
    with_views(
        """
SELECT symbol, "timestamp", close FROM holed WHERE NOT ("timestamp" > TIMESTAMP '2024-01-10 00:00:00'
    AND "timestamp" <= TIMESTAMP '2024-01-12 00:00:00' AND symbol IN ('VIEWUSDT', 'CLICKUSDT'))
UNION ALL SELECT symbol, "timestamp", close + 1 FROM k1h WHERE "timestamp" > TIMESTAMP '2024-01-10 00:00:00'
    AND "timestamp" <= TIMESTAMP '2024-01-12 00:00:00' AND symbol IN ('VIEWUSDT', 'CLICKUSDT')
""",
        "holed",
        "k1h",
    ),
)
def replace_day(spark, folder):
    incoming = (
        views.hourly_candles(spark, folder)
        .where(F.col("symbol").isin("VIEWUSDT", "CLICKUSDT"))
        .where(up.close_day("timestamp").isin("2024-01-10", "2024-01-11"))
        .withColumn("close", F.col("close") + 1)
    )
    days = incoming.select("symbol", "interval", up.close_day("timestamp").alias("day"))
    found = up.replace_days(views.holed_candles(spark, folder), incoming, days)
    return found.select("symbol", "timestamp", "close")


@add(
    "replace_snapshot_dates",
    with_views(
        """
SELECT provider_id, "date", rank, market_cap FROM duni
WHERE year("date") <> 1996 UNION ALL SELECT provider_id, "date", rank, market_cap FROM uni
WHERE year("date") = 1996 AND month("date") <> 5
""",
        "duni",
        "uni",
    ),
)
def replace_snapshot_dates(spark, folder):
    """All snapshots of 1996 replaced by clean ones; May has no rows and ends up empty."""
    clean = views.rankings(spark, folder).where(F.year("date") == 1996)
    found = up.replace_dates(
        views.dirty_rankings(spark, folder), clean.where(F.month("date") != 5), clean.select("date")
    )
    return found.select("provider_id", "date", "rank", "market_cap")


@add(
    "dedupe_snapshot",
    with_views(
        """
SELECT provider_id, "date", rank, market_cap FROM (
    SELECT *, row_number() OVER (PARTITION BY provider, provider_id, "date" ORDER BY rank NULLS LAST,
               market_cap DESC NULLS LAST) AS nth FROM duni) WHERE nth = 1
""",
        "duni",
    ),
)
def dedupe_snapshot(spark, folder):
    found = up.dedupe_snapshot(views.dirty_rankings(spark, folder))
    return found.select("provider_id", "date", "rank", "market_cap")


@add(
    "accepted_files",
    with_views(
        """
SELECT symbol, "timestamp" FROM files WHERE file NOT IN (
    SELECT file FROM files WHERE open IS NULL OR close IS NULL OR high < low OR high < open OR high < close
        OR low > open OR low > close OR volume < 0
    UNION SELECT file FROM files GROUP BY file, symbol, "timestamp" HAVING count(*) > 1)
""",
        "dirty",
        extra={
            "files": "SELECT *, symbol || strftime(\"timestamp\" - INTERVAL 1 MICROSECOND, '%Y-%m-%d') "
            "AS file FROM dirty"
        },
    ),
)
def accepted_files(spark, folder):
    """Candles as one file per symbol and day; one bad row rejects its file."""
    rows = views.dirty_candles(spark, folder).withColumn(
        "file", F.concat("symbol", F.date_format(up.close_day("timestamp"), "yyyy-MM-dd"))
    )
    kept = up.accepted_files(rows, va.violations(rows, "spot", ["file"]))
    return kept.select("symbol", "timestamp")


@add(
    "prune_to_window",
    with_views(
        """
SELECT symbol, "timestamp" FROM k1h WHERE symbol NOT IN ('VIEWUSDT', 'CLICKUSDT')
   OR ("timestamp" > TIMESTAMP '2024-01-10 00:00:00' AND "timestamp" <= TIMESTAMP '2024-01-20 00:00:00')
""",
        "k1h",
    ),
)
def prune_to_window(spark, folder):
    low, high = up.close_window(F.lit("2024-01-10").cast("date"), F.lit("2024-01-19").cast("date"))
    found = up.prune_to_window(
        views.hourly_candles(spark, folder), ["VIEWUSDT", "CLICKUSDT"], "1h", low, high
    )
    return found.select("symbol", "timestamp")


@add(
    "interval_labels",
    """
SELECT event_id, CASE WHEN s % 86400 = 0 THEN (s // 86400) || 'd' WHEN s % 3600 = 0 THEN (s // 3600) || 'h'
       WHEN s % 60 = 0 THEN (s // 60) || 'm' ELSE s || 's' END AS label
FROM (SELECT event_id, (event_id % 97 + 1) * CASE event_id % 4 WHEN 0 THEN 86400 WHEN 1 THEN 1800
             WHEN 2 THEN 30 ELSE 7 END AS s FROM events)
""",
)
def interval_labels(spark, folder):
    unit = (
        F.when(F.col("event_id") % 4 == 0, 86_400)
        .when(F.col("event_id") % 4 == 1, 1_800)
        .when(F.col("event_id") % 4 == 2, 30)
        .otherwise(7)
    )
    seconds = (F.col("event_id") % 97 + 1) * unit
    return views.read_table(spark, folder, "events").select(
        "event_id", interval_label(seconds).alias("label")
    )


# ---------------------------------------------------------------------------
# Stores, reports, exports: written to the shared folder and read back
# ---------------------------------------------------------------------------
@add(
    "store_round_trip",
    with_views(
        """
SELECT symbol, "timestamp", close FROM holed WHERE symbol <> 'VIEWUSDT'
   OR NOT ("timestamp" > TIMESTAMP '2024-01-10 00:00:00' AND "timestamp" <= TIMESTAMP '2024-01-11 00:00:00')
UNION ALL SELECT k.symbol, k."timestamp", k.close FROM k1h AS k WHERE NOT EXISTS (
    SELECT 1 FROM holed AS t WHERE t.symbol = k.symbol AND t."timestamp" = k."timestamp")
  AND NOT (symbol = 'VIEWUSDT' AND "timestamp" > TIMESTAMP '2024-01-10 00:00:00'
           AND "timestamp" <= TIMESTAMP '2024-01-11 00:00:00')
UNION ALL SELECT symbol, "timestamp", close + 1 FROM k1h WHERE symbol = 'VIEWUSDT'
  AND "timestamp" > TIMESTAMP '2024-01-10 00:00:00' AND "timestamp" <= TIMESTAMP '2024-01-11 00:00:00'
""",
        "holed",
        "k1h",
    ),
)
def store_round_trip(spark, folder):
    """Insert with holes, insert everything twice, replace one day, read the table."""
    root = scratch_path(spark, "store")
    full = materialise(views.hourly_candles(spark, folder), "full")
    tables.insert_new(spark, root, "spot", views.holed_candles(spark, folder))
    tables.insert_new(spark, root, "spot", full)
    tables.insert_new(spark, root, "spot", full)
    day = full.where(
        (F.col("symbol") == "VIEWUSDT") & (up.close_day("timestamp") == F.lit("2024-01-10").cast("date"))
    ).withColumns({"close": F.col("close") + 1, "high": F.col("high") + 1})
    days = day.select("symbol", "interval", up.close_day("timestamp").alias("day"))
    tables.replace_days(spark, root, "spot", day, days)
    return tables.read_table(spark, root, "spot", intervals=["1h"]).select(
        "symbol", "timestamp", "close"
    )


REPLACED_DAY = """"timestamp" > TIMESTAMP '2024-01-10 00:00:00' AND "timestamp" <= TIMESTAMP '2024-01-11 00:00:00'"""
#: Rows after an insert with holes, one that fills a symbol's, a thinner day in place of a stored one, and a prune.
CHANGED = f"""
SELECT symbol, "interval", "timestamp" FROM holed WHERE symbol <> 'CLICKUSDT' AND NOT (symbol = 'VIEWUSDT' AND {REPLACED_DAY})
   AND (symbol <> 'PURCHASEUSDT' OR ("timestamp" > TIMESTAMP '2024-01-05 00:00:00' AND "timestamp" <= TIMESTAMP '2024-01-21 00:00:00'))
UNION ALL SELECT symbol, "interval", "timestamp" FROM k1h WHERE symbol = 'CLICKUSDT'
UNION ALL SELECT symbol, "interval", "timestamp" FROM k1h WHERE symbol = 'VIEWUSDT' AND {REPLACED_DAY} AND hour("timestamp") % 2 = 0
"""


def _changed_store(spark, folder):
    """A stored table after inserts, a replacement and a prune."""
    root = scratch_path(spark, "changed")
    full = materialise(views.hourly_candles(spark, folder), "full")
    tables.insert_new(spark, root, "spot", views.holed_candles(spark, folder))
    tables.insert_new(spark, root, "spot", full.where(F.col("symbol") == "CLICKUSDT"))
    day = full.where(
        (F.col("symbol") == "VIEWUSDT") & (up.close_day("timestamp") == F.lit("2024-01-10").cast("date"))
    )
    days = day.select("symbol", "interval", up.close_day("timestamp").alias("day"))
    tables.replace_days(spark, root, "spot", day.where(F.hour("timestamp") % 2 == 0), days)
    low, high = up.close_window(F.lit("2024-01-05").cast("date"), F.lit("2024-01-20").cast("date"))
    tables.prune(spark, root, "spot", spark.range(1).select(F.lit("PURCHASEUSDT").alias("symbol")), ["1h"], low, high)
    return root


@add(
    "coverage_days",
    with_views(
        """
SELECT symbol, "interval", "day", count(*) AS row_count, min("timestamp") AS first_timestamp,
       max("timestamp") AS last_timestamp, max(gap) AS widest_gap
FROM (SELECT *, date_diff('microsecond', lag("timestamp") OVER (PARTITION BY symbol, "interval", "day"
                                                                 ORDER BY "timestamp"), "timestamp") AS gap
      FROM (SELECT *, CAST("timestamp" - INTERVAL 1 MICROSECOND AS DATE) AS "day" FROM changed))
GROUP BY 1, 2, 3
""",
        "holed",
        "k1h",
        extra={"changed": CHANGED},
    ),
)
def coverage_days(spark, folder):
    """Kept summaries after inserts, a replacement and a prune."""
    found = tables.read_coverage(spark, _changed_store(spark, folder), "spot")
    return found.select("symbol", "interval", "day", *coverage.MEASURES)


@add(
    "coverage_periods_kline",
    with_views(
        """
SELECT r.symbol, r."interval", r.period, count(k."timestamp") AS row_count,
       coalesce(count(k."timestamp") >= floor(date_diff('second', min(k."timestamp"), max(k."timestamp")) / 3600) + 1
           AND min(k."timestamp") <= r.d + INTERVAL 1 HOUR AND max(k."timestamp") >= r.e, FALSE) AS complete
FROM (SELECT symbol, "interval", d, d + INTERVAL 1 DAY AS e, strftime(d, '%Y-%m-%d') AS period FROM (
          SELECT symbol, "interval", unnest(generate_series(date_trunc('day', min("timestamp")),
                 date_trunc('day', max("timestamp")), INTERVAL 1 DAY)) AS d FROM k1h GROUP BY 1, 2)
      UNION ALL SELECT symbol, "interval", d, d + INTERVAL 1 MONTH, strftime(d, '%Y-%m') FROM (
          SELECT symbol, "interval", unnest(generate_series(date_trunc('month', min("timestamp")),
                 date_trunc('month', max("timestamp")), INTERVAL 1 MONTH)) AS d FROM k1h GROUP BY 1, 2)) AS r
LEFT JOIN changed AS k ON k.symbol = r.symbol AND k."interval" = r."interval" AND k."timestamp" > r.d
 AND k."timestamp" <= r.e GROUP BY 1, 2, 3, r.d, r.e
""",
        "holed",
        "k1h",
        extra={"changed": CHANGED},
    ),
)
def coverage_periods_kline(spark, folder):
    """Days and months of a changed table that are complete, from its kept summaries alone."""
    days = tables.read_coverage(spark, _changed_store(spark, folder), "spot", intervals=["1h"])
    asked = _all_periods(views.hourly_candles(spark, folder), "interval")
    found = pl.stored_period_status(asked, days, "spot")
    return found.select("symbol", "interval", "period", "row_count", "complete")


def _all_periods(rows, *keys):
    """Every day and every month between the first and the last row of a symbol."""
    spans = rows.groupBy("symbol", *keys).agg(
        F.to_date(F.min("timestamp")).alias("start"), F.to_date(F.max("timestamp")).alias("end")
    )
    days = pl.calendar(spans, "daily").select("symbol", *keys, F.date_format("date", "yyyy-MM-dd").alias("period"))
    months = days.withColumn("period", F.substring("period", 1, 7)).distinct()
    return days.unionByName(months)


@add(
    "coverage_periods_metric",
    with_views(
        """
SELECT r.symbol, r.period, count(f."timestamp") AS row_count,
       coalesce(count(f."timestamp") >= 2 AND min(f."timestamp") <= r.d + INTERVAL 8 HOUR
           AND max(f."timestamp") >= r.e - INTERVAL 8 HOUR
           AND max(CASE WHEN prev >= r.d THEN date_diff('second', prev, f."timestamp") END) <= 28800, FALSE) AS complete
FROM (SELECT symbol, d, d + INTERVAL 1 DAY AS e, strftime(d, '%Y-%m-%d') AS period FROM (
          SELECT symbol, unnest(generate_series(date_trunc('day', min("timestamp")),
                 date_trunc('day', max("timestamp")), INTERVAL 1 DAY)) AS d FROM fr GROUP BY 1)
      UNION ALL SELECT symbol, d, d + INTERVAL 1 MONTH, strftime(d, '%Y-%m') FROM (
          SELECT symbol, unnest(generate_series(date_trunc('month', min("timestamp")),
                 date_trunc('month', max("timestamp")), INTERVAL 1 MONTH)) AS d FROM fr GROUP BY 1)) AS r
LEFT JOIN (SELECT *, lag("timestamp") OVER (PARTITION BY symbol ORDER BY "timestamp") AS prev FROM kept) AS f
  ON f.symbol = r.symbol AND f."timestamp" >= r.d AND f."timestamp" < r.e GROUP BY 1, 2, r.d, r.e
""",
        "fr",
        extra={"kept": "SELECT symbol, \"timestamp\" FROM fr WHERE dayofyear(\"timestamp\") % 9 <> 0 OR hour(\"timestamp\") <> 8"},
    ),
)
def coverage_periods_metric(spark, folder):
    """Days and months of stored funding rates with holes, inserted in two turns, from kept summaries alone."""
    root = scratch_path(spark, "rates")
    rates = materialise(views.funding_rates(spark, folder), "rates")
    holed = rates.where((F.dayofyear("timestamp") % 9 != 0) | (F.hour("timestamp") != 8))
    late = F.hour("timestamp") == 16
    tables.insert_new(spark, root, "funding_rates", holed.where(~late))
    tables.insert_new(spark, root, "funding_rates", holed.where(late))
    days = tables.read_coverage(spark, root, "funding_rates")
    found = pl.stored_period_status(_all_periods(rates), days, "funding_rates")
    return found.select("symbol", "period", "row_count", "complete")


@add("coverage_availability", with_views(AVAILABLE, "k1h", "holed", "oi", "fr"))
def coverage_availability(spark, folder):
    """First and last day of four stored tables and of the rows that these refuse, from summaries of days."""
    root = scratch_path(spark, "available")
    stored = {
        "spot": views.hourly_candles(spark, folder),
        "futures": views.holed_candles(spark, folder).where(F.col("symbol") != "VIEWUSDT"),
        "open_interest": views.open_interest(spark, folder),
        "funding_rates": views.funding_rates(spark, folder).where(F.col("symbol") != "ERRORUSDT"),
    }
    return coverage.availability_of_days(
        {name: _days_of(spark, root, name, rows) for name, rows in stored.items()}, "1h"
    )


def _days_of(spark, root, name, rows):
    """Summaries of days: kept ones of the rows that the table takes, fresh ones of the others (such
    as an open interest of zero), so that a refused row is neither stored nor left out."""
    rows = materialise(rows, name)
    refused = va.breaks_any_rule(name)
    tables.insert_new(spark, root, name, rows.where(~refused))
    fresh = coverage.day_summaries(rows.where(refused), name)
    if not tables.table_exists(spark, root, name):
        return fresh
    days = tables.read_coverage(spark, root, name)
    return days.unionByName(fresh.select(*days.columns))


@add(
    "export_csv",
    with_views(
        "SELECT \"timestamp\", open, close FROM k1h WHERE symbol = 'PURCHASEUSDT'", "k1h"
    ),
)
def export_csv(spark, folder):
    path = scratch_path(spark, "export")
    rows = views.hourly_candles(spark, folder).where(F.col("symbol") == "PURCHASEUSDT")
    tables.export(rows.select("timestamp", "open", "close"), path, "csv")
    return (
        spark.read.option("header", True)
        .schema("timestamp timestamp_ntz, open double, close double")
        .csv(path)
    )


REPORT_SQL = """
SELECT 'WARN' AS severity, 'spot' AS "table", symbol, 'import_dropped_duplicate_rows' AS check_name, count(*)
       || ' rows were handled during import before database insert' AS message, count(*) AS count
FROM k1h WHERE symbol <> 'ERRORUSDT' AND CAST(epoch("timestamp") AS BIGINT) // 3600 % 23 = 3
GROUP BY symbol, strftime("timestamp" - INTERVAL 1 SECOND, '%Y-%m-%d')
"""


@add("anomaly_findings", with_views(REPORT_SQL, "k1h"))
def anomaly_findings(spark, folder):
    path = scratch_path(spark, "anomalies")
    reports.append_anomalies(nz.normalise(candle_lines(spark, folder), "spot").anomalies, path)
    found = reports.anomaly_findings(spark, path, tables=["spot", "futures"])
    return found.select("severity", "table", "symbol", "check_name", "message", "count")


@add(
    "report_with_anomalies",
    with_views(
        f"""
SELECT severity, check_name, count(*) AS findings, CAST(sum(count) AS BIGINT) AS rows FROM (
    SELECT severity, check_name, count FROM ({REPORT_SQL})
    UNION ALL SELECT 'ERROR', 'time_gaps', count(*) FROM (
        SELECT *, lag("timestamp") OVER (PARTITION BY symbol ORDER BY "timestamp") AS prev FROM fr)
        WHERE date_diff('second', prev, "timestamp") > 28800 GROUP BY symbol
    UNION ALL SELECT 'WARN', 'funding_rate_extremes', count(*) FROM fr WHERE abs(funding_rate) > 0.01
        GROUP BY symbol
    UNION ALL SELECT 'WARN', 'funding_rate_distribution', count(*) FROM fr GROUP BY symbol
        HAVING count(*) >= 20 AND (abs(avg(funding_rate)) > 0.001 OR stddev_samp(funding_rate) > 0.01))
GROUP BY 1, 2
""",
        "k1h",
        "fr",
    ),
)
def report_with_anomalies(spark, folder):
    """A findings report and anomaly lines, written, read back together and rolled up."""
    report, lines = scratch_path(spark, "report"), scratch_path(spark, "anomalies")
    reports.write_findings(audit_funding_rates(views.funding_rates(spark, folder)), report)
    reports.append_anomalies(nz.normalise(candle_lines(spark, folder), "spot").anomalies, lines)
    loaded = reports.read_findings(spark, report, lines)
    return fd.rollup(loaded).drop("table")


# ---------------------------------------------------------------------------
# Streams
# ---------------------------------------------------------------------------
STREAMED_SQL = with_views(
    """
SELECT exchange, symbol, "interval", "timestamp", open, high, low, close, round(volume, 4) AS volume,
       round(quote_volume, 4) AS quote_volume, trades_count, round(taker_buy_base_volume, 4) AS taker_buy_base_volume,
       round(taker_buy_quote_volume, 4) AS taker_buy_quote_volume
FROM k1h
""",
    "k1h",
)
STREAMED_SUMS = ("volume", "quote_volume", "taker_buy_base_volume", "taker_buy_quote_volume")


def _trades(events):
    """Events as trades, in the columns that ``streaming_candles`` takes."""
    return events.where(F.col("value") > 0).select(
        "event_id",
        "ts",
        F.concat(F.upper("event_type"), F.lit(specs.QUOTE_ASSET)).alias("symbol"),
        "value",
        (1 + F.col("event_id") % 7).cast("double").alias("qty"),
        (F.col("event_id") % 2 == 0).alias("taker"),
    )


@add("stream_candles", STREAMED_SQL)
def stream_candles(spark, folder):
    """Events read as a stream give the candles that the three-day watermark has closed; the open
    ones are added from the table."""
    stored = spark.read.parquet(f"{folder}/events.parquet")
    # A pattern, since the table may be one file or a folder of files.
    arriving = spark.readStream.schema(stored.schema).parquet(f"{folder}/events.parquet*")
    closed = run_to_table(spark, streaming_candles(_trades(arriving)), "candles")
    return rounded(closed.unionByName(open_candles(_trades(stored))), *STREAMED_SUMS, digits=4)


@add("stream_candle_updates", STREAMED_SQL)
def stream_candle_updates(spark, folder):
    """Events arrive in two turns. The first leaves out every third event, so most candles in the
    table are open and wrong; the second brings these, and some events again, and corrects them."""
    inbox, root, state = (scratch_path(spark, x) for x in ("events", "updated", "update-state"))
    events = views.read_table(spark, folder, "events")
    late = F.col("event_id") % 3 == 0
    for turn in (events.where(~late), events.where(late | (F.col("event_id") % 11 == 0))):
        turn.write.mode("append").parquet(inbox)
        arriving = spark.readStream.schema(events.schema).parquet(inbox)
        candles = streaming_candles(_trades(arriving), lateness="60 days")
        store_updates(candles, root, "spot", state).awaitTermination()
    found = tables.read_table(spark, root, "spot").select(*specs.CANDLE_SCHEMA.fieldNames())
    return rounded(found, *STREAMED_SUMS, digits=4)


@add(
    "ingest_new_lines",
    with_views(
        'SELECT symbol, "timestamp", open, close, volume, trades_count FROM k1h WHERE symbol <> \'ERRORUSDT\'', "k1h"
    ),
)
def ingest_new_lines(spark, folder):
    """Daily archive lines arrive in a landing folder in two turns and are ingested after each by a
    stream that remembers what it has seen; unreadable files stay out and do not stop it."""
    inbox, root, state = (scratch_path(spark, x) for x in ("inbox", "ingested", "ingest-state"))
    lines = materialise(candle_lines(spark, folder), "lines")
    early = F.col("period") < "2024-02-15"
    for part in (lines.where(early), lines.where(~early)):
        archives.stage_lines(part, inbox)
        stream.ingest_new_lines(spark, inbox, root, "spot", state).awaitTermination()
    return tables.read_table(spark, root, "spot").select(
        "symbol", "timestamp", "open", "close", "volume", "trades_count"
    )


BUILT_SQL = f"""
SELECT k.symbol, k."timestamp", k.close FROM k1d AS k JOIN (
    SELECT symbol || 'USDT' AS symbol FROM uni
    WHERE "date" BETWEEN DATE '1996-02-01' AND DATE '1996-04-30' AND rank <= 6
    GROUP BY symbol HAVING NOT bool_or({IS_TAGGED})) USING (symbol)
WHERE k."timestamp" > TIMESTAMP '1996-02-01 00:00:00' AND k."timestamp" <= TIMESTAMP '1996-05-01 00:00:00'
"""


@add("build_warehouse", with_views(BUILT_SQL, "k1d", "uni"))
def build_warehouse(spark, folder):
    """The whole build over staged monthly archives of daily candles: first over a wider range, then
    over the wanted one, so that complete months are skipped and the candles outside pruned."""
    root = scratch_path(spark, "warehouse")
    rows = views.daily_candles(spark, folder)
    month = F.date_format(up.close_day("timestamp"), "yyyy-MM")
    close_ms = F.floor(epoch_micros("timestamp") / 1_000).cast("bigint") - 1
    made = {"open_time": close_ms - 86_399_999, "close_time": close_ms, "ignore": F.lit(0)}
    fields = [F.coalesce(made.get(n, F.col(n)).cast("string"), F.lit("")) for n in specs.CANDLE_FILE_COLUMNS]
    lines = rows.select(
        F.concat(F.concat_ws("-", "symbol", F.lit("1d"), month), F.lit(".csv")).alias("file"),
        close_ms.alias("line_no"),
        F.concat_ws(",", *fields).alias("line"),
    )
    lines = materialise(archives.with_file_parts(lines, "spot"), "lines")
    ranked = materialise(views.rankings(spark, folder), "rankings")
    dates = ranked.select("date").distinct()
    for start, end in (("1996-01-01", "1996-03-31"), ("1996-02-01", "1996-04-30")):
        warehouse.build_warehouse(
            spark, root, ranked, dates, {"spot": lines}, start, end, 6, intervals=["1d"], as_of="2000-01-01"
        )
    # Symbols of the first range alone keep what they have; those of the second are compared whole.
    wanted = un.symbol_superset(ranked, "1996-02-01", "1996-04-30", 6)
    stored = tables.read_table(spark, root, "spot", intervals=["1d"])
    return stored.join(wanted, "symbol", "left_semi").select("symbol", "timestamp", "close")
