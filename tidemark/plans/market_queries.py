"""Queries over candles and rankings: reports, resampling, point-in-time joins, gaps, repair."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import specs
from tidemark.functions.scalars import (
    carries_excluded_tag,
    is_excluded_symbol,
    pair_symbol,
    shift_seconds,
    tag_array,
)
from tidemark.operators import gaps as gp
from tidemark.operators import reconcile as rc
from tidemark.operators import repair as rp
from tidemark.operators import resample as rs
from tidemark.operators import universe as un
from tidemark.plans import views
from tidemark.plans.audit_queries import GAP_ROWS, METRIC_GAPS
from tidemark.plans.query import Registry, rounded
from tidemark.plans.view_sql import with_views
from tidemark.session import materialise

REGISTRY = Registry()
add = REGISTRY.add


# ---------------------------------------------------------------------------
# Reports over candles
# ---------------------------------------------------------------------------
@add(
    "symbol_counts",
    with_views(
        "SELECT symbol, count(*) AS nb_rows FROM dirty WHERE exchange = 'binance' "
        "AND \"interval\" = '1h' GROUP BY 1",
        "dirty",
    ),
)
def symbol_counts(spark, folder):
    return rs.symbol_counts(views.dirty_candles(spark, folder), "1h")


@add(
    "price_history",
    with_views(
        'SELECT "timestamp", open, high, low, close, volume FROM k1h WHERE symbol = \'CLICKUSDT\' '
        "AND \"timestamp\" >= TIMESTAMP '2024-01-15 00:00:00'",
        "k1h",
    ),
)
def price_history(spark, folder):
    return rs.price_history(views.hourly_candles(spark, folder), "CLICKUSDT", "1h", "2024-01-15")


def _resampled(width: str, interval: str, table: str, close: str | None = None) -> str:
    bucket = close or (
        f"time_bucket(INTERVAL '{width}', \"timestamp\" - INTERVAL 1 SECOND) + INTERVAL '{width}'"
    )
    return f"""
SELECT exchange, symbol, '{interval}' AS "interval", {bucket} AS "timestamp",
       arg_min(open, struct_pack(t := "timestamp", v := open)) AS open, max(high) AS high, min(low) AS low,
       arg_max(close, struct_pack(t := "timestamp", v := close)) AS close, round(sum(volume), 4) AS volume,
       round(sum(quote_volume), 4) AS quote_volume, CAST(sum(trades_count) AS INTEGER) AS trades_count,
       round(sum(taker_buy_base_volume), 4) AS taker_buy_base_volume,
       round(sum(taker_buy_quote_volume), 4) AS taker_buy_quote_volume
FROM {table} GROUP BY 1, 2, 3, 4
"""


_SUMS = ("volume", "quote_volume", "taker_buy_base_volume", "taker_buy_quote_volume")


@add("resample_4h", with_views(_resampled("4 hours", "4h", "k1h"), "k1h"))
def resample_4h(spark, folder):
    return rounded(rs.resample(views.hourly_candles(spark, folder), "4h", "1h"), *_SUMS, digits=4)


@add("resample_1d", with_views(_resampled("1 day", "1d", "k1h"), "k1h"))
def resample_1d(spark, folder):
    return rounded(rs.resample(views.hourly_candles(spark, folder), "1d", "1h"), *_SUMS, digits=4)


@add(
    "resample_1w",
    with_views(
        _resampled(
            "", "1w", "k1d", "date_trunc('week', \"timestamp\" - INTERVAL 1 SECOND) + INTERVAL 7 DAY"
        ),
        "k1d",
    ),
)
def resample_1w(spark, folder):
    return rounded(rs.resample(views.daily_candles(spark, folder), "1w", "1d"), *_SUMS, digits=4)


@add(
    "resample_1M",
    with_views(
        _resampled(
            "", "1M", "k1d", "date_trunc('month', \"timestamp\" - INTERVAL 1 SECOND) + INTERVAL 1 MONTH"
        ),
        "k1d",
    ),
)
def resample_month(spark, folder):
    return rounded(rs.resample(views.daily_candles(spark, folder), "1M", "1d"), *_SUMS, digits=4)


@add("resample_mixed_intervals", with_views(_resampled("1 day", "1d", "k1h"), "k1h"))
def resample_mixed_intervals(spark, folder):
    """A table of hourly and four-hour candles, with every hourly one there twice but for its open
    and close: only the hourly ones count, and copies are ordered by value."""
    hourly = views.hourly_candles(spark, folder)
    nothing = {c: F.lit(0.0) for c in ("volume", "quote_volume", "taker_buy_base_volume", "taker_buy_quote_volume")}
    copies = hourly.withColumns(
        nothing | {"open": F.col("open") + 1, "close": F.col("close") - 1, "trades_count": F.lit(0)}
    )
    both = hourly.unionByName(copies).unionByName(rs.resample(hourly, "4h", "1h"))
    return rounded(rs.resample(both, "1d", "1h"), *_SUMS, digits=4)


@add(
    "rolling_vol_with_copies",
    with_views(
        """
SELECT symbol, "timestamp", close, round(log_return, 6) AS log_return, round(stddev_samp(log_return) OVER (
           PARTITION BY symbol ORDER BY "timestamp", close ROWS 5 PRECEDING), 6) AS volatility
FROM (SELECT *, ln(close / lag(close) OVER (PARTITION BY symbol ORDER BY "timestamp", close)) AS log_return
      FROM (SELECT symbol, "timestamp", close FROM k1h
            UNION ALL SELECT symbol, "timestamp", close * 2 FROM k1h) WHERE close > 0)
""",
        "k1h",
    ),
)
def rolling_vol_with_copies(spark, folder):
    """Every candle twice, the copy at twice the price: copies of a time are ordered by close."""
    hourly = views.hourly_candles(spark, folder)
    both = hourly.unionByName(hourly.withColumn("close", F.col("close") * 2))
    found = rs.rolling_volatility(both, 6)
    return rounded(found.select("symbol", "timestamp", "close", "log_return", "volatility"), "log_return", "volatility")


@add(
    "vwap_daily",
    with_views(
        'SELECT exchange, symbol, "interval", CAST("timestamp" - INTERVAL 1 SECOND AS DATE) AS day, '
        "round(sum(quote_volume) / sum(volume), 6) AS vwap FROM k1h GROUP BY 1, 2, 3, 4",
        "k1h",
    ),
)
def vwap_daily(spark, folder):
    return rounded(rs.daily_vwap(views.hourly_candles(spark, folder)), "vwap")


@add(
    "rolling_vol",
    with_views(
        """
SELECT symbol, "timestamp", round(log_return, 6) AS log_return, round(stddev_samp(log_return) OVER (
           PARTITION BY symbol ORDER BY "timestamp" ROWS 23 PRECEDING), 6) AS volatility
FROM (SELECT *, ln(close / lag(close) OVER (PARTITION BY symbol ORDER BY "timestamp")) AS log_return
      FROM k1h WHERE close > 0)
""",
        "k1h",
    ),
)
def rolling_vol(spark, folder):
    found = rs.rolling_volatility(views.hourly_candles(spark, folder), 24)
    return rounded(
        found.select("symbol", "timestamp", "log_return", "volatility"), "log_return", "volatility"
    )


@add(
    "rolling_vol_wide",
    """
SELECT symbol, "timestamp", round(log_return, 6) AS log_return, round(stddev_samp(log_return) OVER (
           PARTITION BY symbol ORDER BY "timestamp" ROWS 9999 PRECEDING), 6) AS volatility
FROM (SELECT *, ln(close / lag(close) OVER (PARTITION BY symbol ORDER BY "timestamp")) AS log_return
      FROM (SELECT l_returnflag || 'USDT' AS symbol,
                   CAST(l_shipdate AS TIMESTAMP) + to_seconds((l_orderkey * 8 + l_linenumber) * 7919 % 86400) AS "timestamp",
                   max(l_extendedprice) AS close FROM lineitem GROUP BY 1, 2))
""",
)
def rolling_vol_wide(spark, folder):
    """10 000 rows a window over prices at times off any grid, many to a cadence step."""
    seconds = (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 7919 % 86_400
    prices = (
        views.read_table(spark, folder, "lineitem")
        .select(
            F.concat("l_returnflag", F.lit(specs.QUOTE_ASSET)).alias("symbol"),
            shift_seconds(F.col("l_shipdate").cast("timestamp_ntz"), seconds).alias("timestamp"),
            F.col("l_extendedprice").cast("double").alias("close"),
        )
        .groupBy("symbol", "timestamp")
        .agg(F.max("close").alias("close"))
        .withColumns({"exchange": F.lit(specs.EXCHANGE), "interval": F.lit("1d")})
    )
    found = rs.rolling_volatility(prices, 10_000)
    return rounded(found.select("symbol", "timestamp", "log_return", "volatility"), "log_return", "volatility")


@add(
    "interval_summary",
    with_views(
        'SELECT "interval", count(*) AS nb_candles, min("timestamp") AS first_date, '
        'max("timestamp") AS last_date FROM (SELECT "interval", "timestamp" FROM k1h '
        'UNION ALL SELECT "interval", "timestamp" FROM k1d) GROUP BY 1',
        "k1h",
        "k1d",
    ),
)
def interval_summary(spark, folder):
    both = views.hourly_candles(spark, folder).unionByName(views.daily_candles(spark, folder))
    return rs.interval_summary(both, ["1h", "1d"])


@add(
    "top_volume",
    with_views(
        """
SELECT symbol, round(sum(volume), 4) AS volume_24h, round(avg(close), 6) AS avg_price FROM k1d
WHERE "timestamp" >= (SELECT max("timestamp") FROM k1d) - INTERVAL 720 HOURS
GROUP BY 1 ORDER BY sum(volume) DESC, symbol LIMIT 10
""",
        "k1d",
    ),
)
def top_volume(spark, folder):
    found = rs.top_by_volume(views.daily_candles(spark, folder), "1d", hours=720)
    return found.select(
        "symbol",
        F.round("volume_24h", 4).alias("volume_24h"),
        F.round("avg_price", 6).alias("avg_price"),
    )


@add(
    "traded_symbols",
    with_views("SELECT symbol FROM k1h UNION SELECT symbol FROM k1d", "k1h", "k1d"),
)
def traded_symbols(spark, folder):
    return rs.traded_symbols(
        {"spot": views.hourly_candles(spark, folder), "futures": views.daily_candles(spark, folder)}
    )


@add(
    "table_scan",
    with_views(
        "SELECT * FROM k1h WHERE symbol IN ('VIEWUSDT', 'ERRORUSDT') AND \"interval\" = '1h'", "k1h"
    ),
)
def table_scan(spark, folder):
    return gp.scan(views.hourly_candles(spark, folder), ["VIEWUSDT", "ERRORUSDT"], ["1h"], "binance")


# ---------------------------------------------------------------------------
# Rankings
# ---------------------------------------------------------------------------
EXCLUDED = ", ".join(f"'{t}'" for t in specs.EXCLUDED_TAGS)
IS_TAGGED = (
    "len(list_intersect(list_transform(string_split(coalesce(tags, ''), ','), "
    f"lambda t: lower(trim(t))), [{EXCLUDED}])) > 0"
)


@add(
    "symbol_superset",
    with_views(
        f"""
SELECT symbol || 'USDT' AS symbol FROM uni
WHERE "date" BETWEEN DATE '1996-01-01' AND DATE '1996-06-30' AND rank <= 5
GROUP BY symbol HAVING NOT bool_or({IS_TAGGED}) AND upper(symbol) NOT IN ('NATION3')
""",
        "uni",
    ),
)
def symbol_superset(spark, folder):
    return un.symbol_superset(
        views.rankings(spark, folder), "1996-01-01", "1996-06-30", 5, exclude_symbols=["nation3"]
    )


@add(
    "universe_exclusions",
    with_views(
        f"""
SELECT "date", symbol, symbol || 'USDT' AS pair,
       CASE WHEN {IS_TAGGED} THEN 'tag' WHEN upper(symbol) IN ('NATION2', 'NATION7') THEN 'symbol' END
           AS exclusion FROM uni
""",
        "uni",
    ),
)
def universe_exclusions(spark, folder):
    marked = un.with_exclusion(views.rankings(spark, folder), None, ["Nation2", "NATION7"])
    return marked.select("date", "symbol", pair_symbol("symbol").alias("pair"), "exclusion")


@add(
    "universe_kept_rows",
    with_views(
        f"SELECT provider_id, \"date\" FROM uni WHERE NOT ({IS_TAGGED}) "
        "AND upper(symbol) NOT IN ('NATION4')",
        "uni",
    ),
)
def universe_kept_rows(spark, folder):
    drop = carries_excluded_tag(tag_array("tags")) | is_excluded_symbol("symbol", ["nation4"])
    return views.rankings(spark, folder).where(~drop).select("provider_id", "date")


@add(
    "rank_history",
    with_views(
        "SELECT \"date\", symbol, rank, market_cap FROM uni WHERE symbol = 'NATION5' "
        "AND \"date\" >= DATE '1995-01-01' AND rank <= 10",
        "uni",
    ),
)
def rank_history(spark, folder):
    return un.rank_history(views.rankings(spark, folder), "NATION5", 10, "1995-01-01")


@add(
    "pit_join_month",
    with_views(
        """
SELECT u."date", u.symbol, u.rank, u.market_cap, s."timestamp", s.close, s.volume
FROM uni AS u JOIN k1d AS s ON u.symbol || 'USDT' = s.symbol
 AND u."date" = CAST(date_trunc('month', s."timestamp" - INTERVAL 1 SECOND) AS DATE)
""",
        "uni",
        "k1d",
    ),
)
def pit_join_month(spark, folder):
    return un.join_month_snapshot(views.rankings(spark, folder), views.daily_candles(spark, folder))


@add(
    "asof_universe",
    with_views(
        """
SELECT d.day, d.snapshot, u.symbol, u.rank, u.market_cap, s."timestamp", s.close, s.volume
FROM (SELECT *, CAST("timestamp" - INTERVAL 1 SECOND AS DATE) AS day FROM k1d) AS s
JOIN (SELECT t.day, max(c."date") AS snapshot
      FROM (SELECT DISTINCT CAST("timestamp" - INTERVAL 1 SECOND AS DATE) AS day FROM k1d) AS t
      JOIN (SELECT DISTINCT "date" FROM uni) AS c ON c."date" <= t.day - 1 GROUP BY 1) AS d
  ON d.day = s.day
JOIN uni AS u ON u."date" = d.snapshot AND u.symbol || 'USDT' = s.symbol
""",
        "uni",
        "k1d",
    ),
)
def asof_universe(spark, folder):
    return un.join_latest_snapshot(views.rankings(spark, folder), views.daily_candles(spark, folder))


STITCH_SQL = """
SELECT CASE WHEN symbol = 'CLICKUSDT' AND "timestamp" <= TIMESTAMP '2024-01-10 00:00:00' THEN 'TAPUSDT'
            WHEN symbol = 'VIEWUSDT' AND "timestamp" > TIMESTAMP '2024-01-10 00:00:00' THEN 'TAPUSDT'
            ELSE symbol END AS symbol, count(*) AS n, min("timestamp") AS first_close,
       max("timestamp") AS last_close, round(sum(quote_volume), 4) AS quote_volume
FROM k1h GROUP BY 1
"""


@add("stitch_renamed", with_views(STITCH_SQL, "k1h"))
def stitch_renamed(spark, folder):
    names = spark.createDataFrame(
        [
            ("CLICKUSDT", "TAPUSDT", None, "2024-01-10 00:00:00"),
            ("VIEWUSDT", "TAPUSDT", "2024-01-10 00:00:00", None),
        ],
        "symbol string, canonical string, valid_from string, valid_to string",
    ).withColumns(
        {
            "valid_from": F.col("valid_from").cast("timestamp_ntz"),
            "valid_to": F.col("valid_to").cast("timestamp_ntz"),
        }
    )
    stitched = un.stitch_renamed(views.hourly_candles(spark, folder), names)
    return stitched.groupBy("symbol").agg(
        F.count("*").alias("n"),
        F.min("timestamp").alias("first_close"),
        F.max("timestamp").alias("last_close"),
        F.round(F.sum("quote_volume"), 4).alias("quote_volume"),
    )


RENAMED = """
SELECT provider_id, "date",
       CASE WHEN "date" >= DATE '1996-01-01' AND provider_id % 4 = 0 THEN symbol || 'NEW' ELSE symbol END
           AS symbol FROM uni
"""


@add(
    "renames",
    with_views(
        f"""
SELECT 'coinmarketcap' AS provider, provider_id, "date", prev AS old_symbol, symbol AS new_symbol
FROM (SELECT *, lag(symbol) OVER (PARTITION BY provider_id ORDER BY "date") AS prev FROM ({RENAMED}))
WHERE symbol <> prev
""",
        "uni",
    ),
)
def renames(spark, folder):
    """Rankings in which every fourth asset changes its name."""
    changed = (F.col("date") >= F.lit("1996-01-01").cast("date")) & (F.col("provider_id") % 4 == 0)
    renamed = views.rankings(spark, folder).withColumn(
        "symbol", F.when(changed, F.concat("symbol", F.lit("NEW"))).otherwise(F.col("symbol"))
    )
    return un.renames(renamed)


# Ticker of an asset on a date: a chain of three names, a ticker given up and later taken by another asset.
TICKER = """
CASE WHEN {id} % 4 = 0 AND {day} < DATE '1994-01-01' THEN {symbol} || 'A'
     WHEN {id} % 4 = 0 AND {day} < DATE '1996-01-01' THEN {symbol} || 'B'
     WHEN {id} % 4 = 0 THEN {symbol} || 'C'
     WHEN {id} % 4 = 1 AND {day} < DATE '1995-01-01' THEN 'TICK' || CAST(({id} - {id} % 4) AS VARCHAR(9))
     WHEN {id} % 4 = 2 AND {day} >= DATE '1997-01-01' THEN 'TICK' || CAST(({id} - {id} % 4) AS VARCHAR(9))
     ELSE {symbol} END
"""
RANKED_NAMES = f"""SELECT provider_id, "date", rank, {TICKER.format(id="provider_id", day='"date"', symbol="symbol")} AS symbol FROM uni"""
TRADED_NAMES = f"""
SELECT {TICKER.format(id="(n_nationkey + 1)", day='CAST("timestamp" - INTERVAL 1 SECOND AS DATE)', symbol="replace(symbol, 'USDT', '')")}
       || 'USDT' AS symbol, "timestamp", quote_volume
FROM k1d JOIN nation ON symbol = replace(upper(n_name), '_', '') || 'USDT'
"""
OWNERS = """
SELECT symbol, provider_id, CASE WHEN nth > 1 THEN "date" END AS valid_from,
       lead("date") OVER (PARTITION BY symbol ORDER BY "date") AS valid_to
FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY "date") AS nth,
             lag(provider_id) OVER (PARTITION BY symbol ORDER BY "date") AS before
      FROM (SELECT symbol, "date", provider_id FROM ranked
            QUALIFY row_number() OVER (PARTITION BY symbol, "date" ORDER BY rank, provider_id) = 1))
WHERE before IS NULL OR before <> provider_id
"""
NEWEST = """
SELECT n.provider_id, CASE WHEN o.provider_id = n.provider_id THEN n.symbol
                           ELSE n.symbol || '.' || CAST(n.provider_id AS VARCHAR) END AS canonical
FROM (SELECT provider_id, symbol FROM ranked
      QUALIFY row_number() OVER (PARTITION BY provider_id ORDER BY "date" DESC, symbol DESC) = 1) AS n
LEFT JOIN owners AS o ON o.symbol = n.symbol AND o.valid_to IS NULL
"""


@add(
    "stitch_from_rankings",
    with_views(
        """
SELECT coalesce(w.canonical || 'USDT', t.symbol) AS symbol, count(*) AS n, min(t."timestamp") AS first_close,
       max(t."timestamp") AS last_close, round(sum(t.quote_volume), 2) AS quote_volume
FROM traded AS t
LEFT JOIN owners AS o ON t.symbol = o.symbol || 'USDT' AND (o.valid_from IS NULL OR t."timestamp" > o.valid_from)
                     AND (o.valid_to IS NULL OR t."timestamp" <= o.valid_to)
LEFT JOIN newest AS w ON w.provider_id = o.provider_id
GROUP BY 1
""",
        "uni",
        "k1d",
        extra={"ranked": RANKED_NAMES, "traded": TRADED_NAMES, "owners": OWNERS, "newest": NEWEST},
    ),
)
def stitch_from_rankings(spark, folder):
    """Candles traded under the ticker of their day, put under one symbol an asset by the rankings."""
    ranked = views.rankings(spark, folder).withColumn("symbol", F.expr(TICKER.format(id="provider_id", day='date', symbol="symbol")))
    nations = views.read_table(spark, folder, "nation").select(
        (F.col("n_nationkey") + 1).cast("bigint").alias("_id"),
        F.concat(F.regexp_replace(F.upper("n_name"), "_", ""), F.lit(specs.QUOTE_ASSET)).alias("symbol"),
    )
    ticker = TICKER.format(id="_id", day="to_date(timestamp - interval 1 second)", symbol="replace(symbol, 'USDT', '')")
    traded = (
        views.daily_candles(spark, folder)
        .join(nations, "symbol")
        .withColumn("symbol", F.concat(F.expr(ticker), F.lit(specs.QUOTE_ASSET)))
        .drop("_id")
    )
    return un.stitch_renamed(traded, un.names_from_rankings(ranked)).groupBy("symbol").agg(
        F.count("*").alias("n"),
        F.min("timestamp").alias("first_close"),
        F.max("timestamp").alias("last_close"),
        F.round(F.sum("quote_volume"), 2).alias("quote_volume"),
    )


SNAPSHOT_SQL = f"""
SELECT provider_id, "date", symbol, rank, market_cap FROM (
    SELECT *, row_number() OVER (PARTITION BY provider, provider_id, "date" ORDER BY rank NULLS LAST,
                                 market_cap DESC NULLS LAST) AS nth
    FROM duni WHERE NOT ({IS_TAGGED}) AND upper(symbol) NOT IN ('NATION9')) AS r
WHERE nth = 1 AND "date" NOT IN (SELECT "date" FROM bad)
"""
BAD_DATES = f"""
SELECT DISTINCT "date" FROM (
    SELECT DISTINCT provider_id, "date", rank FROM duni
    WHERE NOT ({IS_TAGGED}) AND upper(symbol) NOT IN ('NATION9'))
GROUP BY "date", rank HAVING count(*) > 1 OR rank < 1
"""


@add("snapshot_build", with_views(SNAPSHOT_SQL, "duni", extra={"bad": BAD_DATES}))
def snapshot_build(spark, folder):
    listings = views.dirty_rankings(spark, folder)
    build = un.build_snapshots(listings, listings.select("date"), None, ["nation9"])
    return build.rows.select("provider_id", "date", "symbol", "rank", "market_cap")


@add(
    "snapshot_failed_dates",
    with_views(
        "SELECT \"date\", 'validation_failed' AS reason FROM bad "
        "UNION ALL SELECT DATE '2031-01-01', 'no_listings'",
        "duni",
        extra={"bad": BAD_DATES},
    ),
)
def snapshot_failed_dates(spark, folder):
    listings = views.dirty_rankings(spark, folder)
    asked = listings.select("date").union(
        spark.range(1).select(F.lit("2031-01-01").cast("date").alias("date"))
    )
    return un.build_snapshots(listings, asked, None, ["nation9"]).failed_dates


# ---------------------------------------------------------------------------
# Gaps and repair
# ---------------------------------------------------------------------------
def gap_list_sql(table: str) -> str:
    return f"""
SELECT 'spot' AS "table", symbol, "interval", prev AS prev_close, "timestamp" AS next_close,
       CAST(expected_seconds AS BIGINT) AS expected_seconds FROM ({GAP_ROWS.format(table=table)})
"""


@add("gap_list_kline", with_views(gap_list_sql("holed"), "holed", "cadence"))
def gap_list_kline(spark, folder):
    return gp.candle_gaps(views.holed_candles(spark, folder))


@add(
    "gap_list_metric",
    with_views(
        "SELECT 'open_interest' AS \"table\", symbol, CAST(NULL AS VARCHAR) AS \"interval\", "
        'prev AS prev_close, "timestamp" AS next_close, CAST(300 AS BIGINT) AS expected_seconds '
        f"FROM ({METRIC_GAPS.format(table='oi', step=300)})",
        "oi",
    ),
)
def gap_list_metric(spark, folder):
    return gp.metric_gaps(views.open_interest(spark, folder), "open_interest")


@add(
    "gap_missing_keys",
    with_views(
        """
SELECT symbol, "interval", unnest(generate_series(prev_close + INTERVAL 1 HOUR,
       next_close - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS "timestamp" FROM gaps
""",
        "holed",
        "cadence",
        extra={"gaps": gap_list_sql("holed")},
    ),
)
def gap_missing_keys(spark, folder):
    found = gp.missing_keys(gp.candle_gaps(views.holed_candles(spark, folder)))
    return found.select("symbol", "interval", "timestamp")


# The source lacks every thirteenth hour and has a broken high where the hour is 7 mod 41.
SOURCE = """
SELECT * REPLACE (CASE WHEN h % 41 = 7 THEN low * 0.5 ELSE high END AS high) FROM (
    SELECT *, CAST(epoch("timestamp") AS BIGINT) // 3600 AS h FROM k1h) WHERE h % 13 <> 1
"""
GUARDED = f"""
SELECT *, (epoch_ms(prev_close) % 3600000 <> 0 OR epoch_ms(next_close) % 3600000 <> 0) AS off_grid,
       date_diff('hour', prev_close, next_close) - 1 AS expected_missing
FROM ({gap_list_sql('target')})
"""
REPAIR_CTES = {
    "target": """
SELECT * REPLACE (CASE WHEN CAST(epoch("timestamp") AS BIGINT) // 3600 % 53 = 5
                       THEN "timestamp" + INTERVAL 17 SECOND ELSE "timestamp" END AS "timestamp")
FROM holed""",
    "source": SOURCE,
    "guarded": GUARDED,
    "fetched": """
SELECT g.symbol, g.prev_close, count(*) AS filled, bool_or(s.high < s.low OR s.high < s.open
       OR s.high < s.close) AS broken
FROM guarded AS g JOIN source AS s ON s.symbol = g.symbol AND s."interval" = g."interval"
 AND s."timestamp" > g.prev_close AND s."timestamp" < g.next_close
WHERE NOT off_grid GROUP BY 1, 2""",
    "outcomes": """
SELECT g.symbol, g.prev_close, g.next_close, g.expected_missing,
       CASE WHEN off_grid OR coalesce(broken, FALSE) THEN expected_missing
            ELSE expected_missing - coalesce(filled, 0) END AS missing_count,
       CASE WHEN off_grid OR coalesce(broken, FALSE) THEN 'network_error'
            WHEN expected_missing = coalesce(filled, 0) THEN 'repaired' ELSE 'partial_fill' END AS outcome
FROM guarded AS g LEFT JOIN fetched AS f USING (symbol, prev_close)""",
}


def _hour():
    return (F.unix_seconds(F.col("timestamp").cast("timestamp")) / 3_600).cast("bigint")


def _repair_inputs(spark, folder):
    moved = F.when(_hour() % 53 == 5, shift_seconds("timestamp", 17)).otherwise(F.col("timestamp"))
    target = views.holed_candles(spark, folder).withColumn("timestamp", moved)
    source = (
        views.hourly_candles(spark, folder)
        .where(_hour() % 13 != 1)
        .withColumn(
            "high", F.when(_hour() % 41 == 7, F.col("low") * 0.5).otherwise(F.col("high"))
        )
    )
    return target, source


# Off-grid bounds are no whole number of hours apart, hence the span in seconds.
OUTCOME_SQL = """
SELECT symbol, prev_close, next_close, CAST(greatest(0, date_diff('second', prev_close, next_close)
       // 3600 - 1) AS BIGINT) AS expected_missing,
       CASE WHEN outcome = 'network_error' THEN CAST(greatest(0,
           date_diff('second', prev_close, next_close) // 3600 - 1) AS BIGINT)
            ELSE missing_count END AS missing_count, outcome FROM outcomes
"""


@add("repair_outcomes", with_views(OUTCOME_SQL, "holed", "k1h", "cadence", extra=REPAIR_CTES))
def repair_outcomes(spark, folder):
    target, source = _repair_inputs(spark, folder)
    return rp.repair(target, source, "spot").outcomes.select(
        "symbol", "prev_close", "next_close", "expected_missing", "missing_count", "outcome"
    )


@add(
    "repair_rows",
    with_views(
        """
SELECT s.symbol, s."timestamp", s.open, s.high, s.low, s.close FROM source AS s
JOIN outcomes AS o ON o.symbol = s.symbol AND s."timestamp" > o.prev_close
 AND s."timestamp" < o.next_close
WHERE o.outcome <> 'network_error' AND NOT EXISTS (
    SELECT 1 FROM target AS t WHERE t.symbol = s.symbol AND t."timestamp" = s."timestamp")
""",
        "holed",
        "k1h",
        "cadence",
        extra=REPAIR_CTES,
    ),
)
def repair_rows(spark, folder):
    target, source = _repair_inputs(spark, folder)
    return rp.repair(target, source, "spot").rows.select(
        "symbol", "timestamp", "open", "high", "low", "close"
    )


@add(
    "repair_report",
    with_views(
        f"""
SELECT 'spot' AS "table", count(*) AS gaps_processed,
       count(*) FILTER (WHERE outcome = 'repaired') AS gaps_fully_repaired,
       count(*) FILTER (WHERE outcome = 'partial_fill') AS gaps_partial,
       count(*) FILTER (WHERE outcome = 'network_error') AS gaps_failed,
       CAST(sum(missing_count) AS BIGINT) AS rows_still_missing FROM ({OUTCOME_SQL})
""",
        "holed",
        "k1h",
        "cadence",
        extra=REPAIR_CTES,
    ),
)
def repair_report(spark, folder):
    target, source = _repair_inputs(spark, folder)
    return rp.repair_report(rp.repair(target, source, "spot").outcomes)


@add(
    "repair_unrecoverable",
    with_views(
        f"SELECT symbol, prev_close, next_close, missing_count, outcome AS reason FROM ({OUTCOME_SQL}) "
        "WHERE outcome <> 'repaired'",
        "holed",
        "k1h",
        "cadence",
        extra=REPAIR_CTES,
    ),
)
def repair_unrecoverable(spark, folder):
    target, source = _repair_inputs(spark, folder)
    left = rp.unrecoverable(rp.repair(target, source, "spot").outcomes)
    return left.select("symbol", "prev_close", "next_close", "missing_count", "reason")


@add(
    "repair_guards",
    with_views(
        """
SELECT symbol, prev_close, next_close,
       CAST(greatest(0, date_diff('second', prev_close, next_close) // 3600 - 1) AS BIGINT)
           AS expected_missing, off_grid,
       NOT off_grid AND date_diff('second', prev_close, next_close) // 3600 - 1 > 1000 AS too_large
FROM guarded
""",
        "holed",
        "cadence",
        extra={k: REPAIR_CTES[k] for k in ("target", "guarded")},
    ),
)
def repair_guards(spark, folder):
    target, _ = _repair_inputs(spark, folder)
    return rp.with_guards(gp.candle_gaps(target), specs.REPAIR_ROW_LIMITS).select(
        "symbol", "prev_close", "next_close", "expected_missing", "off_grid", "too_large"
    )


@add(
    "repair_wide_gap",
    with_views(
        """
SELECT s.symbol, s."timestamp", s.close FROM minutes AS s JOIN edges AS e USING (symbol)
WHERE s."timestamp" > e.low AND s."timestamp" < e.high
""",
        extra={
            "minutes": """
SELECT symbol, "timestamp", close FROM (
    SELECT upper(event_type) || 'USDT' AS symbol, time_bucket(INTERVAL '1 minute', ts) + INTERVAL '1 minute' AS "timestamp",
           max(value) AS close FROM events WHERE value > 0 GROUP BY 1, 2)
""",
            "edges": 'SELECT symbol, min("timestamp") AS low, max("timestamp") AS high FROM minutes GROUP BY 1',
        },
    ),
)
def repair_wide_gap(spark, folder):
    """One-minute candles of which only the first and last are stored: gaps of tens of thousands
    of rows, far beyond any page of a source, are filled with all that the source has."""
    ends = views.bucket_end("ts", 60)
    minutes = (
        views.read_table(spark, folder, "events")
        .where(F.col("value") > 0)
        .groupBy(F.concat(F.upper("event_type"), F.lit("USDT")).alias("symbol"), ends.alias("timestamp"))
        .agg(F.max("value").alias("close"))
    )
    price = {c: F.col("close") for c in ("open", "high", "low", "volume", "quote_volume")}
    takers = {c: F.lit(0.0) for c in ("taker_buy_base_volume", "taker_buy_quote_volume")}
    fixed = {"exchange": F.lit("binance"), "interval": F.lit("1m"), "trades_count": F.lit(1)}
    source = minutes.withColumns(price | takers | fixed).select(*specs.CANDLE_SCHEMA.fieldNames())
    edges = source.groupBy("symbol").agg(F.min("timestamp").alias("begin"), F.max("timestamp").alias("end"))
    at_edge = (F.col("timestamp") == F.col("begin")) | (F.col("timestamp") == F.col("end"))
    target = source.join(edges, "symbol").where(at_edge).drop("begin", "end")
    return rp.repair(target, source, "spot").rows.select("symbol", "timestamp", "close")


FUNDING_SOURCE = """
SELECT 'binance' AS exchange, symbol, time_bucket(INTERVAL '8 hours', ts) + INTERVAL '8 hours'
       AS "timestamp", round((avg(value) - 50) / 1000 + 3e-10, 6) AS funding_rate
FROM (SELECT ts, value, CASE WHEN event_type = 'view' THEN '1000VIEWUSDT'
                             ELSE upper(event_type) || 'USDT' END AS symbol FROM events)
GROUP BY 1, 2, 3
"""
FUNDING_GAPS = f"SELECT * FROM ({METRIC_GAPS.format(table='fr', step=28_800)})"


def _funding_source(spark, folder):
    symbol = F.when(F.col("event_type") == "view", "1000VIEWUSDT").otherwise(
        F.concat(F.upper("event_type"), F.lit("USDT"))
    )
    return (
        views.read_table(spark, folder, "events")
        .select(symbol.alias("symbol"), views.bucket_end("ts", 28_800).alias("timestamp"), "value")
        .groupBy("symbol", "timestamp")
        .agg(views.mean_rate().alias("funding_rate"))
        .select(F.lit("binance").alias("exchange"), "symbol", "timestamp", "funding_rate")
    )


@add(
    "repair_prefixed_rows",
    with_views(
        """
SELECT s.symbol, s."timestamp", s.funding_rate FROM gaps AS g JOIN source AS s
  ON s.symbol = CASE WHEN g.symbol = 'VIEWUSDT' THEN '1000VIEWUSDT' ELSE g.symbol END
 AND s."timestamp" > g.prev AND s."timestamp" < g."timestamp"
""",
        "fr",
        extra={"gaps": FUNDING_GAPS, "source": FUNDING_SOURCE},
    ),
)
def repair_prefixed_rows(spark, folder):
    """Funding repair from a source that knows one symbol under its prefixed name only."""
    fixed = rp.repair(
        views.funding_rates(spark, folder), _funding_source(spark, folder), "funding_rates"
    )
    return fixed.rows.select("symbol", "timestamp", "funding_rate")


@add(
    "repair_prefixed_outcomes",
    with_views(
        """
SELECT g.symbol, g.prev AS prev_close, g."timestamp" AS next_close,
       CASE WHEN g.symbol <> 'VIEWUSDT' AND count(s."timestamp") = date_diff('second', g.prev,
                g."timestamp") // 28800 - 1 THEN 'repaired' ELSE 'partial_fill' END AS outcome
FROM gaps AS g LEFT JOIN source AS s ON s.symbol = g.symbol AND s."timestamp" > g.prev
 AND s."timestamp" < g."timestamp" GROUP BY 1, 2, 3
""",
        "fr",
        extra={"gaps": FUNDING_GAPS, "source": FUNDING_SOURCE},
    ),
)
def repair_prefixed_outcomes(spark, folder):
    fixed = rp.repair(
        views.funding_rates(spark, folder), _funding_source(spark, folder), "funding_rates"
    )
    return fixed.outcomes.select("symbol", "prev_close", "next_close", "outcome")


@add(
    "trailing_rows",
    with_views(
        """
SELECT s.symbol, s."timestamp", s.close FROM k1h AS s
WHERE s."timestamp" > (SELECT max("timestamp") FROM k1h) - INTERVAL 3 DAYS AND NOT EXISTS (
    SELECT 1 FROM holed AS t WHERE t.symbol = s.symbol AND t."timestamp" = s."timestamp")
""",
        "k1h",
        "holed",
    ),
)
def trailing_rows(spark, folder):
    found = rp.trailing_rows(
        views.hourly_candles(spark, folder), views.holed_candles(spark, folder), "spot"
    )
    return found.select("symbol", "timestamp", "close")


# ---------------------------------------------------------------------------
# Reconciliation and samples
# ---------------------------------------------------------------------------
COPY_CTES = {
    "copied": """
SELECT * REPLACE (CASE WHEN h % 29 = 3 THEN close * 1.01 ELSE close END AS close,
                  CASE WHEN h % 31 = 4 THEN volume * 1.001 WHEN h % 31 = 9 THEN volume * 1.00001
                       ELSE volume END AS volume,
                  CASE WHEN h % 37 = 5 THEN NULL WHEN h % 37 = 6 THEN trades_count + 1
                       ELSE trades_count END AS trades_count)
FROM (SELECT *, CAST(epoch("timestamp") AS BIGINT) // 3600 AS h FROM k1h) WHERE h % 43 <> 7""",
    "both_sides": """
SELECT coalesce(a.symbol, b.symbol) AS symbol, coalesce(a."timestamp", b."timestamp") AS "timestamp",
       a.symbol IS NULL AS no_a, b.symbol IS NULL AS no_b, a.close AS ac, b.close AS bc,
       a.volume AS av, b.volume AS bv, a.trades_count AS stored_n, b.trades_count AS source_n
FROM holed AS a FULL JOIN copied AS b ON a.symbol = b.symbol AND a."timestamp" = b."timestamp" """,
}
RECONCILE_SQL = """
SELECT symbol, "timestamp", 'row' AS field, 'missing_in_source' AS kind FROM both_sides WHERE no_b
UNION ALL SELECT symbol, "timestamp", 'row', 'missing_in_stored' FROM both_sides WHERE no_a
UNION ALL SELECT symbol, "timestamp", 'close', 'mismatch' FROM both_sides WHERE abs(ac - bc) > 1e-8
UNION ALL SELECT symbol, "timestamp", 'volume', 'mismatch' FROM both_sides
          WHERE abs(av - bv) / abs(bv) > 1e-4
UNION ALL SELECT symbol, "timestamp", 'trades_count', 'mismatch' FROM both_sides WHERE stored_n <> source_n
"""


def _copied(spark, folder):
    """A source with changed, missing and NULL fields."""
    hour = _hour()
    return (
        views.hourly_candles(spark, folder)
        .where(hour % 43 != 7)
        .withColumns(
            {
                "close": F.when(hour % 29 == 3, F.col("close") * 1.01).otherwise(F.col("close")),
                "volume": F.when(hour % 31 == 4, F.col("volume") * 1.001)
                .when(hour % 31 == 9, F.col("volume") * 1.00001)
                .otherwise(F.col("volume")),
                "trades_count": F.when(hour % 37 == 5, F.lit(None))
                .when(hour % 37 == 6, F.col("trades_count") + 1)
                .otherwise(F.col("trades_count")),
            }
        )
    )


def _reconciled(spark, folder, compare):
    found = compare(
        views.holed_candles(spark, folder),
        _copied(spark, folder),
        ["exchange", "symbol", "interval", "timestamp"],
        rc.CANDLE_TOLERANCES,
    )
    return found.select("symbol", "timestamp", "field", "kind")


@add("reconcile_candles", with_views(RECONCILE_SQL, "k1h", "holed", extra=COPY_CTES))
def reconcile_candles(spark, folder):
    """Stored candles with holes against a source with changed, missing and NULL fields."""
    return _reconciled(spark, folder, rc.reconcile)


@add("reconcile_by_day", with_views(RECONCILE_SQL, "k1h", "holed", extra=COPY_CTES))
def reconcile_by_day(spark, folder):
    """The same, where only series and days with differing digests meet row by row."""
    return _reconciled(spark, folder, rc.reconcile_by_day)


@add(
    "canonical_listing",
    with_views(
        """
SELECT "date", symbol, provider_id, rank, market_cap FROM (
    SELECT *, row_number() OVER (PARTITION BY "date", symbol ORDER BY rank NULLS LAST,
               market_cap DESC NULLS LAST) AS nth FROM duni) WHERE nth = 1
""",
        "duni",
    ),
)
def canonical_listing(spark, folder):
    found = rc.canonical_listing(views.dirty_rankings(spark, folder))
    return found.select("date", "symbol", "provider_id", "rank", "market_cap")


@add(
    "open_times",
    with_views(
        'SELECT symbol, "timestamp", epoch_ms("timestamp") - 3600000 AS open_time_ms FROM k1h', "k1h"
    ),
)
def open_times(spark, folder):
    found = rc.open_times(views.hourly_candles(spark, folder))
    return found.select("symbol", "timestamp", "open_time_ms")


@add(
    "reconcile_skipped",
    with_views(
        """
SELECT unnest(['open', 'high', 'low', 'close', 'volume', 'quote_volume', 'trades_count']) AS field,
       unnest([0, 0, 0, 0, 0, 0, (SELECT count(*) FROM both_sides WHERE NOT no_a AND NOT no_b AND source_n IS NULL)])::BIGINT AS skipped
""",
        "k1h",
        "holed",
        extra=COPY_CTES,
    ),
)
def reconcile_skipped(spark, folder):
    """Fields that could not be compared, over a source of which every row is there twice."""
    hour = _hour()
    source = (
        views.hourly_candles(spark, folder)
        .where(hour % 43 != 7)
        .withColumn("trades_count", F.when(hour % 37 != 5, F.col("trades_count")))
    )
    keys = ["exchange", "symbol", "interval", "timestamp"]
    stored = views.holed_candles(spark, folder)
    return rc.skipped(stored, source.unionByName(source), keys, rc.CANDLE_TOLERANCES)


SAMPLE_HASH = """('0x' || substr(md5(concat_ws('|', '{seed}', exchange, symbol, "interval",
    epoch_us("timestamp")::VARCHAR)), 1, 10))::BIGINT"""


@add(
    "random_sample",
    with_views(
        f"""
SELECT symbol, "timestamp", close FROM k1h ORDER BY {SAMPLE_HASH.format(seed=7)}, symbol, "timestamp" LIMIT 100
""",
        "k1h",
    ),
)
def random_sample(spark, folder):
    """A sample of 100 rows by hash of the key."""
    return rc.random_rows(views.hourly_candles(spark, folder), 100, seed=7).select("symbol", "timestamp", "close")


@add(
    "stratified_sample",
    with_views(
        f"""
SELECT symbol, "timestamp", close FROM (
    SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY {SAMPLE_HASH.format(seed=3)}, "timestamp") AS pos FROM k1h)
JOIN (SELECT symbol, least(n, target // symbols + CASE WHEN nth <= target % symbols THEN 1 ELSE 0 END) AS take FROM (
    SELECT symbol, n, CAST(floor(sum(n) OVER () * 0.1) AS BIGINT) AS target, count(*) OVER () AS symbols,
           row_number() OVER (ORDER BY ('0x' || substr(md5('4|' || symbol), 1, 10))::BIGINT) AS nth
    FROM (SELECT symbol, count(*) AS n FROM k1h GROUP BY 1))) USING (symbol)
WHERE pos <= take
""",
        "k1h",
    ),
)
def stratified_sample(spark, folder):
    """A tenth of all rows, split evenly over the symbols, the odd rows too."""
    found = rc.stratified_rows(views.hourly_candles(spark, folder), 0.1, 12, seed=3)
    return found.select("symbol", "timestamp", "close")
