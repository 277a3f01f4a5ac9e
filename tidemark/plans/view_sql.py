"""The derived views of ``views`` in SQL, as common table expressions to compose from."""

from __future__ import annotations

VIEWS = {
    "k1h": ("""
SELECT 'binance' AS exchange, upper(event_type) || 'USDT' AS symbol, '1h' AS "interval",
       time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS "timestamp",
       arg_min(value, ts) AS open, max(value) AS high, min(value) AS low, arg_max(value, ts) AS close,
       sum(CAST(1 + event_id % 7 AS DOUBLE)) AS volume,
       sum(value * CAST(1 + event_id % 7 AS DOUBLE)) AS quote_volume,
       CAST(count(*) AS INTEGER) AS trades_count,
       coalesce(sum(CAST(1 + event_id % 7 AS DOUBLE)) FILTER (WHERE event_id % 2 = 0), 0.0)
           AS taker_buy_base_volume,
       coalesce(sum(value * CAST(1 + event_id % 7 AS DOUBLE)) FILTER (WHERE event_id % 2 = 0), 0.0)
           AS taker_buy_quote_volume
FROM events WHERE value > 0 GROUP BY 1, 2, 3, 4
""", ()),
    "dirty": ("""
SELECT exchange, symbol, "interval",
       CASE WHEN fc = 13 THEN "timestamp" + INTERVAL 17 SECOND ELSE "timestamp" END AS "timestamp",
       CASE WHEN fc = -1 THEN 10.0 ELSE open END AS open,
       CASE WHEN fc = -1 THEN 10.0 WHEN fc = 3 THEN low * 0.9 ELSE high END AS high,
       CASE WHEN fc = -1 THEN 10.0 ELSE low END AS low,
       CASE WHEN fc = -1 THEN 10.0 WHEN fc = 17 THEN NULL ELSE close END AS close,
       CASE WHEN fc = -1 THEN 0.0 WHEN fc = 7 THEN -1.0 WHEN fc = 19 THEN volume * 1000
            ELSE volume END AS volume,
       CASE WHEN fc = -1 THEN 0.0 WHEN fc = 5 THEN 0.0 WHEN fc = 19 THEN quote_volume * 1000
            ELSE quote_volume END AS quote_volume,
       CASE WHEN fc = -1 THEN 0 ELSE trades_count END AS trades_count,
       CASE WHEN fc = -1 THEN 0.0 WHEN fc = 23 THEN volume * 2
            ELSE taker_buy_base_volume END AS taker_buy_base_volume,
       CASE WHEN fc = -1 THEN 0.0 ELSE taker_buy_quote_volume END AS taker_buy_quote_volume
FROM (
    SELECT *, CASE WHEN symbol = 'ERRORUSDT' AND "timestamp" > TIMESTAMP '2024-01-05 00:00:00'
                    AND "timestamp" <= TIMESTAMP '2024-01-20 00:00:00' THEN -1
                   ELSE (CAST(epoch("timestamp") AS BIGINT) // 3600 + length(symbol)) % 97 END AS fc
    FROM k1h) AS f, unnest(range(CASE WHEN fc = 11 THEN 2 ELSE 1 END)) AS u(copy)
""", ("k1h",)),
    "holed": ("""
SELECT * FROM k1h WHERE (CAST(epoch("timestamp") AS BIGINT) // 3600) % 11 <> 4
""", ("k1h",)),
    "k1d": ("""
SELECT 'binance' AS exchange, replace(upper(n_name), '_', '') || 'USDT' AS symbol,
       '1d' AS "interval", CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY AS "timestamp",
       arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
       min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close,
       sum(CAST(1 + o_orderkey % 5 AS DOUBLE)) AS volume,
       sum(o_totalprice * CAST(1 + o_orderkey % 5 AS DOUBLE)) AS quote_volume,
       CAST(count(*) AS INTEGER) AS trades_count,
       CAST(NULL AS DOUBLE) AS taker_buy_base_volume, CAST(NULL AS DOUBLE) AS taker_buy_quote_volume
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY 1, 2, 3, 4
""", ()),
    "uni": ("""
SELECT 'coinmarketcap' AS provider, CAST(c_nationkey + 1 AS BIGINT) AS provider_id, "date",
       replace(upper(n_name), '_', '') AS symbol, n_name AS name, lower(n_name) AS slug,
       CAST(row_number() OVER (PARTITION BY "date" ORDER BY market_cap DESC, c_nationkey) AS INTEGER)
           AS rank,
       market_cap, market_cap * 2 AS fully_diluted_market_cap,
       CAST(NULL AS DOUBLE) AS circulating_supply, CAST(NULL AS DOUBLE) AS max_supply,
       CASE WHEN (c_nationkey + 1) % 8 = 0 THEN 'defi, Stablecoin'
            WHEN (c_nationkey + 1) % 8 = 1 THEN 'stablecoin-protocol' ELSE 'defi' END AS tags,
       CASE WHEN (c_nationkey + 1) % 3 = 0 THEN 'NationChain' END AS platform,
       CAST(NULL AS DATE) AS date_added
FROM (
    SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS "date", c_nationkey,
           round(sum(o_totalprice), 2) AS market_cap
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2) AS t
JOIN nation ON c_nationkey = n_nationkey
""", ()),
    "duni": ("""
SELECT provider, provider_id, "date",
       CASE WHEN fc = 17 THEN 'NATION1' ELSE symbol END AS symbol, name, slug,
       CAST(CASE WHEN fc = 11 THEN rank + 1 WHEN fc = 13 THEN 0 ELSE rank END AS INTEGER) AS rank,
       CASE WHEN fc = 19 THEN -market_cap WHEN fc = 23 THEN market_cap * 10
            WHEN fc = 29 THEN NULL ELSE market_cap END AS market_cap,
       fully_diluted_market_cap, circulating_supply, max_supply, tags, platform, date_added
FROM (
    SELECT *, ((year("date") * 12 + month("date")) * 31 + provider_id) % 41 AS fc FROM uni
    WHERE (year("date") * 12 + month("date")) % 17 <> 5) AS f,
    unnest(range(CASE WHEN fc = 7 THEN 2 ELSE 1 END)) AS u(copy)
WHERE fc <> 2
""", ("uni",)),
    "oi": ("""
SELECT 'binance' AS exchange, upper(event_type) || 'USDT' AS symbol,
       time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes' AS "timestamp",
       arg_max(value, ts) AS open_interest
FROM events GROUP BY 1, 2, 3
""", ()),
    "doi": ("""
SELECT exchange, symbol, "timestamp",
       CASE WHEN fc = 5 THEN 0.0 WHEN fc = 7 THEN NULL ELSE open_interest END AS open_interest
FROM (
    SELECT *, (CAST(epoch("timestamp") AS BIGINT) // 300 + length(symbol)) % 89 AS fc FROM oi) AS f,
    unnest(range(CASE WHEN fc = 3 THEN 3 ELSE 1 END)) AS u(copy)
""", ("oi",)),
    "fr": ("""
SELECT * FROM (
    SELECT 'binance' AS exchange, upper(event_type) || 'USDT' AS symbol,
           time_bucket(INTERVAL '8 hours', ts) + INTERVAL '8 hours' AS "timestamp",
           round((avg(value) - 50) / 1000 + 3e-10, 6) AS funding_rate
    FROM events GROUP BY 1, 2, 3) AS f
WHERE (CAST(epoch("timestamp") AS BIGINT) // 28800) % 17 <> 3
""", ()),
    "cadence": ("""
SELECT * FROM (VALUES ('1m', 60), ('3m', 180), ('5m', 300), ('15m', 900), ('30m', 1800),
    ('1h', 3600), ('2h', 7200), ('4h', 14400), ('6h', 21600), ('8h', 28800), ('12h', 43200),
    ('1d', 86400), ('3d', 259200), ('1w', 604800)) AS c("interval", expected_seconds)
""", ()),
}


def with_views(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """Prefix a SELECT with the named views and their inputs, then any ``extra`` CTEs."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in VIEWS[name][1]:
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    parts = [f"{name} AS MATERIALIZED ({VIEWS[name][0]})" for name in ordered]
    parts += [f"{name} AS ({sql})" for name, sql in (extra or {}).items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body
