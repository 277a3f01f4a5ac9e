"""Table contracts, cadences and thresholds.

Everything here is driver-side configuration: constants, ``StructType`` schemas and
frozen dataclasses. No data is held in this module.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Labels, keys and limits that stored data must carry.
# ---------------------------------------------------------------------------
EXCHANGE = "binance"
PROVIDER = "coinmarketcap"
QUOTE_ASSET = "USDT"
PREFIX = "1000"

INTERVAL_SECONDS = {
    "1m": 60,
    "3m": 180,
    "5m": 300,
    "15m": 900,
    "30m": 1_800,
    "1h": 3_600,
    "2h": 7_200,
    "4h": 14_400,
    "6h": 21_600,
    "8h": 28_800,
    "12h": 43_200,
    "1d": 86_400,
    "3d": 259_200,
    "1w": 604_800,
}
VARIABLE_INTERVALS = ("1M",)
INTERVALS = (*INTERVAL_SECONDS, *VARIABLE_INTERVALS)

DAY_SECONDS = 86_400
OPEN_INTEREST_SECONDS = 300
FUNDING_SECONDS = 28_800
MICROSECOND_EPOCH_FLOOR = 5_000_000_000_000
RECENT_REFRESH_DAYS = 3
REPAIR_ROW_LIMITS = {"spot": 1_000, "futures": 1_500, "funding_rates": 1_000}

CANDLE_FILE_COLUMNS = (
    "open_time",
    "open",
    "high",
    "low",
    "close",
    "volume",
    "close_time",
    "quote_volume",
    "trades_count",
    "taker_buy_base_volume",
    "taker_buy_quote_volume",
    "ignore",
)
CANDLE_REQUIRED_COLUMNS = ("close_time", "open", "high", "low", "close", "volume")
OPEN_INTEREST_REQUIRED_COLUMNS = ("create_time", "sum_open_interest")
FUNDING_REQUIRED_COLUMNS = ("calc_time", "last_funding_rate")

EXCLUDED_TAGS = (
    "stablecoin",
    "asset-backed-stablecoin",
    "algorithmic-stablecoin",
    "usd-stablecoin",
    "fiat-stablecoin",
    "eur-stablecoin",
    "wrapped-tokens",
    "tokenized-gold",
    "tokenized-commodities",
)
EXCLUDED_SYMBOLS: tuple[str, ...] = ()

# ---------------------------------------------------------------------------
# Stored tables
# ---------------------------------------------------------------------------
_STR, _DBL, _NTZ = T.StringType(), T.DoubleType(), T.TimestampNTZType()


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


CANDLE_SCHEMA = _struct(
    ("exchange", _STR, False),
    ("symbol", _STR, False),
    ("interval", _STR, False),
    ("timestamp", _NTZ, False),
    ("open", _DBL, False),
    ("high", _DBL, False),
    ("low", _DBL, False),
    ("close", _DBL, False),
    ("volume", _DBL, False),
    ("quote_volume", _DBL, False),
    ("trades_count", T.IntegerType(), True),
    ("taker_buy_base_volume", _DBL, True),
    ("taker_buy_quote_volume", _DBL, True),
)
OPEN_INTEREST_SCHEMA = _struct(
    ("exchange", _STR, False),
    ("symbol", _STR, False),
    ("timestamp", _NTZ, False),
    ("open_interest", _DBL, False),
)
FUNDING_SCHEMA = _struct(
    ("exchange", _STR, False),
    ("symbol", _STR, False),
    ("timestamp", _NTZ, False),
    ("funding_rate", _DBL, False),
)
UNIVERSE_SCHEMA = _struct(
    ("provider", _STR, False),
    ("provider_id", T.LongType(), False),
    ("date", T.DateType(), False),
    ("symbol", _STR, False),
    ("name", _STR, False),
    ("slug", _STR, True),
    ("rank", T.IntegerType(), False),
    ("market_cap", _DBL, True),
    ("fully_diluted_market_cap", _DBL, True),
    ("circulating_supply", _DBL, True),
    ("max_supply", _DBL, True),
    ("tags", _STR, True),
    ("platform", _STR, True),
    ("date_added", T.DateType(), True),
)


@dataclass(frozen=True)
class TableSpec:
    """What the library needs to know about one stored table."""

    name: str
    kind: str
    schema: T.StructType
    primary_key: tuple[str, ...]
    series_keys: tuple[str, ...]
    partition_by: str
    cadence_seconds: int | None = None
    repairable: bool = False

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


_CANDLE_KEYS = ("exchange", "symbol", "interval")
_METRIC_KEYS = ("exchange", "symbol")


def _candles(name: str) -> TableSpec:
    return TableSpec(
        name, "kline", CANDLE_SCHEMA, (*_CANDLE_KEYS, "timestamp"), _CANDLE_KEYS, "month", None, True
    )


def _metric(name: str, schema: T.StructType, cadence: int, repairable: bool) -> TableSpec:
    return TableSpec(
        name, "metric", schema, (*_METRIC_KEYS, "timestamp"), _METRIC_KEYS, "month", cadence, repairable
    )


TABLES = {
    "spot": _candles("spot"),
    "futures": _candles("futures"),
    "open_interest": _metric("open_interest", OPEN_INTEREST_SCHEMA, OPEN_INTEREST_SECONDS, False),
    "funding_rates": _metric("funding_rates", FUNDING_SCHEMA, FUNDING_SECONDS, True),
    "crypto_universe": TableSpec(
        "crypto_universe",
        "universe",
        UNIVERSE_SCHEMA,
        ("provider", "provider_id", "date"),
        ("provider", "provider_id"),
        "year",
    ),
}
REPAIRABLE_TABLES = tuple(name for name, spec in TABLES.items() if spec.repairable)


def table_spec(name: str) -> TableSpec:
    """Look a table up, naming the valid choices when it is unknown."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}; known tables: {', '.join(TABLES)}")
    return TABLES[name]


# ---------------------------------------------------------------------------
# Reports
# ---------------------------------------------------------------------------
SEVERITIES = ("ERROR", "WARN")
FINDING_SCHEMA = _struct(
    ("severity", _STR, False),
    ("table", _STR, False),
    ("check_name", _STR, False),
    ("message", _STR, False),
    ("count", T.LongType(), False),
    ("symbol", _STR, True),
    ("interval", _STR, True),
    ("first_timestamp", _NTZ, True),
    ("last_timestamp", _NTZ, True),
    ("metadata", _STR, True),
)
ANOMALY_SCHEMA = _struct(
    ("table", _STR, True),
    ("table_name", _STR, True),
    ("symbol", _STR, True),
    ("interval", _STR, True),
    ("period", _STR, True),
    ("source_file", _STR, True),
    ("check_name", _STR, True),
    ("count", T.LongType(), True),
    ("metadata", T.MapType(_STR, _STR), True),
    ("event_timestamp", _STR, True),
)


@dataclass(frozen=True)
class AuditConfig:
    """Thresholds of the quality audit (fixed default values)."""

    price_return_sigma: float = 20.0
    volume_iqr_multiplier: float = 20.0
    open_interest_change_iqr_multiplier: float = 8.0
    funding_rate_abs_warn: float = 0.01
    funding_rate_mean_abs_warn: float = 0.001
    funding_rate_std_warn: float = 0.01
    min_outlier_observations: int = 20
    timestamp_alignment_tolerance_seconds: int = 0
    quote_volume_price_band_tolerance: float = 0.001
    price_jump_abs_return_warn: float = 0.50
    price_jump_mad_multiplier: float = 15.0
    wick_range_pct_warn: float = 1.0
    wick_side_pct_warn: float = 0.75
    stale_run_min_duration_seconds: int = 86_400
    stale_run_min_observations: int = 6
    universe_frequency: str | None = None
    universe_start_date: date | str | None = None
    universe_end_date: date | str | None = None
    universe_top_n: int | None = None
