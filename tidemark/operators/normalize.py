"""From raw archive lines to typed rows.

Input is one row per line: (file, line_no, line) plus the symbol, interval and period that the
file name gives. Decisions that hold for a whole file (header, column positions, time unit)
are aggregated per file and joined back; everything else is an expression per line.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import specs
from tidemark.functions.quantiles import join_group_stats
from tidemark.functions.scalars import ntz_from_micros, ntz_from_seconds
from tidemark.operators import upsert

#: Fields of a row whose text could not be read; ``validate`` reports each as a broken type.
UNREADABLE = "_uncastable"
FILE_COLUMNS = ("file", "symbol", "interval", "period")
PRICE_COLUMNS = (
    "open",
    "high",
    "low",
    "close",
    "volume",
    "quote_volume",
    "taker_buy_base_volume",
    "taker_buy_quote_volume",
)
REQUIRED = {
    "kline": specs.CANDLE_REQUIRED_COLUMNS,
    "open_interest": specs.OPEN_INTEREST_REQUIRED_COLUMNS,
    "funding_rates": specs.FUNDING_REQUIRED_COLUMNS,
}
TIME_COLUMN = {"kline": "close_time", "open_interest": "create_time", "funding_rates": "calc_time"}


@dataclass(frozen=True)
class Normalised:
    """Typed rows (with ``file``, ``line_no`` and unreadable fields), anomalies, rejected files."""

    rows: DataFrame
    anomalies: DataFrame
    rejected: DataFrame


def _kind(table: str) -> str:
    return "kline" if specs.table_spec(table).kind == "kline" else table


def file_layouts(lines: DataFrame, table: str) -> DataFrame:
    """Per file: whether there is a header, the column names and the required ones missing."""
    kind = _kind(table)
    first = lines.groupBy("file").agg(
        F.min_by("line", "line_no").alias("_first"), F.min("line_no").alias("_first_no")
    )
    lowered = F.lower("_first")
    if kind == "kline":
        has_header = lowered.contains("open_time") | lowered.contains("close_time")
        positional = F.array(*[F.lit(c) for c in specs.CANDLE_FILE_COLUMNS])
        names = F.when(has_header, F.split(lowered, ",")).otherwise(positional)
    else:
        has_header = F.lit(True)
        names = F.split("_first", ",")
    required = F.array(*[F.lit(c) for c in REQUIRED[kind]])
    # A file without any line, such as an archive without a CSV member, has no columns at all.
    names = F.when(F.col("_first").isNotNull(), names).otherwise(F.array().cast("array<string>"))
    return (
        first.withColumn("has_header", F.coalesce(has_header, F.lit(True)))
        .withColumn("names", F.transform(names, lambda n: F.regexp_replace(F.trim(n), "\r$", "")))
        .withColumn("missing_columns", F.array_except(required, F.col("names")))
        .select("file", "_first_no", "has_header", "names", "missing_columns")
    )


def _field(*names: str) -> Column:
    """Text of the first of ``names`` that the file has; NULL when empty or absent."""
    position = F.lit(0)
    for name in reversed(names):
        here = F.array_position("names", name)
        position = F.when(here > 0, here).otherwise(position).cast("int")
    text = F.try_element_at(F.col("_fields"), F.when(position > 0, position))
    text = F.trim(text)
    return F.when(~F.lower(text).isin("", "nan", "null", "none"), text)


def _unreadable(texts: dict[str, Column], types: dict[str, str]) -> Column:
    """Names of the fields that hold text which their type cannot read."""
    lost = [
        F.when(text.isNotNull() & _integer(text).try_cast("int").isNull(), F.lit(name))
        if types[name] == "int"
        else F.when(text.isNotNull() & text.try_cast(types[name]).isNull(), F.lit(name))
        for name, text in texts.items()
    ]
    return F.filter(F.array(*lost), lambda c: c.isNotNull())


def _integer(text: Column) -> Column:
    return F.coalesce(text.try_cast("bigint"), text.try_cast("double").cast("bigint"))


def split_lines(lines: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """Data lines with their file's layout, and the files lacking required columns."""
    layouts = file_layouts(lines, table)
    joined = join_group_stats(lines, layouts, ["file"], ["line_no"])
    data = joined.where(
        (F.size("missing_columns") == 0)
        & (~F.col("has_header") | (F.col("line_no") != F.col("_first_no")))
        & (F.trim("line") != "")
    ).withColumn("_fields", F.split(F.regexp_replace("line", "\r$", ""), ","))
    rejected = layouts.where(F.size("missing_columns") > 0).select(
        "file",
        "missing_columns",
        F.col("names").alias("available_columns"),
        F.when(F.size("names") == 0, "no CSV lines").otherwise("missing columns").alias("reason"),
    )
    return data, rejected


def epoch_to_micros(value: Column, in_micros: Column) -> Column:
    """Epoch number to microseconds; the unit is decided per file, arithmetic is integer."""
    return F.when(in_micros, value).otherwise(value * 1_000)


def ceil_to_second(micros: Column) -> Column:
    """Next whole second; an exact second stays."""
    seconds = F.floor((micros + 999_999) / 1_000_000).cast("bigint")
    return ntz_from_seconds(F.when(seconds * 1_000_000 >= micros, seconds).otherwise(seconds + 1))


def _file_units(rows: DataFrame) -> DataFrame:
    """A file with any epoch number past the floor is in microseconds as a whole."""
    return rows.groupBy("file").agg(
        (F.coalesce(F.max("_epoch"), F.lit(0)) >= specs.MICROSECOND_EPOCH_FLOOR).alias("in_micros"),
        F.bool_and(F.col("_epoch").isNotNull()).alias("all_numbers"),
    )


def candle_rows(lines: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """Typed candle rows before deduplication, and rejected files."""
    data, rejected = split_lines(lines, table)
    trades = _field("trades_count", "count")
    texts = {name: _field(name) for name in PRICE_COLUMNS}
    kinds = dict.fromkeys(PRICE_COLUMNS, "double") | {"trades_count": "int"}
    parsed = data.select(
        *FILE_COLUMNS,
        "line_no",
        _integer(_field("close_time")).alias("_epoch"),
        *[text.try_cast("double").alias(name) for name, text in texts.items()],
        _integer(trades).try_cast("int").alias("trades_count"),
        _unreadable(texts | {"trades_count": trades}, kinds).alias(UNREADABLE),
    )
    timed = join_group_stats(parsed, _file_units(parsed), ["file"], ["line_no"])
    rows = timed.withColumns(
        {
            "exchange": F.lit(specs.EXCHANGE),
            "timestamp": ceil_to_second(epoch_to_micros(F.col("_epoch"), F.col("in_micros"))),
        }
    ).select("file", "period", "line_no", *specs.CANDLE_SCHEMA.fieldNames(), UNREADABLE)
    return rows, rejected


def metric_rows(lines: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """Typed open-interest or funding rows before filtering, and rejected files.

    Times stay exact. Open interest also accepts date strings, for a file as a whole.
    """
    value, source = {
        "open_interest": ("open_interest", "sum_open_interest"),
        "funding_rates": ("funding_rate", "last_funding_rate"),
    }[table]
    data, rejected = split_lines(lines, table)
    text = _field(TIME_COLUMN[table])
    parsed = data.select(
        *FILE_COLUMNS,
        "line_no",
        text.alias("_text"),
        _integer(text).alias("_epoch"),
        _field(source).try_cast("double").alias(value),
        _unreadable({value: _field(source)}, {value: "double"}).alias(UNREADABLE),
    )
    timed = join_group_stats(parsed, _file_units(parsed), ["file"], ["line_no"])
    stamp = ntz_from_micros(epoch_to_micros(F.col("_epoch"), F.col("in_micros")))
    if table == "open_interest":
        stamp = F.when(F.col("all_numbers"), stamp).otherwise(
            F.col("_text").try_cast("timestamp_ntz")
        )
    rows = timed.withColumns({"exchange": F.lit(specs.EXCHANGE), "timestamp": stamp}).select(
        "file", "period", "line_no", *specs.table_spec(table).columns, UNREADABLE
    )
    return rows, rejected


def _anomaly(per_file: DataFrame, check: str, count: str, table: str, metadata: Column) -> DataFrame:
    interval = F.col("interval") if specs.table_spec(table).kind == "kline" else F.lit(None)
    return per_file.where(F.col(count) > 0).select(
        F.lit(table).alias("table"),
        "symbol",
        interval.cast("string").alias("interval"),
        "period",
        F.col("file").alias("source_file"),
        F.lit(check).alias("check_name"),
        F.col(count).cast("bigint").alias("count"),
        metadata.alias("metadata"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("event_timestamp"),
    )


def no_metadata() -> Column:
    return F.create_map().cast("map<string,string>")


def normalise(
    lines: DataFrame, table: str, windows: DataFrame | None = None
) -> Normalised:
    """Parse, drop zero open interest, keep the first of copied keys, apply close windows.

    ``windows`` optionally gives (file, window_start, window_end) for candle files; rows count
    when start < close <= end. Every dropped row is accounted for in ``anomalies``.
    """
    spec = specs.table_spec(table)
    kline = spec.kind == "kline"
    rows, rejected = candle_rows(lines, table) if kline else metric_rows(lines, table)
    files = lines.select(*FILE_COLUMNS).distinct()
    anomalies = None
    if table == "open_interest":
        # A missing value is no zero: it is left for validation to reject.
        nonzero = F.coalesce(F.col("open_interest") != 0, F.lit(True))
        zeros = rows.groupBy("file").agg(F.count_if(~nonzero).alias("_zero"))
        anomalies = _anomaly(
            zeros.join(files, "file"),
            "import_dropped_zero_open_interest_rows",
            "_zero",
            table,
            no_metadata(),
        )
        rows = rows.where(nonzero)
    kept = upsert.keep_first(rows, ["file", *spec.primary_key], ["line_no"])
    dropped = kept.groupBy("file").agg(F.sum(F.col(upsert.COPIES) - 1).alias("_dropped"))
    copies = _anomaly(
        dropped.join(files, "file"),
        "import_dropped_duplicate_rows",
        "_dropped",
        table,
        F.create_map(F.lit("primary_key"), F.lit(",".join(spec.primary_key))),
    )
    anomalies = copies if anomalies is None else anomalies.unionByName(copies)
    kept = kept.drop(upsert.COPIES)
    if kline and windows is not None:
        limited = join_group_stats(kept, windows, ["file"], ["line_no"])
        kept = limited.where(
            F.coalesce(F.col("timestamp") > F.col("window_start"), F.lit(True))
            & F.coalesce(F.col("timestamp") <= F.col("window_end"), F.lit(True))
        ).drop("window_start", "window_end")
    readable = files.join(rejected.select("file"), "file", "left_anti")
    empty = readable.join(kept.select("file").distinct(), "file", "left_anti").withColumn(
        "_empty", F.lit(1)
    )
    anomalies = anomalies.unionByName(
        _anomaly(
            empty,
            "import_empty_after_parse",
            "_empty",
            table,
            F.create_map(F.lit("reason"), F.lit("no_rows_after_parse_or_window_filter")),
        )
    )
    return Normalised(kept, anomalies, rejected)


# ---------------------------------------------------------------------------
# Payloads of request-based sources
# ---------------------------------------------------------------------------
CANDLE_PAYLOAD = "array<array<string>>"
FUNDING_PAYLOAD = "array<struct<fundingTime:string,fundingRate:string>>"
PAYLOAD_REASONS = ("not a JSON array of records", "record with missing fields", "unreadable field")


def _payload_items(payloads: DataFrame, table: str) -> DataFrame:
    """Payloads with their parsed records and the reason why they cannot be taken, if any.

    A payload is taken as a whole or not at all, like a file.
    """
    kline = specs.table_spec(table).kind == "kline"
    parsed = payloads.withColumn("_items", F.from_json("payload", CANDLE_PAYLOAD if kline else FUNDING_PAYLOAD))

    def unlike(text: Column, kind: str) -> Column:
        return text.isNotNull() & text.try_cast(kind).isNull()

    if kline:
        names = specs.CANDLE_FILE_COLUMNS

        def short(item: Column) -> Column:
            return item.isNull() | (F.size(item) < len(names) - 1)

        def odd(item: Column) -> Column:
            at = {name: F.get(item, F.lit(names.index(name))) for name in (*PRICE_COLUMNS, "close_time", "trades_count")}
            found = at["close_time"].try_cast("bigint").isNull() | unlike(at["trades_count"], "int")
            for name in PRICE_COLUMNS:
                found = found | unlike(at[name], "double")
            return found

    else:

        def short(item: Column) -> Column:
            return item.isNull() | item["fundingTime"].isNull()

        def odd(item: Column) -> Column:
            return item["fundingTime"].try_cast("bigint").isNull() | unlike(item["fundingRate"], "double")

    reason = (
        F.when(F.col("_items").isNull(), PAYLOAD_REASONS[0])
        .when(F.exists("_items", short), PAYLOAD_REASONS[1])
        .when(F.exists("_items", odd), PAYLOAD_REASONS[2])
    )
    return parsed.withColumn("reason", reason)


def rejected_payloads(payloads: DataFrame, table: str) -> DataFrame:
    """The payloads that cannot be taken, with the reason, without their text."""
    broken = _payload_items(payloads, table).where(F.col("reason").isNotNull())
    return broken.select(*[c for c in payloads.columns if c != "payload"], "reason")


def candle_payload_rows(payloads: DataFrame) -> DataFrame:
    """Rows from (symbol, interval, payload) where payload is a JSON array of 12-element arrays.

    Payloads that cannot be read are left to ``rejected_payloads``.
    """
    items = (
        _payload_items(payloads, "spot")
        .where(F.col("reason").isNull())
        .select("symbol", "interval", F.posexplode("_items").alias("_pos", "_a"))
    )

    def item(name: str) -> Column:
        return F.col("_a")[specs.CANDLE_FILE_COLUMNS.index(name)]

    rows = items.select(
        F.lit(specs.EXCHANGE).alias("exchange"),
        "symbol",
        "interval",
        ceil_to_second((item("close_time").try_cast("bigint") + 1) * 1_000).alias("timestamp"),
        *[item(name).try_cast("double").alias(name) for name in PRICE_COLUMNS],
        item("trades_count").try_cast("int").alias("trades_count"),
        F.col("_pos").alias("_pos"),
    )
    keys = specs.TABLES["spot"].primary_key
    return upsert.keep_first(rows, keys, ["_pos"]).select(*specs.CANDLE_SCHEMA.fieldNames())


def funding_payload_rows(payloads: DataFrame) -> DataFrame:
    """Rows from (symbol, payload) where payload is a JSON array of funding objects.

    Payloads that cannot be read are left to ``rejected_payloads``.
    """
    rows = (
        _payload_items(payloads, "funding_rates")
        .where(F.col("reason").isNull())
        .select("symbol", F.posexplode("_items").alias("_pos", "_o"))
        .select(
            F.lit(specs.EXCHANGE).alias("exchange"),
            "symbol",
            ntz_from_micros(F.col("_o.fundingTime").try_cast("bigint") * 1_000).alias("timestamp"),
            F.col("_o.fundingRate").try_cast("double").alias("funding_rate"),
            "_pos",
        )
    )
    keys = specs.TABLES["funding_rates"].primary_key
    return upsert.keep_first(rows, keys, ["_pos"]).select(*specs.FUNDING_SCHEMA.fieldNames())


LISTING_SHAPE = (
    "struct<id:bigint,name:string,symbol:string,slug:string,cmcRank:int,circulatingSupply:double,"
    "totalSupply:double,maxSupply:double,dateAdded:string,tags:array<string>,"
    "platform:struct<name:string>,"
    "quotes:array<struct<marketCap:double,fullyDilutedMarketCap:double,price:double>>>"
)


def listing_rows(listings: DataFrame) -> DataFrame:
    """Universe rows from (date, data) where data is an array of listing objects."""
    coin = F.col("_c")
    quote = F.try_element_at(coin["quotes"], F.lit(1))
    return listings.select("date", F.explode("data").alias("_c")).select(
        F.lit(specs.PROVIDER).alias("provider"),
        coin["id"].cast("bigint").alias("provider_id"),
        "date",
        F.upper(F.coalesce(coin["symbol"], F.lit(""))).alias("symbol"),
        F.coalesce(coin["name"], F.lit("")).alias("name"),
        coin["slug"].alias("slug"),
        coin["cmcRank"].cast("int").alias("rank"),
        quote["marketCap"].alias("market_cap"),
        quote["fullyDilutedMarketCap"].alias("fully_diluted_market_cap"),
        coin["circulatingSupply"].alias("circulating_supply"),
        coin["maxSupply"].alias("max_supply"),
        F.array_join(F.coalesce(coin["tags"], F.array().cast("array<string>")), ",").alias("tags"),
        coin["platform"]["name"].alias("platform"),
        F.to_date(F.try_to_timestamp(coin["dateAdded"])).alias("date_added"),
    )
