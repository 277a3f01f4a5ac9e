"""Assets followed through their tickers by the rankings."""

from __future__ import annotations

from datetime import date, datetime

from conftest import candle, day
from pyspark.sql import functions as F

from tidemark.operators import universe as un

MONTHS = [date(2024, m, 1) for m in range(1, 13)]


def names(ranking, entries):
    """Entries (first month, last month, id, symbol) with the id as rank."""
    rows = [(MONTHS[m - 1], s, i, 1e6 / i, "defi", i) for a, b, i, s in entries for m in range(a, b + 1)]
    return ranking(rows)


def as_rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def test_a_chain_ends_in_its_newest_name(ranking):
    ranks = names(ranking, [(1, 3, 1, "AAA"), (4, 6, 1, "BBB"), (7, 12, 1, "CCC"), (1, 12, 2, "ZZZ")])
    assert as_rows(un.names_from_rankings(ranks), "symbol", "canonical", "valid_from", "valid_to") == [
        ("AAAUSDT", "CCCUSDT", None, None),
        ("BBBUSDT", "CCCUSDT", None, None),
    ]


def test_a_reused_ticker_belongs_to_one_asset_at_a_time(ranking, candles):
    ranks = names(ranking, [(1, 4, 1, "AAA"), (5, 12, 1, "BBB"), (1, 7, 2, "OLD"), (8, 12, 2, "AAA")])
    traded = candles(
        [candle(datetime(2024, 2, 1), "AAAUSDT"), candle(datetime(2024, 8, 1), "AAAUSDT"), candle(datetime(2024, 8, 1, 4), "AAAUSDT")]
        + [candle(datetime(2024, 6, 1), "BBBUSDT"), candle(datetime(2024, 6, 1), "OLDUSDT"), candle(datetime(2024, 6, 1), "NEWUSDT")]
    )
    stitched = un.stitch_renamed(traded, un.names_from_rankings(ranks))
    # Until the close at the takeover's first moment the ticker is the earlier asset's.
    assert as_rows(stitched, "symbol", "timestamp") == sorted(
        [
            ("BBBUSDT", datetime(2024, 2, 1)),
            ("BBBUSDT", datetime(2024, 8, 1)),
            ("AAAUSDT", datetime(2024, 8, 1, 4)),
            ("BBBUSDT", datetime(2024, 6, 1)),
            ("AAAUSDT", datetime(2024, 6, 1)),
            ("NEWUSDT", datetime(2024, 6, 1)),
        ],
        key=repr,
    )


def test_a_dead_asset_does_not_share_the_name_of_its_successor(ranking):
    ranks = names(ranking, [(1, 4, 1, "AAA"), (8, 12, 2, "AAA")])
    assert as_rows(un.asset_names(ranks), "provider_id", "canonical") == [(1, "AAA.1"), (2, "AAA")]
    assert as_rows(un.names_from_rankings(ranks), "symbol", "canonical", "valid_to") == [
        ("AAAUSDT", "AAA.1USDT", datetime(2024, 8, 1))
    ]


def test_a_ticker_that_comes_back_changes_hands_twice(ranking):
    ranks = names(ranking, [(1, 3, 1, "AAA"), (4, 6, 2, "AAA"), (7, 9, 1, "AAA")])
    assert as_rows(un.ticker_spans(ranks), "provider_id", "valid_from", "valid_to") == [
        (1, None, day("2024-04-01")),
        (1, day("2024-07-01"), None),
        (2, day("2024-04-01"), day("2024-07-01")),
    ]


def test_two_assets_under_one_ticker_the_better_rank_owns_it(ranking):
    rows = [(MONTHS[0], "AAA", None, 1.0, None, 3), (MONTHS[0], "AAA", 9, 1.0, None, 2), (MONTHS[0], "AAA", 4, 1.0, None, 5)]
    ranks = ranking(rows + [(MONTHS[0], "SSS", 1, 1.0, None, 7), (None, "QQQ", 1, 1.0, None, 8), (MONTHS[0], "NNN", 1, 1.0, None, None)])
    ranks = ranks.withColumn("symbol", F.expr("nullif(symbol, 'SSS')"))
    assert as_rows(un.ticker_spans(ranks), "symbol", "provider_id", "valid_from", "valid_to") == [("AAA", 5, None, None)]
    assert as_rows(un.asset_names(ranks), "provider_id", "canonical") == [(2, "AAA.2"), (3, "AAA.3"), (5, "AAA")]


def test_empty_rankings_leave_candles_alone(ranking, candles):
    rows = candles([candle(datetime(2024, 2, 1), "AAAUSDT")])
    assert un.stitch_renamed(rows, un.names_from_rankings(ranking([]))).collect() == rows.collect()
