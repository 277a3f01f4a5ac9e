"""Open candles of a stream in a stored table, and rows merged into a table by key."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

import pytest
from conftest import START, candle

from tidemark.operators.validate import ContractError
from tidemark.session import scratch_path
from tidemark.sources import tables
from tidemark.streaming.candles import store_updates, streaming_candles

EVENT = "event_id bigint, ts timestamp_ntz, symbol string, value double, qty double, taker boolean"


def closes(spark, root):
    rows = tables.read_table(spark, root, "spot").select("symbol", "timestamp", "open", "high", "close", "trades_count").collect()
    return {(r[0], r[1]): tuple(r[2:]) for r in rows}


def test_open_candles_are_there_at_once_and_get_corrected(spark):
    inbox, root, state = (scratch_path(spark, f"{x}-{uuid.uuid4().hex}") for x in ("in", "out", "state"))
    at = lambda minutes: START + timedelta(minutes=minutes)

    def run():
        stream = spark.readStream.schema(EVENT).parquet(inbox)
        store_updates(streaming_candles(stream, lateness="2 hours"), root, "spot", state).awaitTermination()

    def turn(*events):
        spark.createDataFrame([(i, t, "AUSDT", v, 1.0, True) for i, t, v in events], EVENT).coalesce(1).write.mode("append").parquet(inbox)
        run()
        return closes(spark, root)

    one, two = ("AUSDT", at(60)), ("AUSDT", at(120))
    assert turn((1, at(10), 5.0), (2, at(70), 6.0)) == {one: (5.0, 5.0, 5.0, 1), two: (6.0, 6.0, 6.0, 1)}
    # A late event, an event delivered again, and two events of one time, of which the larger closes.
    found = turn((3, at(5), 4.0), (2, at(70), 6.0), (4, at(80), 7.0), (5, at(80), 6.5))
    assert found == {one: (4.0, 5.0, 5.0, 2), two: (6.0, 7.0, 7.0, 3)}
    # Two days on; what comes for a closed window after that is too late and changes nothing.
    far = ("AUSDT", at(60 * 49))
    found = turn((6, at(60 * 48 + 1), 9.0))
    assert found == {one: (4.0, 5.0, 5.0, 2), two: (6.0, 7.0, 7.0, 3), far: (9.0, 9.0, 9.0, 1)}
    assert turn((7, at(20), 99.0)) == found
    # A run with nothing new.
    run()
    assert closes(spark, root) == found


def test_merged_rows_replace_their_keys_only(spark, candles):
    root = scratch_path(spark, f"merge-{uuid.uuid4().hex}")
    first = candles([candle(datetime(2024, 1, 5)), candle(datetime(2024, 1, 6)), candle(datetime(2024, 3, 1, 4))])
    tables.merge_rows(spark, root, "spot", first)
    update = candles([candle(datetime(2024, 1, 6), close=100.9), candle(datetime(2024, 2, 2)), candle(datetime(2024, 1, 6), "ETHUSDT")])
    for _ in range(2):
        tables.merge_rows(spark, root, "spot", update)
        found = closes(spark, root)
        assert len(found) == 5 and found["BTCUSDT", datetime(2024, 1, 6)][2] == 100.9
        assert found["BTCUSDT", datetime(2024, 1, 5)][2] == found["BTCUSDT", datetime(2024, 3, 1, 4)][2] == 100.5
    tables.merge_rows(spark, root, "spot", candles([]))
    with pytest.raises(ContractError):
        tables.merge_rows(spark, root, "spot", candles([candle(datetime(2024, 1, 6))] * 2))
    with pytest.raises(ContractError):
        tables.merge_rows(spark, root, "spot", candles([candle(datetime(2024, 1, 6), low=200.0)]))
    assert closes(spark, root) == found
