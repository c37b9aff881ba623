import json
import re

import pytest
from pyspark.sql import functions as F

from barloom.operators.frames import (
    decode_trades,
    encode_trades,
    mark_trades,
    only_watched,
    parse_trades,
)
from barloom.operators.lookup import watchlist_frame
from barloom.schemas import TRADE

GOOD = {"p": 93.5, "s": "NFLX", "t": 1700000000456, "v": 40.25, "c": ["7"]}


def frames(spark, *values):
    texts = [v if isinstance(v, str) or v is None else json.dumps(v) for v in values]
    return spark.createDataFrame([(t,) for t in texts], "value string")


def trade_frame(*elements):
    return {"type": "trade", "data": list(elements)}


def test_sample_record(spark):
    good, bad = parse_trades(frames(spark, trade_frame(GOOD)), now=F.lit(7).cast("bigint"))
    row = good.collect()[0]
    assert good.schema.fieldNames() == TRADE.fieldNames()
    assert (row.symbol, row.price, row.volume) == ("NFLX", 93.5, 40.25)
    assert (row.source_timestamp, row.ingestion_timestamp) == (1700000000456, 7)
    assert row.trade_conditions == ["7"]
    assert bad.count() == 0


def test_other_frames_vanish(spark):
    marked = mark_trades(
        frames(
            spark,
            {"type": "ping"},
            {"type": "ping", "data": [1]},
            {"type": "news", "data": "x"},
            {"data": [GOOD]},
            {"type": "trade"},
            trade_frame(),
        )
    )
    assert marked.count() == 0


@pytest.mark.parametrize(
    ("element", "reason"),
    [
        ({**GOOD, "p": "x"}, "bad_price"),
        ({k: v for k, v in GOOD.items() if k != "p"}, "bad_price"),
        ({k: v for k, v in GOOD.items() if k != "s"}, "bad_symbol"),
        ({**GOOD, "v": None}, "bad_volume"),
        ({**GOOD, "t": None}, "bad_time"),
        ({**GOOD, "t": 10**18}, "bad_time"),
        (None, "bad_element"),
        (5, "bad_element"),
        ("text", "bad_element"),
    ],
)
def test_bad_element_leaves_neighbours(spark, element, reason):
    source = frames(spark, trade_frame({**GOOD, "s": "A"}, element, {**GOOD, "s": "B"}))
    good, bad = parse_trades(source)
    assert sorted(r.symbol for r in good.collect()) == ["A", "B"]
    assert [r.reject_reason for r in bad.collect()] == [reason]


@pytest.mark.parametrize("text", ["not json", "", None, "[1]", "5", '{"type":"trade","data":[{"s"'])
def test_undecodable_frame_is_one_rejected_row(spark, text):
    good, bad = parse_trades(frames(spark, text))
    assert good.count() == 0
    assert [(r.reject_reason, r.raw) for r in bad.collect()] == [("bad_json", text)]


def test_numbers_as_text_and_fractions(spark):
    source = frames(spark, trade_frame({**GOOD, "p": "3.5", "v": "2", "t": 1.9}))
    row = parse_trades(source)[0].collect()[0]
    assert (row.price, row.volume, row.source_timestamp) == (3.5, 2.0, 1)


def test_missing_conditions_are_empty(spark):
    source = frames(spark, trade_frame({k: v for k, v in GOOD.items() if k != "c"}))
    assert parse_trades(source)[0].collect()[0].trade_conditions == []


def test_event_ids(spark):
    source = frames(spark, trade_frame(GOOD, GOOD), trade_frame({**GOOD, "p": 1}))
    ids = [r.event_id for r in parse_trades(source)[0].collect()]
    assert len(set(ids)) == 3
    assert all(re.fullmatch(r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", i) for i in ids)
    first, again = (
        sorted(r.event_id for r in parse_trades(source, "payload")[0].collect()) for _ in range(2)
    )
    assert first == again
    assert len(set(first)) == 3
    with pytest.raises(ValueError, match="event_id"):
        parse_trades(source, "serial")


def test_ingestion_time_is_now(spark):
    import time

    before = int(time.time() * 1000) - 1000
    row = parse_trades(frames(spark, trade_frame(GOOD)))[0].collect()[0]
    assert before <= row.ingestion_timestamp <= int(time.time() * 1000) + 1000


def test_topic_round_trip(spark):
    source = frames(spark, trade_frame(GOOD, {**GOOD, "s": "BINANCE:BTCUSDT", "p": 0.1 + 0.2}))
    trades = parse_trades(source, "payload", F.lit(1).cast("bigint"))[0]
    records = encode_trades(trades)
    assert {bytes(r.key).decode() for r in records.collect()} == {"NFLX", "BINANCE:BTCUSDT"}
    assert sorted(json.loads(bytes(records.collect()[0].value))) == sorted(TRADE.fieldNames())
    back, bad = decode_trades(records)
    assert sorted(back.collect()) == sorted(trades.collect())
    assert bad.count() == 0


def test_bad_topic_records(spark):
    rows = [(b"k", b"\xff\xfe"), (b"k", b"{cut"), (b"k", b'{"symbol":"A","price":1.0}'), (b"k", None)]
    good, bad = decode_trades(spark.createDataFrame(rows, "key binary, value binary"))
    assert good.count() == 0
    assert sorted(r.reject_reason for r in bad.collect()) == [
        "bad_json",
        "bad_time",
        "bad_utf8",
        "bad_utf8",
    ]


def test_watchlist_as_list_and_frame(spark):
    trades = spark.createDataFrame([("AAPL",), ("MSFT",), ("X",)], "symbol string")
    names = ["AAPL", "MSFT", "TSLA"]
    for watchlist in (names, watchlist_frame(spark, names)):
        kept = only_watched(trades, watchlist)
        assert sorted(r.symbol for r in kept.collect()) == ["AAPL", "MSFT"]
