import json
from datetime import datetime

import pytest

from candlemill.sources import feed

KLINE = {"t": 1_704_067_200_000, "o": "1.0", "h": 2.0, "l": "0.5", "c": "1.5", "v": "10", "n": 7, "x": True}


def envelope(stream, data):
    return json.dumps({"stream": stream, "data": data})


GOOD_KLINE = envelope("btcusdt@kline_1m", {"k": KLINE})
GOOD_TICKER = envelope("ethusdt@ticker", {"c": "1.5", "P": -0.2, "v": "10", "p": "99"})
BAD = {
    "{bad": "no envelope",
    "[1, 2]": "no envelope",
    "{}": "no envelope",
    '{"stream": "btcusdt@ticker"}': "no envelope",
    envelope("btcusdt@ticker", {"c": "x", "P": "1", "v": "1"}): "bad ticker",
    envelope("btcusdt@ticker", {"c": "1", "v": "1"}): "bad ticker",
    envelope("btcusdt@kline_1m", {"k": {**KLINE, "o": "x"}}): "bad kline",
    envelope("btcusdt@kline_1m", {}): "bad kline",
}
OTHER = envelope("btcusdt@depth", {"c": "1"})


@pytest.fixture
def raw(spark):
    texts = [GOOD_KLINE, GOOD_TICKER, OTHER, *BAD]
    return spark.createDataFrame(list(enumerate(texts)), "offset long, value string")


def test_demux(raw):
    kline = feed.demux_klines(raw).collect()
    assert [r.asDict() for r in kline] == [
        {
            "offset": 0,
            "type": "kline",
            "symbol": "BTCUSDT",
            "timestamp": "2024-01-01 00:00:00",
            "open": 1.0,
            "high": 2.0,
            "low": 0.5,
            "close": 1.5,
            "volume": 10.0,
            "number_of_trades": 7,
            "is_closed": True,
        }
    ]
    ticker = feed.demux_tickers(raw).collect()
    assert [tuple(r) for r in ticker] == [(1, "ticker", "ETHUSDT", 1.5, -0.2, 10.0)]


def test_every_message_is_published_rejected_or_of_another_stream(raw):
    got = {r.value: r.reason for r in feed.rejects(raw).collect()}
    assert got == BAD


def test_publish_is_both_demultiplexers_encoded(raw):
    both = feed.encode(feed.demux_klines(raw)).unionByName(feed.encode(feed.demux_tickers(raw)))
    rows = lambda df: sorted(map(tuple, df.select("offset", "key", "value").collect()))
    assert rows(feed.publish(raw)) == rows(both) and both.count() == 2


def test_topic_round_trip(raw):
    payload = feed.encode(feed.demux_klines(raw))
    assert payload.columns == ["offset", "key", "value"]
    body = json.loads(payload.first().value)
    assert body["symbol"] == payload.first().key == "BTCUSDT"
    assert list(body) == feed.KLINE_COLS
    back = feed.decode_klines(payload.select("offset", "value"), ["BTCUSDT"]).first()
    assert back.timestamp == datetime(2024, 1, 1) and back.close == 1.5 and back.is_closed is True


def test_decode_skips_what_is_no_known_candle(spark):
    good = {
        "type": "kline",
        "symbol": "btcusdt",
        "timestamp": "2024-01-01 00:00:00",
        "open": 1,
        "high": "2",
        "low": 0.5,
        "close": 1.5,
        "volume": 3,
        "number_of_trades": 4,
        "is_closed": False,
    }
    texts = [
        json.dumps(good),
        json.dumps({**good, "symbol": "NOPE"}),
        json.dumps({**good, "type": "ticker"}),
        json.dumps({**good, "timestamp": "2024-13-01 00:00"}),
        json.dumps({**good, "close": "x"}),
        json.dumps([good]),
        "{bad",
        "null",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    rows = feed.decode_klines(df, ["BTCUSDT"]).collect()
    assert len(rows) == 1 and rows[0].symbol == "BTCUSDT" and rows[0].high == 2.0


def test_message_price(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (0.0, 2.0)], "price double, close double")
    shown = df.select(feed.message_price(df.price, df.close).alias("p")).collect()
    assert [r.p for r in shown] == [1.0, 2.0, 2.0]


def test_candles_without_a_symbol_are_rejected(spark):
    body = {"type": "kline", "timestamp": "2024-01-01 00:00:00", "is_closed": True, "number_of_trades": 1}
    body.update(dict.fromkeys(["open", "high", "low", "close", "volume"], 1.0))
    sent = [body, {**body, "symbol": None}, {**body, "symbol": "OTHER"}, {**body, "symbol": "aaa"}, {"type": "ticker"}]
    rows = spark.createDataFrame([(i, json.dumps(b)) for i, b in enumerate(sent)], "offset long, value string")
    assert {r.offset: r.reason for r in feed.topic_rejects(rows, ["AAA"]).collect()} == {0: "no symbol", 1: "no symbol"}
    assert [r.offset for r in feed.decode_klines(rows, ["AAA"]).collect()] == [3]
