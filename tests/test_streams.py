"""Streams give what a batch over the same messages gives, however the files are split."""

import json
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlemill.operators.merge import last_arrived
from candlemill.operators.newest import newest_n
from candlemill.schemas import CANDLE_COLS, KEY
from candlemill.sources import arrival, feed
from candlemill.sources.landed import read_landed
from candlemill.streaming import live

NAMES = ["AAA", "BBB"]
T0 = datetime(2024, 1, 1)


def messages(seed, count=120, minutes=40):
    """Candle messages whose times jump about, so old candles are sent again late."""
    rng = np.random.default_rng(seed)
    rows = []
    for offset in range(count):
        body = {
            "type": "kline",
            "symbol": str(rng.choice(NAMES)),
            "timestamp": str(T0 + timedelta(minutes=int(rng.integers(0, minutes)))),
            "is_closed": bool(rng.random() < 0.5),
            "number_of_trades": offset,
            **dict.fromkeys(["open", "high", "low", "close", "volume"], offset / 4),
        }
        rows.append((offset, json.dumps(body)))
    return rows


def land(spark, path, rows, files):
    for part in range(files):
        chunk = rows[part::files]
        df = spark.createDataFrame(chunk, "offset long, value string").coalesce(1)
        df.write.mode("append").parquet(path)


def klines(spark, path, files_per_trigger=1):
    return live.kline_stream(read_landed(spark, path, files_per_trigger), NAMES)


def rows_of(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


JOBS = {
    "state": (live.live_candles, lambda b: last_arrived(b, "offset", KEY)),
    "latest": (live.latest_candle, lambda b: last_arrived(b, "offset", ["symbol"])),
    "retained": (
        lambda spark, cp, stream, *more: live.retained_candles(spark, cp, stream, 7, *more),
        lambda b: newest_n(last_arrived(b, "offset", KEY), 7),
    ),
}
SCHEMA = "offset long, value string"


def decoded(spark, rows, schema=SCHEMA):
    return feed.decode_klines(spark.createDataFrame(rows, schema), NAMES)


@pytest.mark.parametrize("job", JOBS)
def test_state_equals_batch_over_restarts(spark, scratch, job):
    make, batch_answer = JOBS[job]
    rows = messages(len(job))
    topic, checkpoint = scratch("topic"), scratch("cp")
    run = lambda cp, each=1: (lambda s: make(spark, cp, s).run(s))(klines(spark, topic, each))
    land(spark, topic, rows[:80], 2)
    first = run(checkpoint)
    assert rows_of(first) == rows_of(batch_answer(decoded(spark, rows[:80])).select(*first.columns))
    # New files, same checkpoint: goes on from the state it left.
    land(spark, topic, rows[80:], 1)
    second = run(checkpoint)
    assert rows_of(second) == rows_of(batch_answer(decoded(spark, rows)).select(*second.columns))
    # Records that are delivered again change nothing.
    land(spark, topic, rows[20:60], 1)
    assert rows_of(run(checkpoint)) == rows_of(second)
    # A fresh checkpoint replays the topic from its start to the same state.
    assert rows_of(run(scratch("cp"), None)) == rows_of(second)


@pytest.mark.parametrize("job", JOBS)
def test_changes_are_handed_on(spark, scratch, job):
    """What each micro-batch changed, written over what was handed on before, is the state."""
    make, _ = JOBS[job]
    topic, changes = scratch("topic"), scratch("changes")
    land(spark, topic, messages(7), 3)
    stream = klines(spark, topic)
    state = make(spark, scratch("cp"), stream, lambda rows, i: rows.withColumn("batch", F.lit(i)).write.mode("append").parquet(changes))
    got = state.run(stream)
    keys = ["symbol"] if job == "latest" else KEY
    handed = last_arrived(spark.read.parquet(changes), "batch", keys).drop("batch").select(*got.columns)
    handed = newest_n(handed, 7) if job == "retained" else handed
    assert rows_of(handed) == rows_of(got)


def unkeyed(rows, seed):
    """``rows`` over two partitions, their times repeated; the last third on a topic created anew."""
    rng = np.random.default_rng(seed)
    out, ends = [], [0, 0]
    for i, (_, value) in enumerate(rows):
        if i == 2 * len(rows) // 3:
            ends = [0, 0]
        part = int(rng.integers(0, 2))
        out.append((part, ends[part], T0 + timedelta(seconds=i // 5), value))
        ends[part] += 1
    return out


UNKEYED = "partition int, offset long, time timestamp_ntz, value string"


def land_unkeyed(spark, path, rows, files=2):
    for part in range(files):
        spark.createDataFrame(rows[part::files], UNKEYED).coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("job", JOBS)
def test_order_over_partitions_and_a_topic_created_anew(spark, scratch, job):
    make, _ = JOBS[job]
    sent = unkeyed(messages(21), 3)
    rows = decoded(spark, sent, UNKEYED).collect()
    keys = ["symbol"] if job == "latest" else KEY
    want = {}
    for r in sorted(rows, key=lambda r: (r.time, r.partition, r.offset)):
        want[tuple(r[k] for k in keys)] = r
    if job == "retained":
        for name in NAMES:
            for key in sorted((k for k in want if k[0] == name), reverse=True)[7:]:
                del want[key]
    topic = scratch("topic")
    land_unkeyed(spark, topic, sent[::-1], 3)
    stream = klines(spark, topic)
    got = make(spark, scratch("cp"), stream).run(stream)
    assert sorted(got.columns) == sorted(rows[0].__fields__)
    assert rows_of(got) == sorted((tuple(r[c] for c in sorted(r.__fields__)) for r in want.values()), key=str)


def test_arrival_orders_like_its_parts(spark):
    rows = [(p, o, t) for t in (None, T0, T0 + timedelta(microseconds=1)) for p in (None, 1, 99_999) for o in (0, 10**16)]
    df = spark.createDataFrame(rows[::-1], "partition int, offset long, time timestamp_ntz")
    got = arrival.with_arrival(df).orderBy("arrival").collect()
    assert [(r.partition, r.offset, r.time) for r in got] == rows
    zoned = arrival.with_arrival(df.withColumn("time", F.to_timestamp(F.col("time").cast("string")))).orderBy("arrival")
    assert [r.arrival for r in zoned.collect()] == [r.arrival for r in got]
    plain = spark.createDataFrame([(3,), (None,)], "offset long")
    assert {r.offset: r.arrival for r in arrival.with_arrival(plain).collect()} == {3: 3, None: None}


def test_records_delivered_twice_are_appended_once(spark, scratch):
    sent = unkeyed(messages(5), 1)
    topic = scratch("topic")
    land_unkeyed(spark, topic, sent + sent[10:50], 1)
    land_unkeyed(spark, topic, sent[-20:], 1)
    stream = arrival.one_delivery(read_landed(spark, topic, 1))
    got = live.append_stream(live.kline_stream(stream, NAMES), scratch("once"), scratch("cp"))
    assert rows_of(got) == rows_of(decoded(spark, sent, UNKEYED))


def closed(rows):
    """Per key the last closed candle, as the stored table shows it."""
    want = {}
    for r in sorted(rows, key=lambda r: (r.time, r.partition, r.offset)):
        if r.is_closed:
            want[r.symbol, r.timestamp] = r
    return sorted((tuple(r[c] for c in sorted(CANDLE_COLS)) for r in want.values()), key=str)


def test_resumed_replayed_and_uninterrupted_runs_agree(spark, scratch):
    sent = unkeyed(messages(31, 200), 8)
    want = closed(decoded(spark, sent, UNKEYED).collect())
    whole = scratch("topic")
    land_unkeyed(spark, whole, sent, 4)

    uninterrupted = live.ClosedCandles(spark, scratch("table"))
    assert rows_of(uninterrupted.run(klines(spark, whole), scratch("cp"))) == want
    # Replayed from the start with a fresh checkpoint, over the same table, and once more.
    for _ in range(2):
        assert rows_of(uninterrupted.run(klines(spark, whole, None), scratch("cp"))) == want

    # Stopped after some records; what comes later is on a topic whose head has expired.
    resumed = live.ClosedCandles(spark, scratch("table"))
    early, rest = scratch("topic"), scratch("topic")
    land_unkeyed(spark, early, sent[:90], 2)
    resumed.run(klines(spark, early), scratch("cp"))
    land_unkeyed(spark, rest, sent[60:], 2)
    fresh = arrival.after(read_landed(spark, rest, 1), resumed.marks())
    assert rows_of(resumed.run(live.kline_stream(fresh, NAMES), scratch("cp"))) == want


def test_marks_skip_what_the_table_has(spark, scratch):
    sent = [r for r in unkeyed(messages(13), 2)[:80]]  # one topic
    rows = arrival.with_arrival(spark.createDataFrame(sent, UNKEYED))
    marks = arrival.marks(rows.filter("(partition = 0 and offset <= 9) or (partition = 1 and offset <= 4)"))
    left = arrival.after(spark.createDataFrame(sent, UNKEYED), marks).collect()
    assert sorted((r.partition, r.offset) for r in left) == sorted((p, o) for p, o, _, _ in sent if o > (9, 4)[p])
    starts = json.loads(arrival.starting_offsets(marks, "t", 3))
    assert starts == {"t": {"0": 10, "1": 5, "2": -2}}
    assert arrival.after(spark.createDataFrame(sent, UNKEYED), marks.limit(0)).count() == len(sent)


def test_stored_candles_give_way_to_streamed_ones(spark, scratch, candles):
    stored = live.ClosedCandles(spark, scratch("table"))
    seeded = candles([("AAA", T0, 9.0, 9.0, 9.0, 9.0, 9.0, 9), ("ZZZ", T0, 8.0, 8.0, 8.0, 8.0, 8.0, 8)])
    stored.table.insert_ignore(seeded.withColumn("arrival", F.lit(None).cast("decimal(38,0)")))
    body = {"type": "kline", "symbol": "AAA", "timestamp": str(T0), "is_closed": True, "number_of_trades": 1}
    body.update(dict.fromkeys(["open", "high", "low", "close", "volume"], 1.0))
    topic = scratch("topic")
    land(spark, topic, [(0, json.dumps(body)), (1, json.dumps({**body, "is_closed": False, "close": 2.0}))], 1)
    got = stored.run(klines(spark, topic), scratch("cp"))
    assert {r.symbol: r.close for r in got.collect()} == {"AAA": 1.0, "ZZZ": 8.0}


def test_a_running_stream_can_be_read(spark, scratch):
    topic = scratch("topic")
    rows = messages(12)
    land(spark, topic, rows, 4)
    stream = klines(spark, topic)
    state = live.live_candles(spark, scratch("cp"), stream)
    assert state.read().isEmpty()
    query = state.start(stream, every="0 seconds")
    query.processAllAvailable()
    got = state.read()
    assert rows_of(got) == rows_of(last_arrived(decoded(spark, rows), "offset", KEY).select(*got.columns))
    query.stop()


def test_retention_bound(spark, scratch):
    topic, checkpoint = scratch("topic"), scratch("cp")
    rows = messages(4, 600, minutes=5000)
    land(spark, topic, rows, 3)
    stream = klines(spark, topic)
    state = live.retained_candles(spark, checkpoint, stream, 5)
    counts = state.run(stream).groupBy("symbol").count().collect()
    assert [r["count"] for r in counts] == [5, 5]
    # So is what the state itself holds, however long the stream has run.
    assert state._state(stateVarName="newest").count() <= 2 * 5 * live.SALTS


def test_stream_without_messages(spark, scratch):
    topic = scratch("topic")
    land(spark, topic, [(0, "{bad")], 1)
    stream = klines(spark, topic)
    assert live.live_candles(spark, scratch("cp"), stream).run(stream).isEmpty()


def test_tickers_by_arrival(spark, scratch):
    envelope = lambda s, p: json.dumps({"stream": f"{s}@ticker", "data": {"c": p, "P": "0", "v": "1"}})
    rows = [(0, envelope("aaa", "1")), (1, envelope("bbb", "2")), (2, envelope("aaa", "3"))]
    topic = scratch("topic")
    land(spark, topic, rows[::-1], 3)
    stream = live.ticker_stream(read_landed(spark, topic, 1))
    got = live.latest_ticker(spark, scratch("cp"), stream).run(stream).collect()
    assert {r.symbol: r.price for r in got} == {"AAA": 3.0, "BBB": 2.0}
