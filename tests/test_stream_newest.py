"""Features of closed candles and the chart, kept by micro-batches."""

import json
from datetime import timedelta

import pytest
from frames import random_rows
from pyspark.sql import functions as F
from test_streams import NAMES, T0, decoded, klines, land, messages, rows_of

from candlemill.operators.features import SERVE_HISTORY, serve_features, serve_features_so_far
from candlemill.operators.merge import last_arrived, live_over_stored
from candlemill.operators.newest import newest_n
from candlemill.schemas import CANDLE_COLS, CANDLE_SCHEMA, KEY, MINUTE_MS
from candlemill.sinks.candle_table import CandleTable
from candlemill.sinks.files import names
from candlemill.streaming.newest import ClosedFeatures, LiveChart


def sent(rows, closed=True):
    """Candle messages of ``rows``, in the order of their times."""
    out = []
    for row in sorted(rows, key=lambda r: r[1]):
        body = dict(zip(CANDLE_COLS, row))
        body["timestamp"] = str(body["timestamp"])
        out.append({**body, "type": "kline", "is_closed": closed})
    return [(i, json.dumps(body)) for i, body in enumerate(out)]


def land_in_order(spark, path, rows, files):
    """File i holds earlier messages than file i + 1 and is older."""
    size = -(-len(rows) // files)
    for at in range(0, len(rows), size):
        land(spark, path, rows[at : at + size], 1)


def rounded(df):
    columns = [F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in sorted(df.dtypes)]
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


SIZES = {"AAA": 170, "BBB": 40}
CANDLES = random_rows(5, SIZES)
HOLED = random_rows(5, SIZES, p_null=0.2)  # a topic message without close would be rejected


@pytest.mark.parametrize("files, slice_bars", [(1, 10_080), (6, 16)])
def test_features_do_not_depend_on_batches(spark, scratch, candles, files, slice_bars):
    topic = scratch("topic")
    land_in_order(spark, topic, sent(CANDLES), files)
    got = ClosedFeatures(spark, scratch("features"), MINUTE_MS, slice_bars).run(klines(spark, topic))
    want = serve_features_so_far(candles(CANDLES), slice_bars=None)
    assert rounded(got) == rounded(want.select(*got.columns))


@pytest.mark.parametrize("slice_bars", [7, 64, None])
def test_past_warm_up_they_are_the_serving_features(candles, slice_bars):
    df = candles(random_rows(6, {"AAA": 150, "BBB": 5}))
    got = serve_features_so_far(df, slice_bars=slice_bars)
    want = serve_features(df).select(*got.columns)
    first = df.groupBy("symbol").agg(F.sort_array(F.collect_list("timestamp")).alias("t"))
    start = first.select("symbol", F.try_element_at("t", F.lit(6)).alias("from"))
    late = lambda rows: rows.join(start, "symbol").filter("timestamp >= from").drop("from")
    assert rounded(late(got)) == rounded(late(want)) and late(got).count() == 145


def test_a_missing_lag_takes_the_value_before_it(candles):
    at = [T0 + timedelta(minutes=i) for i in range(4)]
    rows = [("A", t, 1.0, 1.0, 1.0, c, 1.0, 1) for t, c in zip(at, [5.0, None, None, 8.0])]
    got = serve_features_so_far(candles(rows)).orderBy("timestamp").collect()
    assert [r.lag_close_1 for r in got] == [0.0, 5.0, 5.0, 5.0]
    assert [r.lag_close_3 for r in got] == [0.0, 0.0, 0.0, 5.0]


def test_each_candle_has_its_turn_once(spark, scratch):
    topic, path = scratch("topic"), scratch("features")
    rows = sent(random_rows(7, {"AAA": 30}))
    land_in_order(spark, topic, rows, 2)
    first = rows_of(ClosedFeatures(spark, path).run(klines(spark, topic)))
    # Delivered again, and sent late: the candles' turn is over.
    late = json.dumps({**json.loads(rows[0][1]), "timestamp": str(T0 - timedelta(days=1))})
    land(spark, topic, rows[5:15] + [(90, late)], 1)
    unfinished = json.dumps({**json.loads(rows[-1][1]), "timestamp": str(T0 + timedelta(days=1)), "is_closed": False})
    land(spark, topic, [(91, unfinished)], 1)
    # A restarted stream goes on.
    after = ClosedFeatures(spark, path)
    assert rows_of(after.run(klines(spark, topic))) == first and len(first) == 30
    assert after.history.read().count() == min(30, SERVE_HISTORY)
    assert len([n for n in names(spark, f"{path}/history") if n.isdigit()]) == 2


def test_a_batch_that_is_run_again_changes_nothing(spark, scratch, candles):
    job = ClosedFeatures(spark, scratch("features"))
    batch = candles(HOLED).withColumns({"is_closed": F.lit(True), "offset": F.lit(1)})
    early = F.col("timestamp") < F.lit(str(T0 + timedelta(hours=3))).cast("timestamp_ntz")
    for batch_id, part in [(0, early), (1, ~early), (1, ~early)]:
        job.write(batch.filter(part), batch_id)
    want = serve_features_so_far(candles(HOLED), slice_bars=None)
    assert rounded(job.read()) == rounded(want.select(*job.read().columns))


def test_no_closed_candles(spark, scratch):
    topic = scratch("topic")
    land(spark, topic, [(0, "{bad")], 1)
    job = ClosedFeatures(spark, scratch("features"))
    assert job.read().isEmpty()
    assert job.run(klines(spark, topic)).isEmpty()


@pytest.fixture
def stored(spark, scratch, candles):
    table = CandleTable(spark, scratch("table"))
    old = [(s, T0 + timedelta(minutes=m), *[1.0] * 5, 1) for s in ["AAA", "ZZZ"] for m in range(-15, 20)]
    table.insert_ignore(candles(old))
    return table


def test_chart_by_changes_is_the_whole_chart(spark, scratch, stored):
    topic, path = scratch("topic"), scratch("chart")
    rows = messages(9)
    land(spark, topic, rows[:80], 3)
    shown = LiveChart(spark, path, stored, 12)
    assert shown.read().count() == 24  # before the stream: what is stored
    stream = klines(spark, topic)
    expected = lambda sent: live_over_stored(
        stored.read(), last_arrived(decoded(spark, sent), "offset", KEY).select(*CANDLE_COLS, "is_closed"), 12
    )
    got = shown.run(stream)
    assert rows_of(got) == rows_of(expected(rows[:80]).select(*got.columns))
    # The stored side has moved on when the stream starts again.
    more = [("ZZZ", T0 + timedelta(days=1), *[2.0] * 5, 2), ("AAA", T0 + timedelta(minutes=38), *[2.0] * 5, 2)]
    stored.insert_ignore(spark.createDataFrame(more, CANDLE_SCHEMA))
    land(spark, topic, rows[80:], 2)
    got = LiveChart(spark, path, stored, 12).run(stream)
    assert rows_of(got) == rows_of(expected(rows).select(*got.columns))


def test_chart_of_an_empty_table(spark, scratch):
    topic = scratch("topic")
    rows = messages(10, 30)
    land(spark, topic, rows, 2)
    table = CandleTable(spark, scratch("table"))
    shown = LiveChart(spark, scratch("chart"), table, 5)
    assert shown.read().isEmpty()
    got = shown.run(klines(spark, topic))
    want = newest_n(last_arrived(decoded(spark, rows), "offset", KEY), 5).select(*got.columns)
    assert rows_of(got) == rows_of(want) and {r.symbol for r in got.collect()} == set(NAMES)
