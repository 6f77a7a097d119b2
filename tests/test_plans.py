"""What the physical plans must look like at any scale."""

import re

import pytest
from frames import random_rows
from pyspark.sql import functions as F

from candlemill.operators import features, gaps, merge, newest, signals
from candlemill.schemas import CANDLE_SCHEMA
from candlemill.sources import feed


@pytest.fixture
def stored(spark, candles, scratch):
    path = scratch("candles")
    candles(random_rows(1, {"A": 300, "B": 50})).write.parquet(path)
    return spark.read.schema(CANDLE_SCHEMA).parquet(path)


def plan(df):
    """The plan before adaptive changes."""
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]


def count(text, node):
    return len(re.findall(rf"\b{node}\b", text))


def test_features_shuffle_rows_once(stored):
    text = plan(features.training_set(stored))
    # The rows, planned at their two uses and shared when run, and the copied edge rows.
    by_slice = re.findall(r"Exchange hashpartitioning\(symbol#\d+, _slice#\d+L, \d+\), REPARTITION", text)
    assert len(by_slice) == 3
    assert not re.search(r"Exchange SinglePartition", text)
    after_union = text.split("Union")[0]
    assert "Exchange" not in after_union and after_union.count("Window") == 1


def test_rows_are_reused_when_run(stored):
    df = features.training_set(stored)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final


def test_no_python_in_any_plan(stored, spark):
    symbols = spark.createDataFrame([("A",)], "symbol string")
    for df in [
        features.serve_features(stored),
        signals.rule_latest(stored, symbols, "2024-01-01 00:00:00"),
        signals.backtest(stored),
        gaps.missing_bars(stored),
        merge.upsert(stored, stored),
    ]:
        assert not re.search(r"Python|Pandas|BatchEval", plan(df))


def test_newest_n_is_cut_before_the_shuffle(stored):
    text = plan(newest.newest_n(stored, 100))
    assert count(text, "WindowGroupLimit") >= 3
    below = text[text.rindex("Exchange") :]
    assert "WindowGroupLimit" in below  # on the scan's side of the first shuffle


def test_filters_and_columns_reach_the_scan(stored):
    text = plan(newest.newest_n_of(stored, "A", 10).select("timestamp", "close"))
    assert "EqualTo(symbol,A)" in text
    assert re.search(r"ReadSchema: struct<symbol:string,timestamp:timestamp_ntz,close:double>", text)
    text = plan(gaps.missing_bars(stored))
    assert "close" not in text


def test_small_batch_does_not_shuffle_the_table(stored, spark, candles, scratch):
    batch = candles(random_rows(2, {"A": 5})).withColumn("arrival", F.monotonically_increasing_id())
    path = scratch("batch")
    batch.write.parquet(path)
    batch = spark.read.parquet(path)
    for df in [merge.upsert(stored, batch, "arrival"), merge.new_rows(stored, batch, "arrival")]:
        lines = plan(df).splitlines()
        below = [b for a, b in zip(lines, lines[1:]) if "Exchange hashpartitioning" in a]
        # Shuffles serve only to reduce the batch itself.
        assert below and all("HashAggregate" in line and "partial" in line or "functions=[]" in line for line in below)
        assert any("BroadcastHashJoin" in line for line in lines)


def test_feed_text_is_parsed_once(spark):
    raw = spark.createDataFrame([(0, "{}")], "offset long, value string").repartition(2)
    for df in [feed.demux_klines(raw), feed.demux_tickers(raw), feed.publish(raw)]:
        assert count(plan(df), "from_json") == 1
    assert count(plan(feed.decode_klines(raw, ["A"])), "from_json") == 1


def test_large_batch_is_not_broadcast(stored, spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        df = merge.upsert(stored, stored)
        assert df.count() == 350
        assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
