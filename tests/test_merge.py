from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from candlemill.operators import merge

T0 = datetime(2024, 1, 1)


def row(symbol, minute, close):
    return (symbol, T0 + timedelta(minutes=minute), close, close, close, close, close, int(close))


def table(df):
    return {(r.symbol, r.timestamp): r.close for r in df.collect()}


def with_order(candles, rows):
    """Rows numbered in the given order."""
    df = candles([r for r in rows])
    numbered = [(*r, i) for i, r in enumerate(rows)]
    return df.sparkSession.createDataFrame(numbered, df.schema.add("arrival", "long"))


def test_first_and_last_write(candles):
    target = candles([row("A", 0, 1.0), row("A", 1, 2.0)])
    batch = with_order(candles, [row("A", 1, 8.0), row("A", 2, 3.0), row("A", 2, 4.0)])
    key = lambda m: ("A", T0 + timedelta(minutes=m))
    ignored = merge.insert_ignore(target, batch, "arrival")
    assert table(ignored) == {key(0): 1.0, key(1): 2.0, key(2): 3.0}
    updated = merge.upsert(target, batch, "arrival")
    assert table(updated) == {key(0): 1.0, key(1): 8.0, key(2): 4.0}
    assert updated.count() == 3 and ignored.count() == 3


def test_upsert_writes_nulls_too(candles):
    target = candles([row("A", 0, 1.0)])
    blank = candles([("A", T0, None, None, None, None, None, None)])
    assert merge.upsert(target, blank).first().close is None


changes = st.lists(
    st.tuples(st.sampled_from("AB"), st.integers(0, 4), st.integers(1, 99)), min_size=1, max_size=12
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(old=changes, new=changes, cut=st.integers(0, 12))
def test_merge_properties(candles, old, new, cut):
    stored = {(s, m): float(v) for s, m, v in old}
    target = candles([row(s, m, v) for (s, m), v in stored.items()])
    rows = [row(s, m, float(v)) for s, m, v in new]
    batch = with_order(candles, rows)
    once = merge.upsert(target, batch, "arrival")
    assert table(merge.upsert(once, batch, "arrival")) == table(once)
    # The same as two batches, split anywhere.
    early = batch.filter(F.col("arrival") < cut)
    late = batch.filter(F.col("arrival") >= cut)
    halves = merge.upsert(merge.upsert(target, early, "arrival"), late, "arrival")
    assert table(halves) == table(once)
    kept = table(merge.insert_ignore(target, batch, "arrival"))
    before = table(target)
    assert {k: kept[k] for k in before} == before
    assert set(kept) == set(table(once))


@pytest.mark.parametrize("n", [1, 3, 50])
def test_live_over_stored_cut_early_or_late(candles, n):
    stored = candles([row(s, m, 1.0) for s in "AB" for m in range(0, 30, 2)])
    live = candles([row(s, m, 2.0) for s in "AC" for m in range(10, 40, 3)])
    live = live.withColumn("is_closed", F.lit(False))
    whole = table(merge.live_over_stored(stored, live))
    want = {}
    for symbol in "ABC":
        times = sorted((k for k in whole if k[0] == symbol), reverse=True)[:n]
        want.update({k: whole[k] for k in times})
    assert table(merge.live_over_stored(stored, live, n)) == want


def test_either_side_empty(candles):
    some = candles([row("A", 0, 1.0)])
    none = candles([])
    flag = F.lit(True)
    assert merge.live_over_stored(none, some.withColumn("is_closed", flag)).count() == 1
    assert merge.live_over_stored(some, none.withColumn("is_closed", flag)).count() == 1


def test_rows_added(candles):
    target = candles([row("A", 0, 1.0)])
    batch = candles([row("A", 0, 2.0), row("A", 1, 2.0), row("B", 1, 2.0)])
    got = merge.rows_added(merge.new_rows(target, batch)).collect()
    assert {r.symbol: r.rows_added for r in got} == {"A": 1, "B": 1}
