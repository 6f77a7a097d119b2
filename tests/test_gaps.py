import json
from datetime import datetime, timedelta

import numpy as np
import pytest

from candlemill.functions.timefn import epoch_ms
from candlemill.operators import gaps
from candlemill.plans.refresh import fill_gaps
from candlemill.sinks.candle_table import CandleTable
from candlemill.sources.rest import closed_only, decode_pages, rejected_pages

T0 = datetime(2024, 1, 1)
T0_MS = 1_704_067_200_000
MIN = 60_000


def row(symbol, minute, close=1.0):
    return (symbol, T0 + timedelta(minutes=minute), 1.0, 1.0, 1.0, close, 1.0, 1)


def symbols(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "symbol string")


@pytest.mark.parametrize("late_ms, due", [(MIN, False), (MIN + 1, True), (0, False)])
def test_tail_plan_needs_a_whole_interval(spark, candles, late_ms, due):
    plan = gaps.tail_plan(candles([row("A", 0)]), symbols(spark, "A", "NONE"), T0_MS + late_ms)
    got = {r.symbol: r for r in plan.collect()}
    assert got["A"].start_ms == T0_MS + 1 and got["A"].needed is due
    assert got["NONE"].start_ms is None and got["NONE"].needed is False


def test_startup_plan(spark, candles):
    plan = gaps.startup_plan(candles([row("A", 0), row("A", 3)]), symbols(spark, "A", "NONE"))
    got = {r.symbol: r.start_ms for r in plan.collect()}
    assert got == {"A": T0_MS + 4 * MIN, "NONE": 1_672_531_200_000}


@pytest.mark.parametrize("elapsed", [MIN + 1, 2 * MIN, 4 * MIN, 4 * MIN + 1, 7 * MIN + 5, 31 * MIN])
def test_page_plan_walks_like_a_request_loop(spark, candles, elapsed):
    now, page_bars = T0_MS + elapsed, 3
    plan = gaps.tail_plan(candles([row("A", 0)]), symbols(spark, "A"), now)
    got = gaps.page_plan(plan, now, MIN, page_bars).orderBy("page").collect()
    # Ask for pages of bars that exist at every minute, until the next start is not in the past.
    want, start = [], T0_MS + 1
    while start < now:
        want.append(start)
        first = -(-(start - T0_MS) // MIN)
        start = T0_MS + (first + page_bars) * MIN
    assert [r.start_ms for r in got] == want
    assert [r.page for r in got] == list(range(len(want)))


def test_missing_bars_across_long_holes(candles, monkeypatch):
    monkeypatch.setattr(gaps, "RUN_BARS", 10)
    have = [0, 1, 2, 5, 6, 40, 41, 1000]
    df = candles([row("A", m) for m in have] + [row("B", 7)])
    for slice_bars in [4, 10_080]:
        got = gaps.missing_bars(df, MIN, slice_bars)
        minutes = sorted((r.timestamp - T0) // timedelta(minutes=1) for r in got.collect())
        assert minutes == sorted(set(range(1000)) - set(have))


def page(*opens, close="2.5", trades=4):
    rows = [
        [T0_MS + m * MIN, "1.0", "3.0", "0.5", close, "9", T0_MS + m * MIN + 59_999, "0", trades, "0", "0", "0"]
        for m in opens
    ]
    return json.dumps(rows)


def test_decode_pages(spark):
    texts = [("A", page(1, 2)), ("B", page(3, close="x")), ("C", "{bad"), ("D", "[]"), ("E", '[["oops"]]')]
    got = decode_pages(spark.createDataFrame(texts, "symbol string, value string")).collect()
    assert {(r.symbol, r.open_ms) for r in got} == {
        ("A", T0_MS + MIN),
        ("A", T0_MS + 2 * MIN),
        ("B", T0_MS + 3 * MIN),
    }
    first = next(r for r in got if r.open_ms == T0_MS + MIN)
    assert first.timestamp == T0 + timedelta(minutes=1) and first.number_of_trades == 4
    assert first.close == 2.5 and first.close_ms == T0_MS + 2 * MIN - 1
    assert next(r for r in got if r.symbol == "B").close is None


def test_unfinished_bars_are_left_out(spark):
    rows = decode_pages(spark.createDataFrame([("A", page(1, 2, 3))], "symbol string, value string"))
    kept = closed_only(rows, T0_MS + 3 * MIN, MIN).collect()
    assert sorted(r.open_ms for r in kept) == [T0_MS + MIN, T0_MS + 2 * MIN]


def test_fill_gaps_keeps_stored_rows(spark, candles, scratch):
    table = CandleTable(spark, scratch("table"))
    table.insert_ignore(candles([row("A", 0), row("A", 1, 7.0)]))
    pages = spark.createDataFrame([("A", page(1, 2)), ("A", page(2, 3, 4))], "symbol string, value string")
    added = fill_gaps(table, pages, T0_MS + 4 * MIN + 5, MIN)
    minutes = lambda df: {(r.ms - T0_MS) // MIN: r.close for r in df.select("*", epoch_ms("timestamp").alias("ms")).collect()}
    assert minutes(added) == {2: 2.5, 3: 2.5}
    got = minutes(table.read())
    assert got == {0: 1.0, 1: 7.0, 2: 2.5, 3: 2.5}


def fewest_pages(missing, span):
    pages = []
    for at in sorted(missing):
        if not pages or at >= pages[-1][0] + span:
            pages.append([at, at, 0])
        pages[-1][1], pages[-1][2] = at, pages[-1][2] + 1
    return pages


@pytest.mark.parametrize("page_bars, slice_bars", [(1, 40), (7, 40), (1000, 4000)])
def test_holes_are_covered_by_the_fewest_pages(spark, candles, page_bars, slice_bars):
    """Holes of a bar to thousands, near each other and far apart; one symbol without any."""
    rng = np.random.default_rng(page_bars)
    have = {"A": set(), "B": set(range(30)), "C": {0, 5000}, "D": {3}}
    minute = 0
    for _ in range(600):
        minute += 1 + int(rng.random() < 0.2) * int(rng.integers(1, 30)) + int(rng.random() < 0.01) * 2500
        have["A"].add(minute)
    stored = candles([row(s, m) for s, minutes in have.items() for m in sorted(minutes)]).repartition(5)
    got = {}
    for r in gaps.hole_pages(stored, MIN, page_bars, slice_bars).orderBy("symbol", "start_ms").collect():
        got.setdefault(r.symbol, []).append([(r.start_ms - T0_MS) // MIN, (r.last_ms - T0_MS) // MIN, r.n_missing])
    want = {s: fewest_pages(set(range(min(m), max(m))) - m, page_bars) for s, m in have.items()}
    assert got == {s: p for s, p in want.items() if p}
    assert gaps.hole_pages(candles([]), MIN).isEmpty()


def test_rejected_pages(spark):
    pages = [("A", page(1, 2)), ("A", "{cut"), ("B", None), ("B", '[["x","1"],[null],[1,"2"]]')]
    got = rejected_pages(spark.createDataFrame(pages, "symbol string, value string")).collect()
    assert sorted((r.symbol, r.value or "", r.reason) for r in got) == [
        ("A", "{cut", "no page"), ("B", "", "no page"), ("B", '["x","1"]', "bad time"), ("B", "[null]", "bad time"),
    ]
