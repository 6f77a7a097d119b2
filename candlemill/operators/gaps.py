"""Missing bars: what to fetch, and what to do with the fetched pages."""

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from candlemill.functions.timefn import epoch_ms, from_epoch_ms
from candlemill.operators.merge import new_rows
from candlemill.operators.newest import latest_timestamp, per_symbol
from candlemill.operators.slices import SLICE_BARS, windowed
from candlemill.schemas import EMPTY_START_MS, MINUTE_MS, PAGE_BARS
from candlemill.sources.rest import closed_only, decode_pages

RUN_BARS = 10_000

# Tasks get this module by value, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _latest(candles, symbols):
    rows = per_symbol(symbols.select("symbol"), latest_timestamp(candles))
    return rows.select("symbol", epoch_ms("max_timestamp").alias("latest_ms"))


def tail_plan(candles, symbols, now_ms, interval_ms=MINUTE_MS):
    """Scheduled variant: where each symbol's fetch starts and whether one is due.

    A symbol without candles is not fetched; it needs a seed first.
    """
    start = F.col("latest_ms") + 1
    due = F.coalesce(F.lit(now_ms) - start >= F.lit(interval_ms), F.lit(False))
    return _latest(candles, symbols).select(
        "symbol", "latest_ms", start.alias("start_ms"), due.alias("needed")
    )


def startup_plan(candles, symbols, interval_ms=MINUTE_MS, empty_start_ms=EMPTY_START_MS):
    """Start-up variant: one request per symbol, from a fixed time when it has no candles."""
    start = F.coalesce(F.col("latest_ms") + F.lit(interval_ms), F.lit(empty_start_ms))
    return _latest(candles, symbols).select("symbol", "latest_ms", start.alias("start_ms"))


def _runs(rows, first, count, run=RUN_BARS):
    """``count`` consecutive numbers from ``first`` per row, as column ``at``.

    Two short explodes instead of one, so no row ever holds a long array.
    """
    last_run = F.floor((count - 1) / F.lit(run)).cast("long")
    outer = rows.withColumn("_n", count).filter(F.col("_n") > 0).withColumn(
        "_run", F.explode(F.sequence(F.lit(0).cast("long"), last_run))
    )
    offset = F.col("_run") * F.lit(run)
    end = F.least(F.col("_n"), offset + F.lit(run)) - 1
    inner = outer.withColumn("_at", F.explode(F.sequence(offset, end)))
    return inner.withColumn("at", first + F.col("_at")).drop("_n", "_run", "_at")


def page_plan(plan, now_ms, interval_ms=MINUTE_MS, page_bars=PAGE_BARS):
    """One row per page request of the symbols that are due.

    The first page starts at the plan's start, each later one right after the
    last bar of the page before.
    """
    span = F.lit(now_ms - interval_ms - 1) - F.col("latest_ms")
    pages = F.floor(span / F.lit(page_bars * interval_ms)).cast("long") + 1
    rows = _runs(plan.filter("needed"), F.lit(0).cast("long"), pages)
    next_start = F.col("latest_ms") + (F.col("at") * F.lit(page_bars) + 1) * F.lit(interval_ms)
    start = F.when(F.col("at") == 0, F.col("start_ms")).otherwise(next_start)
    return rows.select("symbol", F.col("at").alias("page"), start.alias("start_ms"))


def fetched_rows(candles, pages, now_ms, interval_ms=MINUTE_MS):
    """Rows of the landed pages that the table lacks; unfinished bars are left out.

    Pages may overlap; a closed bar reads the same on each page that shows it.
    """
    closed = closed_only(decode_pages(pages), now_ms, interval_ms)
    return new_rows(candles, closed)


def _wide_pairs(candles, interval_ms, slice_bars):
    """Neighbouring candles of a symbol that lie more than a bar apart, and the bars between."""
    add = lambda df, w: df.withColumn("_next", F.lead("timestamp").over(w))
    keys = candles.select("symbol", "timestamp")
    pairs = windowed(keys, add, 0, 1, interval_ms, slice_bars).select(
        "symbol",
        epoch_ms("timestamp").alias("_ms"),
        epoch_ms("_next").alias("_next_ms"),
    )
    # Bars strictly between the two.
    holes = F.floor((F.col("_next_ms") - F.col("_ms") - 1) / F.lit(interval_ms)).cast("long")
    wide = pairs.filter(F.col("_next_ms") - F.col("_ms") > interval_ms)
    return wide.withColumn("_holes", holes).filter("_holes > 0")


def missing_bars(candles, interval_ms=MINUTE_MS, slice_bars=SLICE_BARS):
    """Bar times absent between two stored candles of a symbol."""
    rows = _runs(_wide_pairs(candles, interval_ms, slice_bars), F.lit(1).cast("long"), F.col("_holes"))
    missing = from_epoch_ms(F.col("_ms") + F.col("at") * F.lit(interval_ms))
    return rows.select("symbol", missing.alias("timestamp"))


def _fewest_pages(interval_ms, page_bars):
    """Task: runs of missing bars, sorted within each stretch, to the requests that cover them."""
    span = interval_ms * page_bars

    def run(frames):
        stretch, page = None, None
        for frame in frames:
            done = []
            for symbol, number, first, last in zip(frame["symbol"], frame["stretch"], frame["first_ms"], frame["last_ms"]):
                if (symbol, number) != stretch:
                    done += [page] if page else []
                    stretch, page = (symbol, number), None
                at = first
                while at <= last:
                    if page is None or at >= page[1] + span:
                        done += [page] if page else []
                        page = [symbol, at, at, 0]
                    end = min(last, at + (page[1] + span - interval_ms - at) // interval_ms * interval_ms)
                    page[2], page[3] = end, page[3] + (end - at) // interval_ms + 1
                    at = end + interval_ms
            yield pd.DataFrame(done, columns=["symbol", "start_ms", "last_ms", "n_missing"])
        if page:
            yield pd.DataFrame([page], columns=["symbol", "start_ms", "last_ms", "n_missing"])

    return run


def hole_pages(candles, interval_ms=MINUTE_MS, page_bars=PAGE_BARS, slice_bars=SLICE_BARS):
    """The fewest requests of at most ``page_bars`` bars that cover the bars missing between
    stored candles: ``(symbol, start_ms, last_ms, n_missing)``.

    Each request starts at the first missing bar that none before it covers. Holes further
    apart than a request reaches never share one, so a symbol's holes fall into stretches that
    are covered independently; a task reads runs of missing bars, not bars, one after the other.
    """
    runs = _wide_pairs(candles, interval_ms, slice_bars).select(
        "symbol",
        (F.col("_ms") + F.lit(interval_ms)).alias("first_ms"),
        (F.col("_ms") + F.col("_holes") * F.lit(interval_ms)).alias("last_ms"),
    )
    of_symbol = W.partitionBy("symbol").orderBy("first_ms")
    far = F.col("first_ms") - F.lag("last_ms").over(of_symbol) >= F.lit(interval_ms * page_bars)
    runs = runs.withColumn("far", F.coalesce(far.cast("long"), F.lit(0).cast("long")))
    runs = runs.withColumn("stretch", F.sum("far").over(of_symbol)).drop("far")
    dealt = runs.repartition("symbol", "stretch").sortWithinPartitions("symbol", "stretch", "first_ms")
    return dealt.mapInPandas(_fewest_pages(interval_ms, page_bars), "symbol string, start_ms long, last_ms long, n_missing long")
