"""Landed REST pages: one JSON array of 12-element rows per record."""

from pyspark.sql import functions as F

from candlemill.functions.numeric import number
from candlemill.functions.timefn import from_epoch_ms
from candlemill.schemas import CANDLE_COLS, PRICES, REST_PAGE_TYPE, REST_POSITIONS


def decode_pages(pages):
    """``(symbol, value)`` pages to candles, plus the two bar times in milliseconds.

    Text that is no JSON array gives no rows. A cell that does not read as its
    type is NULL; a row without a readable open time is dropped, as it has no key.
    """
    rows = pages.select(
        "symbol", F.explode(F.from_json("value", REST_PAGE_TYPE)).alias("cells")
    )
    cell = {name: F.get("cells", F.lit(at)) for name, at in REST_POSITIONS.items()}
    named = rows.select(
        "symbol",
        number(cell["open_time"], "long").alias("open_ms"),
        number(cell["close_time"], "long").alias("close_ms"),
        *[number(cell[c]).alias(c) for c in PRICES],
        number(cell["number_of_trades"], "long").alias("number_of_trades"),
    )
    timed = named.withColumn("timestamp", from_epoch_ms("open_ms"))
    return timed.filter(F.col("timestamp").isNotNull()).select(
        *CANDLE_COLS, "open_ms", "close_ms"
    )


def rejected_pages(pages):
    """Pages that are no JSON array, and single rows without a readable open time."""
    parsed = pages.withColumn("rows", F.from_json("value", REST_PAGE_TYPE))
    whole = parsed.filter(F.col("rows").isNull()).select(
        "symbol", "value", F.lit("no page").alias("reason")
    )
    rows = parsed.select("symbol", F.explode("rows").alias("cells"))
    open_ms = number(F.get("cells", F.lit(REST_POSITIONS["open_time"])), "long")
    bad = rows.filter(from_epoch_ms(open_ms).isNull())
    return whole.unionByName(bad.select("symbol", F.to_json("cells").alias("value"), F.lit("bad time").alias("reason")))


def closed_only(rows, now_ms, interval_ms):
    """Bars that had ended by ``now_ms``."""
    return rows.filter(F.col("open_ms") <= F.lit(now_ms - interval_ms))
