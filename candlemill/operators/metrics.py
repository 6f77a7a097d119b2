"""Headline numbers of the newest candle per symbol."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from candlemill.functions.numeric import money_text, percent_of, signed_percent_text
from candlemill.operators.newest import newest_n

# The status texts.
CLOSED = "CLOSED"
LIVE = "LIVE STREAM 🟢"
WAITING = "Kafka Streaming..."


def status_text(has_live, is_closed):
    closed = F.coalesce(is_closed, F.lit(False))
    return F.when(~has_live, WAITING).when(closed, CLOSED).otherwise(LIVE)


def candle_metrics(merged, latest_live):
    """Newest candle, change against the previous close, display texts and status.

    ``merged`` holds the candles shown; ``latest_live`` the newest message per symbol.
    A symbol's only candle is compared with its own open.
    """
    w = W.partitionBy("symbol").orderBy("timestamp")
    two = newest_n(merged.select("symbol", "timestamp", "open", "high", "low", "close"), 2)
    with_previous = two.withColumns(
        {
            "_before": F.lag("close").over(w),
            "_at": F.row_number().over(w),
            "_later": F.lead("timestamp").over(w),
        }
    )
    newest = with_previous.filter(F.col("_later").isNull()).withColumn(
        "previous_close",
        F.when(F.col("_at") > 1, F.col("_before")).otherwise(F.col("open")),
    )
    difference = F.col("close") - F.col("previous_close")
    change = newest.withColumn("difference", difference).withColumn(
        "percentage", percent_of(F.col("difference"), F.col("previous_close"))
    )
    live = latest_live.select("symbol", F.lit(True).alias("_live"), "is_closed")
    joined = change.join(live, "symbol", "left")
    has_live = F.coalesce(F.col("_live"), F.lit(False))
    return joined.select(
        "symbol",
        "timestamp",
        "open",
        "high",
        "low",
        "close",
        "previous_close",
        "difference",
        "percentage",
        money_text(F.col("close")).alias("close_text"),
        signed_percent_text(F.col("percentage")).alias("change_text"),
        money_text(F.col("open")).alias("open_text"),
        money_text(F.col("high")).alias("high_text"),
        money_text(F.col("low")).alias("low_text"),
        status_text(has_live, F.col("is_closed")).alias("status"),
    )
