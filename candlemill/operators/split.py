"""Time split of a training set at a quantile of all candle times."""

from decimal import Decimal

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from candlemill.functions.timefn import epoch_s

SPLIT_AT = 0.8
DAY_S = 86_400
#: Size of a sketch: 4,000 times give ranks within some 0.1 %.
SKETCH_K = 4000


def with_ts_unix(df):
    return df.withColumn("ts_unix", epoch_s("timestamp"))


def exact_quantile(df, q=SPLIT_AT, block_s=DAY_S):
    """One row: the smallest ``ts_unix`` that at least a share ``q`` of the rows does not exceed.

    Times are counted per day first. The running total over days picks the day
    that holds the answer; only that day's distinct times are ordered. Either step
    orders at most one row per day, or per second of one day, whatever the number
    of rows.
    """
    block = F.floor(F.col("ts_unix") / F.lit(block_s)).cast("long")
    times = df.select("ts_unix").withColumn("block", block)
    per_day = times.groupBy("block").agg(F.count("*").alias("n"))
    everything = W.partitionBy(F.lit(0))
    running = W.orderBy("block").rowsBetween(W.unboundedPreceding, 0)
    share = F.lit(Decimal(str(q)))  # decimal, so the rank is exact
    days = per_day.withColumns(
        {"upto": F.sum("n").over(running), "total": F.sum("n").over(everything)}
    ).withColumn("needed", F.ceil(F.col("total").cast("decimal(20,0)") * share).cast("long"))
    day = days.filter(F.col("upto") >= F.col("needed")).orderBy("block").limit(1)
    rank = day.select(F.col("needed") - (F.col("upto") - F.col("n"))).scalar()
    within = times.filter(F.col("block") == day.select("block").scalar())
    per_time = within.groupBy("ts_unix").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(W.orderBy("ts_unix").rowsBetween(W.unboundedPreceding, 0))
    reached = per_time.withColumn("upto", upto).filter(F.col("upto") >= rank)
    return reached.agg(F.min("ts_unix").alias("split_ts"))


def approx_quantile(df, q=SPLIT_AT, accuracy=10_000):
    """One row: the quantile from a fixed-size sketch, in a single pass."""
    return df.agg(F.percentile_approx("ts_unix", q, accuracy).alias("split_ts"))


def time_sketches(df, k=SKETCH_K):
    """A mergeable sketch of the times per symbol and month: ``(symbol, month, sketch)``.

    Kept beside the table, it lets a retrain find its split without reading the candles; only
    months that gain rows need a new one. Ranks are off by about 1.65 / ``k`` ** 0.9 of the rows
    (under 0.2 % by default), whatever is merged.
    """
    month = F.substring(F.col("timestamp").cast("string"), 1, 7).alias("month")
    return with_ts_unix(df).groupBy("symbol", month).agg(F.kll_sketch_agg_bigint("ts_unix", F.lit(k)).alias("sketch"))


def sketched_quantile(sketches, q=SPLIT_AT, k=SKETCH_K):
    """One row: ``split_ts`` and ``n_rows`` of all rows the sketches stand for."""
    whole = sketches.agg(F.kll_merge_agg_bigint("sketch", F.lit(k)).alias("sketch"))
    return whole.select(
        F.kll_sketch_get_quantile_bigint("sketch", F.lit(q)).alias("split_ts"),
        F.kll_sketch_get_n_bigint("sketch").alias("n_rows"),
    )


def time_split(df, exact=True, q=SPLIT_AT):
    """The rows with ``is_train``: at or before the split time, or after it.

    The rows are read up to three times: pass a stored table, not a long plan.
    """
    timed = with_ts_unix(df)
    threshold = (exact_quantile if exact else approx_quantile)(timed, q)
    return timed.withColumn("is_train", F.col("ts_unix") <= threshold.scalar())
