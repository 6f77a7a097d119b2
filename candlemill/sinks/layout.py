"""Candles laid out for windows: a bucketed catalog table that already holds slices and edges.

Rows lie in buckets of (symbol, slice), sorted by time, with the copies of edge rows each slice
needs (see ``operators.slices``). The feature operators take such a table in place of candles and
then shuffle nothing: a retrain reads each bucket once. A hot symbol has many slices, so it is
spread over the buckets. The table is as of the time it was written.

Spark sorts a bucket again for a window, in one pass as it is in order, unless
``spark.sql.legacy.bucketedTableScan.outputOrdering`` is set; each bucket is one file for that.
"""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from candlemill.operators.newest import newest_n
from candlemill.operators.slices import OWN, SLICE, SLICE_BARS, with_edges
from candlemill.schemas import MINUTE_MS

#: Edge rows kept: what the longest feature frame and the label reach into.
BACK, AHEAD = 60, 1


def write_layout(
    candles, name, path=None, buckets=64, back=BACK, ahead=AHEAD, interval_ms=MINUTE_MS, slice_bars=SLICE_BARS
):
    """Writes the table ``name`` anew, below ``path`` if given, and returns it.

    Take ``buckets`` so that one fits a task. Rows without a key are left out; an empty input
    gives an empty table.
    """
    frame = with_edges(candles, back, ahead, interval_ms, slice_bars)
    # Read back by the operators, which refuse frames that reach further.
    frame = frame.withMetadata(OWN, {"back": back, "ahead": ahead})
    # By the buckets' own hash: one task and one file for each.
    writer = frame.repartition(buckets, "symbol", SLICE).write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.bucketBy(buckets, "symbol", SLICE).sortBy("symbol", SLICE, "timestamp").saveAsTable(name)
    return candles.sparkSession.table(name)


def candles_of(laid):
    """The candles of a layout, without copies."""
    return laid.filter(OWN).drop(OWN, SLICE)


def newest_of(laid, n):
    """The ``n`` newest candles of every symbol, from the newest slices that hold as many.

    Counting reads two columns and shuffles only one row per slice.
    """
    own = laid.filter(OWN)
    counts = own.groupBy("symbol", SLICE).agg(F.count("*").alias("n_rows"))
    later = W.partitionBy("symbol").orderBy(F.desc(SLICE)).rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n_rows").over(later), F.lit(0))
    wanted = counts.withColumn("before", before).filter(F.col("before") < n).select("symbol", SLICE)
    return newest_n(own.join(wanted, ["symbol", SLICE], "left_semi").drop(OWN, SLICE), n)
