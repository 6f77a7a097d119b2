"""Candles as CSV, laid out the way the historical reader expects."""

from pyspark.sql import functions as F


def write_csv(candles, path, span="1year"):
    """One folder ``file=<SYMBOL>_1m_<span>.csv`` of part files per symbol.

    Every writing task adds its own part file, so a large symbol needs no single writer.
    """
    name = F.concat(F.col("symbol"), F.lit(f"_1m_{span}.csv"))
    rows = candles.withColumn("file", name).drop("symbol")
    rows = rows.withColumn("timestamp", F.substring(F.col("timestamp").cast("string"), 1, 19))
    rows.write.mode("append").partitionBy("file").option("header", True).csv(path)
