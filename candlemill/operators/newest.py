"""Newest rows per symbol."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

SALTS = 64


def _top(df, n, keys, order):
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= n).drop("_rank")


def newest_n(df, n, salts=SALTS):
    """The ``n`` newest candles of every symbol.

    Each task cuts to ``n`` rows per symbol before the shuffle. A symbol that spans
    many tasks still gets ``n`` rows from each of them, so these candidates are first
    cut in ``salts`` groups of tasks; the last step sees at most ``n * salts`` rows
    per symbol. Any grouping gives the same result.
    """
    newest = [F.desc("timestamp")]
    salt = F.pmod(F.spark_partition_id(), F.lit(salts))
    parts = _top(df.withColumn("_salt", salt), n, ["symbol", "_salt"], newest).drop("_salt")
    return _top(parts, n, ["symbol"], newest)


def newest_n_of(df, symbol, n):
    """The ``n`` newest candles of one symbol, newest first."""
    return df.filter(F.col("symbol") == symbol).orderBy(F.desc("timestamp")).limit(n)


def newest_row(df):
    """The newest candle of every symbol, by aggregation with map-side combine."""
    rest = [c for c in df.columns if c not in ("symbol", "timestamp")]
    picked = [F.max_by(c, "timestamp").alias(c) for c in rest]
    rows = df.groupBy("symbol").agg(F.max("timestamp").alias("timestamp"), *picked)
    return rows.select(*df.columns)


def latest_timestamp(df):
    return df.groupBy("symbol").agg(F.max("timestamp").alias("max_timestamp"))


def per_symbol(symbols, rows):
    """``rows`` left-joined to the symbol table, so symbols without rows stay."""
    return symbols.join(rows, "symbol", "left")
