"""Data-quality checks."""

from pyspark.sql import functions as F

from candlemill.schemas import KEY


def no_null_prices(candles):
    """One row: does every candle have a close and a volume? True for an empty table."""
    return candles.agg((F.count_if(lacks_price()) == 0).alias("ok"))


def zero_volume(candles):
    """Candles per symbol without any volume."""
    return candles.groupBy("symbol").agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("volume") == 0).alias("n_zero_volume")
    )


def duplicate_keys(candles):
    """Keys that occur more than once."""
    return candles.groupBy(*KEY).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)


def null_keys(candles):
    """One row: number of rows whose key is incomplete."""
    return candles.agg(
        F.count_if(F.col("symbol").isNull()).alias("n_null_symbol"),
        F.count_if(F.col("timestamp").isNull()).alias("n_null_timestamp"),
    )


def load_report(candles):
    """Rows and time range per symbol."""
    return candles.groupBy("symbol").agg(
        F.count("*").alias("n_rows"),
        F.min("timestamp").alias("first_timestamp"),
        F.max("timestamp").alias("last_timestamp"),
    )


class QualityError(RuntimeError):
    """A gate check failed."""


def lacks_price():
    return F.col("close").isNull() | F.col("volume").isNull()


def refuse(n_null_prices, n_duplicate_keys):
    """Raises if candles without price or rows of a key that was there already were counted."""
    if n_null_prices:
        raise QualityError(f"{n_null_prices} candles lack close or volume")
    if n_duplicate_keys:
        raise QualityError("duplicate (symbol, timestamp)")


def gate(candles):
    """Raises unless the candles are present, complete and uniquely keyed; reads all of them.

    A stored table counts the same as it is written (``CandleTable.gate``).
    """
    incomplete = F.col("symbol").isNull() | F.col("timestamp").isNull()
    report = candles.agg(
        F.count("*").alias("n_rows"),
        F.count_if(lacks_price()).alias("n_null_prices"),
        F.count_if(incomplete).alias("n_null_keys"),
    ).first()
    if report.n_rows == 0:
        raise QualityError("no candles")
    refuse(report.n_null_prices, 0)
    if report.n_null_keys:
        raise QualityError(f"{report.n_null_keys} candles lack a key")
    refuse(0, not duplicate_keys(candles).isEmpty())
    return report
