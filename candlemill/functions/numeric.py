"""Arithmetic helpers shared by the operators."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: added to a moving average before it divides.
EPSILON = 1e-6


def number(c, dtype="double") -> Column:
    """Text or number as ``dtype``; unreadable text is NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast(dtype)


def hl_spread() -> Column:
    return F.col("high") - F.col("low")


def price_change(zero_guard) -> Column:
    """``(close - open) / open``; an open of 0 gives NULL, or 0.0 with the guard."""
    change = F.try_divide(F.col("close") - F.col("open"), F.col("open"))
    if zero_guard:
        # A missing open is not zero: the ratio stays missing.
        return F.when(F.col("open") == 0, F.lit(0.0)).otherwise(change)
    return change


def percent_of(difference, base) -> Column:
    """``difference / base`` in percent, 0 when the base is 0."""
    return F.when(base == 0, F.lit(0.0)).otherwise(difference / base * 100)


def clamp(c, low, high) -> Column:
    return F.least(F.lit(float(high)), F.greatest(F.lit(float(low)), c))


def money_text(c) -> Column:
    return F.concat(F.lit("$"), F.format_number(c, 4))


def signed_percent_text(c) -> Column:
    return F.format_string("%+.3f%%", c)
