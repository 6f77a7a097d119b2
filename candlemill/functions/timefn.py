"""Timestamps without zone as epoch numbers and back.

All helpers read the wall clock of a ``timestamp_ntz`` as UTC. None of them goes
through a zoned timestamp, so results do not depend on the session time zone.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MS = 86_400_000
TEXT_FORMAT = r"^(\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?)(?:Z|([+-])(\d{2}):?(\d{2}))?$"


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def _seconds_since_epoch(ts):
    """Time since 1970-01-01 00:00 UTC as an interval of seconds."""
    return (_col(ts) - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).cast("interval second")


def epoch_ms(ts) -> Column:
    """Milliseconds since 1970-01-01 00:00 UTC, rounded down."""
    exact = _seconds_since_epoch(ts).cast("decimal(18,6)")
    return F.floor(exact * F.lit(1000)).cast("long")


def epoch_s(ts) -> Column:
    """Whole seconds since 1970-01-01 00:00 UTC; cheaper than ``epoch_ms``."""
    return _seconds_since_epoch(ts).cast("long")


def epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01 00:00 UTC."""
    return (_seconds_since_epoch(ts).cast("decimal(18,6)") * F.lit(1_000_000)).cast("long")


def from_epoch_ms(ms) -> Column:
    """The ``timestamp_ntz`` that lies ``ms`` milliseconds after 1970; NULL when out of range."""
    ms = _col(ms)
    # Years 0001 to 9999; anything else is rubbish input, not a time.
    ms = F.when(ms.between(F.lit(-62_135_596_800_000), F.lit(253_402_300_799_999)), ms)
    days = F.floor(ms / F.lit(DAY_MS)).cast("int")
    seconds = (F.pmod(ms, F.lit(DAY_MS)) / F.lit(1000)).cast("decimal(18,6)")
    zero = F.lit(0)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        days, zero, zero, seconds
    )


def bar_number(ts, interval_ms) -> Column:
    """Number of whole bars of length ``interval_ms`` between 1970 and ``ts``."""
    if interval_ms % 1000 == 0:
        return F.floor(epoch_s(ts) / F.lit(interval_ms // 1000))
    return F.floor(epoch_ms(ts) / F.lit(interval_ms))


def bar_start_ms(ts, interval_ms) -> Column:
    """Start of the bar of length ``interval_ms`` that contains ``ts``."""
    return bar_number(ts, interval_ms) * F.lit(interval_ms)


def parse_text(text) -> Column:
    """Date and time text as ``timestamp_ntz`` in UTC; anything else is NULL.

    Reads ``yyyy-MM-dd HH:mm``, with a blank or ``T`` between, with or without seconds, their
    fraction (up to six digits) and a zone (``Z`` or an offset, which is taken off).
    """
    text = _col(text)
    part = lambda i: F.regexp_extract(text, TEXT_FORMAT, i)
    wall = F.replace(part(1), F.lit("T"), F.lit(" ")).try_cast("timestamp_ntz")
    number = lambda i: F.coalesce(part(i).try_cast("int"), F.lit(0))
    offset = F.make_dt_interval(F.lit(0), number(3), number(4), F.lit(0).cast("decimal(18,6)"))
    shifted = F.when(part(2) == "+", wall - offset).when(part(2) == "-", wall + offset).otherwise(wall)
    return F.when(text.rlike(TEXT_FORMAT), shifted)


def format_text(ts) -> Column:
    """``timestamp_ntz`` as ``yyyy-MM-dd HH:mm:ss`` text."""
    return F.substring(_col(ts).cast("string"), 1, 19)
