"""Candle table over JDBC. Needs the database's driver on the class path."""

from candlemill.schemas import CANDLE_TABLE
from candlemill.sources.canonical import canonical


def _months(first, last):
    """Month starts from ``first`` through ``last``, both ``(year, month)``."""
    year, month = first
    while (year, month) <= tuple(last):
        yield year, month
        year, month = (year + 1, 1) if month == 12 else (year, month + 1)


def scan_predicates(symbols, first, last):
    """One predicate per symbol and month, open-ended at both sides, one scan task each.

    Together they cover each row of these symbols exactly once, whatever its time.
    """
    starts = [f"{y:04d}-{m:02d}-01 00:00:00" for y, m in _months(first, last)]
    ranges = [f"timestamp < TIMESTAMP '{starts[0]}'"]
    for lower, upper in zip(starts, starts[1:] + [None]):
        condition = f"timestamp >= TIMESTAMP '{lower}'"
        if upper:
            condition += f" AND timestamp < TIMESTAMP '{upper}'"
        ranges.append(condition)
    quoted = ["'" + s.replace("'", "''") + "'" for s in symbols]
    return [f"symbol = {s} AND {r}" for s in quoted for r in ranges]


def read_table(spark, url, predicates, properties, table=CANDLE_TABLE):
    """Canonical candles; NUMERIC columns arrive as decimals and leave as doubles."""
    options = {"preferTimestampNTZ": "true", **properties}
    return canonical(spark.read.jdbc(url, table, predicates=predicates, properties=options))
