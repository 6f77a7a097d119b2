"""Keyed merges on (symbol, timestamp).

An ``order`` column, where given, is the arrival number of a row. Without one, equal keys
of a batch are ordered by their values, NULLs first: an arbitrary rule, but the same on every
run. Duplicates inside one batch are reduced by aggregation, which combines on the map side,
so any number of copies of one key is harmless.
"""

from decimal import Decimal

from pyspark.sql import functions as F

from candlemill.operators.newest import newest_n
from candlemill.schemas import CANDLE_COLS, KEY, VALUES


def _reduce(rows, keys, order, pick):
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(*[pick(c, order).alias(c) for c in rest]).select(*rows.columns)


def first_arrived(rows, order, keys=KEY):
    return _reduce(rows, keys, order, F.min_by)


def last_arrived(rows, order, keys=KEY):
    return _reduce(rows, keys, order, F.max_by)


_WHOLE = ("tinyint", "smallint", "int", "bigint")


def _rank(rows, order):
    """What equal keys are ordered by.

    Aggregations by hash hold numbers but no structs. So a whole-number ``order`` becomes the
    head of one number whose tail is a hash of the values, which breaks ties the same way on
    every run. A decimal ``order`` (see ``sources.arrival``) is taken to be unique.
    """
    values = [c for c in VALUES if c in rows.columns]
    kind = dict(rows.dtypes).get(order, "")
    if kind in _WHOLE:
        head = F.coalesce(F.col(order).cast("long"), F.lit(-(2**63) + 1)).cast("decimal(19,0)")
        tail = F.shiftrightunsigned(F.xxhash64(*values), 4).cast("decimal(19,0)")
        return (head * F.lit(Decimal(10**19))).cast("decimal(38,0)") + tail
    if kind.startswith("decimal"):
        return F.coalesce(F.col(order), F.lit(-1).cast(kind))
    return F.struct(*([order] if order else []), *values)


def one_per_key(rows, order, reduce):
    """One row per key: by ``order``, or by the values where there is none.

    Without an order the greatest (or least) values count, NULLs lowest; ties in ``order``
    go by a hash of the values.
    """
    return reduce(rows.withColumn("_order", _rank(rows, order).alias("_order")), "_order").drop("_order")


def new_rows(target, incoming, order=None):
    """Incoming rows whose key the target lacks; the first of equal keys.

    The target's keys are first cut to those that occur in the batch. Spark
    broadcasts the batch side of that semi join when it is small enough, so a
    small batch does not shuffle a large target.
    """
    batch = one_per_key(incoming, order, first_arrived).select(*CANDLE_COLS)
    taken = target.select(*KEY).join(batch.select(*KEY), KEY, "left_semi")
    return batch.join(taken, KEY, "left_anti")


def insert_ignore(target, incoming, order=None):
    """The target plus the new keys of the batch: the first write wins."""
    return target.select(*CANDLE_COLS).unionByName(new_rows(target, incoming, order))


def upsert(target, incoming, order=None):
    """The target with the batch written over it: the last write wins, in all six values."""
    batch = one_per_key(incoming, order, last_arrived).select(*CANDLE_COLS)
    kept = target.select(*CANDLE_COLS).join(batch.select(*KEY), KEY, "left_anti")
    return kept.unionByName(batch)


def rows_added(added):
    """Rows per symbol that a merge adds."""
    return added.groupBy("symbol").agg(F.count("*").alias("rows_added"))


def live_over_stored(stored, live, n=None):
    """Stored and live candles; per key the live one. ``is_closed`` is NULL for stored rows.

    With ``n``, the newest ``n`` per symbol. A row outside its own side's newest
    ``n`` has at least ``n`` newer keys in the union, so both sides are cut first
    and the join handles no more than ``n`` rows per symbol and side.
    """
    if n is not None:
        stored, live = newest_n(stored, n), newest_n(live, n)
    kept = stored.join(live.select(*KEY), KEY, "left_anti")
    merged = kept.unionByName(live, allowMissingColumns=True)
    return merged if n is None else newest_n(merged, n)
