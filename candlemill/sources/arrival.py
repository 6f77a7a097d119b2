"""The order in which topic records arrived.

Messages carry no key, so a symbol's messages spread over all partitions and an offset alone
says nothing about order. Records are ordered by (record time, partition, offset): record times
keep growing when a topic is created anew and its offsets begin at 0 again.
"""

import json
from decimal import Decimal

from pyspark.sql import functions as F

from candlemill.functions.timefn import epoch_micros

#: The three parts side by side as digits of one number: 16 for microseconds, 5, and 17.
PARTITIONS = 10**5
OFFSETS = 10**17


def arrival(df):
    """One number per record that orders like (time, partition, offset).

    ``time`` is a ``timestamp`` or ``timestamp_ntz``; a frame without ``time`` or
    ``partition``, or a NULL there, counts as 0. A number instead of a struct, because
    aggregations by hash can hold it. NULL where the offset is NULL, and then first of all.
    """
    wide = "decimal(38,0)"
    number = F.col("offset").cast(wide)
    if "partition" in df.columns:
        place = F.coalesce(F.col("partition"), F.lit(0)).cast("decimal(6,0)")
        number = number + (place * F.lit(Decimal(OFFSETS))).cast(wide)
    if "time" in df.columns:
        zoned = dict(df.dtypes)["time"] == "timestamp"
        micros = F.coalesce(F.unix_micros("time") if zoned else epoch_micros("time"), F.lit(0)).cast("decimal(16,0)")
        number = number + (micros * F.lit(Decimal(OFFSETS * PARTITIONS))).cast(wide)
    return number.cast(wide)


def with_arrival(df):
    return df.withColumn("arrival", arrival(df))


def one_delivery(stream, late="10 minutes"):
    """A stream of records without those delivered again within ``late``.

    A record is known by its whole arrival: a topic created anew uses offsets again. For sinks
    that append; what is kept by arrival needs no such step, as a record that comes twice has
    one arrival. The state holds the records of that time only.
    """
    timed = with_arrival(stream).withColumn("_at", F.col("time").cast("timestamp")).withWatermark("_at", late)
    return timed.dropDuplicatesWithinWatermark(["arrival"]).drop("_at", "arrival")


def marks(rows):
    """Per partition the greatest arrival among ``rows``, which have an ``arrival`` column."""
    known = rows.filter(F.col("arrival").isNotNull())
    place = F.floor(F.col("arrival") / F.lit(Decimal(OFFSETS))) % F.lit(PARTITIONS)
    return known.groupBy(place.cast("int").alias("partition")).agg(F.max("arrival").alias("mark"))


def after(messages, marks):
    """The messages that arrived after their partition's mark; all of partitions without one.

    ``marks`` has one row per partition, so Spark broadcasts it to the stream.
    """
    known = marks.select(F.col("partition").alias("_partition"), "mark")
    place = F.coalesce(F.col("partition"), F.lit(0))
    rows = with_arrival(messages).join(known, place == F.col("_partition"), "left")
    fresh = F.col("mark").isNull() | (F.col("arrival") > F.col("mark"))
    return rows.filter(fresh).select(*messages.columns)


def starting_offsets(marks, topic, partitions):
    """The ``startingOffsets`` text that lets a topic reader go on after the marks.

    For a topic that still holds the marked records or whose older ones have expired; not for
    one that was created anew, whose offsets say nothing about the marks. Partitions without
    a mark are read from their start. One row per partition reaches the driver.
    """
    last = {r["partition"]: int(r["mark"] % OFFSETS) for r in marks.collect()}
    return json.dumps({topic: {str(p): last[p] + 1 if p in last else -2 for p in range(partitions)}})
