"""Row-frame windows that do not gather a whole symbol in one task.

A window partitioned by symbol alone puts every row of a hot symbol into one
task. Here a symbol's rows are cut into time slices of ``slice_bars`` bar
lengths. As (symbol, timestamp) is the key of a candle table, a slice holds at
most ``slice_bars`` rows. Each slice also receives copies of rows its frames
reach into: at least the last ``back`` rows before it and the first ``ahead``
rows after it. Frames count rows, so further copies do no harm, and gaps of any
length give what a plain window gives. Rows without a key are left out.

Which rows to copy follows from counts alone: per slice, the rows in some zones
at its end and its start. The smallest zone that holds enough rows is copied; no
ranking or sorting of rows is needed for it.

Cost: one shuffle of the rows on (symbol, slice), one count per slice and zone
(partial aggregation over the two key columns), and the copies. The only
per-symbol window runs over the counts, one row per slice.
"""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from candlemill.functions.timefn import bar_number
from candlemill.schemas import MINUTE_MS

SLICE_BARS = 10_080  # one week of minutes
ZONE_GROWTH = 4

SLICE = "_slice"
OWN = "_own"


def _bar_in_slice(interval_ms, slice_bars):
    """Bars between the start of a row's slice and the row."""
    return F.pmod(bar_number("timestamp", interval_ms), F.lit(slice_bars))


def _with_slice(df, interval_ms, slice_bars):
    number = bar_number("timestamp", interval_ms)
    keyed = F.col("symbol").isNotNull() & F.col(SLICE).isNotNull()
    return df.withColumn(SLICE, F.floor(number / F.lit(slice_bars))).filter(keyed)


def slice_window():
    """The window of one slice; frames stay exact for a slice's own rows."""
    return W.partitionBy("symbol", SLICE).orderBy("timestamp")


def _zones(rows, slice_bars):
    """Zone lengths in bars, from twice the rows wanted up to just below a slice."""
    zone = 2 * rows
    while 0 < zone < slice_bars:
        yield zone
        zone *= ZONE_GROWTH


def _neighbours(frame, zones, between, wanted):
    """The neighbours inside ``frame`` that hand rows over, each with the zone to copy.

    ``between`` counts the rows of the slices that lie between the two. A zone is
    picked when it holds the rows still wanted beyond those; NULL is the whole slice.
    """
    source = F.struct(F.col(SLICE).alias("slice"), "n", "upto", *[f"z{i}" for i in zones])
    near = F.filter(F.collect_list(source).over(frame), lambda s: between(s) < F.lit(wanted))

    def zone(s):
        missing = F.lit(wanted) - between(s)
        picks = [F.when(s[f"z{i}"] >= missing, F.lit(i)) for i in zones]
        return F.coalesce(*picks, F.lit(None).cast("int"))

    return F.transform(near, lambda s: F.struct(s["slice"].alias("slice"), zone(s).alias("zone")))


def _links(sliced, back, ahead, bar, slice_bars):
    """Which slice hands which zone to which neighbour; zones at a slice's start are negative.

    Every listed slice has at least one row, so frames reach no further than
    ``back`` or ``ahead`` slices.
    """
    tails, heads = list(_zones(back, slice_bars)), list(_zones(ahead, slice_bars))
    counts = (
        sliced.select("symbol", SLICE, bar.alias("_bar"))
        .groupBy("symbol", SLICE)
        .agg(
            F.count("*").alias("n"),
            *[F.count_if(F.col("_bar") >= slice_bars - z).alias(f"z{z}") for z in tails],
            *[F.count_if(F.col("_bar") < z).alias(f"z{-z}") for z in heads],
        )
    )
    w = W.partitionBy("symbol").orderBy(SLICE)
    counts = counts.withColumn("upto", F.sum("n").over(w.rowsBetween(W.unboundedPreceding, 0)))
    upto, n = F.col("upto"), F.col("n")
    before = _neighbours(w.rowsBetween(-back, -1), tails, lambda s: upto - n - s["upto"], back)
    after = _neighbours(
        w.rowsBetween(1, ahead), [-z for z in heads], lambda s: s["upto"] - s["n"] - upto, ahead
    )
    lists = [side for side, wanted in [(before, back), (after, ahead)] if wanted]
    near = counts.select("symbol", SLICE, F.concat(*lists).alias("near"))
    return near.select("symbol", F.col(SLICE).alias("_to"), F.explode("near").alias("src")).select(
        "symbol", F.col("src.slice").alias(SLICE), "_to", F.col("src.zone").alias("_zone")
    )


def with_edges(df, back, ahead, interval_ms=MINUTE_MS, slice_bars=SLICE_BARS):
    """Rows tagged with their slice, plus the edge rows each slice needs from others.

    ``windowed`` computes over ``slice_window()`` and drops the copies. A table that
    ``sinks.layout`` wrote has both already and is taken as it is.
    """
    if OWN in df.columns:
        held = df.schema[OWN].metadata
        if held["back"] < back or held["ahead"] < ahead:
            raise ValueError(f"laid out for frames of {held['back']} rows back and {held['ahead']} ahead")
        return df
    sliced = _with_slice(df, interval_ms, slice_bars)
    placed = sliced.repartition("symbol", SLICE)
    own = placed.withColumn(OWN, F.lit(True))
    bar = _bar_in_slice(interval_ms, slice_bars)
    links = _links(sliced, back, ahead, bar, slice_bars)
    # Links are one row per slice and neighbour: a hash table of one partition's links
    # is small, and the rows need no sort to meet them.
    zone = F.col("_zone")
    inside = zone.isNull() | F.when(zone > 0, bar >= slice_bars - zone).otherwise(bar < -zone)
    copies = (
        placed.join(links.hint("shuffle_hash"), ["symbol", SLICE])
        .filter(inside)
        .select(*df.columns, F.col("_to").alias(SLICE), F.lit(False).alias(OWN))
        .repartition("symbol", SLICE)
    )
    return own.unionByName(copies)


def windowed(
    df, add_columns, back=0, ahead=0, interval_ms=MINUTE_MS, slice_bars=SLICE_BARS, fill=()
):
    """``add_columns(frame, window)`` evaluated slice by slice.

    Columns named in ``fill`` then lose their NULLs as in ``fill_both_ways``, on the
    partitioning the rows already have. ``slice_bars=None`` uses one window per
    symbol instead: right when each symbol is known to have few rows, as after a
    newest-n cut.
    """
    if slice_bars is None and OWN not in df.columns:
        added = add_columns(df, W.partitionBy("symbol").orderBy("timestamp"))
        return _fill_in(added, fill) if fill else added
    frame = with_edges(df, back, ahead, interval_ms, slice_bars)
    own = add_columns(frame, slice_window()).filter(OWN).drop(OWN)
    return (_fill_slices(own, fill) if fill else own).drop(SLICE)


def fill_both_ways(df, columns, interval_ms=MINUTE_MS, slice_bars=SLICE_BARS):
    """Each NULL takes the next value of its symbol, else the previous one, else 0.0.

    The search is unbounded. Inside a slice a window does it; across slices the
    first and last value of each slice are carried, found by an aggregation over
    the filled columns alone.
    """
    sliced = _with_slice(df, interval_ms, slice_bars)
    return _fill_slices(sliced.repartition("symbol", SLICE), columns).drop(SLICE)


def _nearest(column, keys):
    """Last value at or before the row, and first value at or after it.

    The latter is the last value in descending order: Spark extends such a frame row
    by row, while a frame that ends at the partition's end is read anew for each row.
    """
    back = W.partitionBy(*keys).rowsBetween(W.unboundedPreceding, 0)
    down = F.last(column, True).over(back.orderBy("timestamp"))
    up = F.last(column, True).over(back.orderBy(F.desc("timestamp")))
    return down, up


def _fill_in(df, columns):
    filled = {}
    for c in columns:
        down, up = _nearest(c, ["symbol"])
        filled[c] = F.coalesce(up, down, F.lit(0.0))
    return df.withColumns(filled)


def _fill_slices(sliced, columns):
    time_if = {c: F.when(F.col(c).isNotNull(), F.col("timestamp")) for c in columns}
    edges = sliced.groupBy("symbol", SLICE).agg(
        *[F.min_by(c, time_if[c]).alias(f"_first_{c}") for c in columns],
        *[F.max_by(c, time_if[c]).alias(f"_last_{c}") for c in columns],
    )
    others = W.partitionBy("symbol").rowsBetween(W.unboundedPreceding, -1)
    earlier, later = others.orderBy(SLICE), others.orderBy(F.desc(SLICE))
    carried = edges.select(
        "symbol",
        SLICE,
        *[F.last(f"_first_{c}", True).over(later).alias(f"_next_{c}") for c in columns],
        *[F.last(f"_last_{c}", True).over(earlier).alias(f"_prev_{c}") for c in columns],
    )
    filled = {}
    for c in columns:
        down, up = _nearest(c, ["symbol", SLICE])
        filled[c] = F.coalesce(up, f"_next_{c}", down, f"_prev_{c}", F.lit(0.0))
    joined = sliced.join(carried, ["symbol", SLICE], "left")
    return joined.withColumns(filled).select(*sliced.columns)
