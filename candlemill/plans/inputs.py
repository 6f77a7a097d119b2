"""Candle-shaped inputs derived from the given tables.

The tables hold no candles; these adapters make them from events and lineitems,
by aggregations that combine on the map side.
"""

from pyspark.sql import functions as F

from candlemill.functions.timefn import bar_start_ms, epoch_ms, from_epoch_ms
from candlemill.schemas import CANDLE_COLS, REST_ROW_LENGTH
from candlemill.session import scratch_path

HOUR_MS = 3_600_000
MONTH_MS = 31 * 86_400_000
EVENT_SYMBOLS = ["CLICK", "ERROR", "PURCHASE", "SIGNUP", "VIEW"]
EMPTY_SYMBOL = "NONE"
NOW = "2024-01-31 00:00:30"
NOW_MS = 1_706_659_230_000
GAP_NOW_MS = 1_707_523_230_000  # 2024-02-10 00:00:30: ten days after the last event
UNFINISHED_MS = 1_706_659_200_000  # the hour that has begun at NOW
STORED_BEFORE = "2024-01-21 00:00:00"
LIVE_FROM = "2024-01-19 00:00:00"
PAGE_BARS = 50
HOLE_PAGE_BARS = 12

# Ticks of these values are damaged or sent again at the end of the feed.
DAMAGED_BELOW = 0.5
RESENT_FROM = 200.0
RESENT_OFFSET = 4_000_000_000_000_000

# The topic without keys: its partitions and first time; what the first run of a resumed
# stream reads, and what has expired when the second one starts.
PARTITIONS = 3
TOPIC_START = "2024-02-01 00:00:00"
FIRST_RUN_UNTIL = "2024-02-01 00:00:00.000012"
EXPIRED_UNTIL = "2024-02-01 00:00:00.000008"


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark, sf_dir):
    return table(spark, sf_dir, "events")


def symbol_table(spark, extra=()):
    rows = [(s,) for s in [*EVENT_SYMBOLS, *extra]]
    return spark.createDataFrame(rows, "symbol string")


def before(ticks, when):
    return ticks.filter(F.col("ts") < F.lit(when).cast("timestamp_ntz"))


def since(ticks, when):
    return ticks.filter(F.col("ts") >= F.lit(when).cast("timestamp_ntz"))


def _bars(ticks, *extra):
    bars = ticks.groupBy(
        F.upper("event_type").alias("symbol"), bar_start_ms("ts", HOUR_MS).alias("bar_ms")
    ).agg(
        F.min_by("value", "event_id").alias("open"),
        F.max("value").alias("high"),
        F.min("value").alias("low"),
        F.max_by("value", "event_id").alias("close"),
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("volume"),
        F.count("*").alias("number_of_trades"),
        *extra,
    )
    return bars.withColumn("timestamp", from_epoch_ms("bar_ms"))


def candles_of(ticks):
    """Hourly candles per event type; event ids number the ticks in trading order."""
    return _bars(ticks).select(*CANDLE_COLS)


def candles(spark, sf_dir):
    return candles_of(events(spark, sf_dir))


def stored_candles(spark, sf_dir):
    return candles_of(before(events(spark, sf_dir), STORED_BEFORE))


def live_candles(spark, sf_dir):
    """Overlaps the stored candles by two days, with other closes."""
    rows = candles_of(since(events(spark, sf_dir), LIVE_FROM))
    return rows.withColumn("close", F.col("close") + 1).withColumn("is_closed", F.lit(True))


def supplier_candles(spark, sf_dir):
    """Monthly candles per supplier: many symbols, few bars each."""
    item = table(spark, sf_dir, "lineitem")
    order = F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice")
    month = F.trunc(F.col("l_shipdate").cast("date"), "month").cast("timestamp_ntz")
    return item.groupBy(
        F.concat(F.lit("S"), F.col("l_suppkey")).alias("symbol"), month.alias("timestamp")
    ).agg(
        F.min_by("l_extendedprice", order).alias("open"),
        F.max("l_extendedprice").alias("high"),
        F.min("l_extendedprice").alias("low"),
        F.max_by("l_extendedprice", order).alias("close"),
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("volume"),
        F.count("*").alias("number_of_trades"),
    )


def _kline_value(symbol, bar_ms, prices, trades, closed):
    """Envelope text; prices are text, as on the feed."""
    keys = {"open": "o", "high": "h", "low": "l", "close": "c", "volume": "v"}
    k = F.struct(
        bar_ms.alias("t"),
        *[prices[c].cast("string").alias(key) for c, key in keys.items()],
        trades.alias("n"),
        closed.alias("x"),
    )
    stream = F.concat(F.lower(symbol), F.lit("@kline_1m"))
    return F.to_json(F.struct(stream.alias("stream"), F.struct(k.alias("k")).alias("data")))


def _tick_klines():
    """The open candle a single tick sends: its value in all places."""
    prices = dict.fromkeys(["open", "high", "low", "close", "volume"], F.col("value"))
    bar_ms = bar_start_ms("ts", HOUR_MS)
    return _kline_value(F.col("event_type"), bar_ms, prices, F.lit(1), F.lit(False))


def feed_messages(ticks):
    """The raw feed as ``(offset, value)``.

    Each tick sends a ticker and an open candle, each bar a closed candle after
    its last tick. Cheap ticks are damaged on the wire; the open candles of dear
    ticks are sent once more after everything else.
    """
    ticker = F.to_json(
        F.struct(
            F.concat(F.col("event_type"), F.lit("@ticker")).alias("stream"),
            F.struct(
                F.col("value").cast("string").alias("c"),
                F.lit("0").alias("P"),
                F.col("value").cast("string").alias("v"),
            ).alias("data"),
        )
    )
    damaged = F.col("value") < DAMAGED_BELOW
    resent = F.col("value") >= RESENT_FROM
    at = F.col("event_id") * 4
    sent = ticks.select("event_id", "value", _tick_klines().alias("kline"), ticker.alias("ticker"))
    message = lambda offset, text: F.struct(offset.alias("offset"), text.alias("value"))
    messages = F.array(
        message(at, F.when(damaged, F.lit("{bad")).otherwise(F.col("kline"))),
        message(at + 1, F.col("ticker")),
        F.when(resent, message(at + RESENT_OFFSET, F.col("kline"))),
    )
    per_tick = sent.select(F.explode(F.array_compact(messages)).alias("m"))
    per_tick = per_tick.select("m.offset", "m.value")
    bars = _bars(ticks, F.max("event_id").alias("last_id"))
    prices = {c: F.col(c) for c in ["open", "high", "low", "close", "volume"]}
    closing = _kline_value(
        F.col("symbol"), F.col("bar_ms"), prices, F.col("number_of_trades"), F.lit(True)
    )
    per_bar = bars.select(
        (F.col("last_id") * 4 + 2).alias("offset"), closing.alias("value")
    )
    return per_tick.unionByName(per_bar)


def unkeyed(payloads):
    """The topic as producers without keys write it: records over ``PARTITIONS`` partitions, a
    thousand of them with one time; before the resent ones the topic is created anew."""
    at = F.col("offset")
    anew = at >= RESENT_OFFSET
    micros = F.expr("offset div 1000")
    time = F.lit(TOPIC_START).cast("timestamp_ntz") + F.make_dt_interval(secs=(micros / 1_000_000).cast("decimal(18,6)"))
    return payloads.select(
        F.pmod(at, F.lit(PARTITIONS)).cast("int").alias("partition"),
        F.floor((at - F.when(anew, F.lit(RESENT_OFFSET)).otherwise(F.lit(0))) / PARTITIONS).cast("long").alias("offset"),
        time.alias("time"),
        "value",
    )


def landed(messages, name):
    """Writes topic records to the shared folder; returns the path."""
    path = scratch_path(messages.sparkSession, name)
    messages.write.parquet(path)
    return path


def rest_pages(bars):
    """Landed pages of at most ``PAGE_BARS`` hourly bars: the given bars and one unfinished."""
    span = F.lit(PAGE_BARS * HOUR_MS)
    rows = bars.withColumn("open_ms", epoch_ms("timestamp"))
    unfinished = (
        rows.groupBy("symbol")
        .agg(*[F.lit(1.0).alias(c) for c in ["open", "high", "low", "close", "volume"]])
        .withColumns(
            {"number_of_trades": F.lit(1).cast("long"), "open_ms": F.lit(UNFINISHED_MS)}
        )
    )
    rows = rows.drop("timestamp").unionByName(unfinished)
    number = {
        0: F.col("open_ms"),
        1: F.col("open"),
        2: F.col("high"),
        3: F.col("low"),
        4: F.col("close"),
        5: F.col("volume"),
        6: F.col("open_ms") + F.lit(HOUR_MS - 1),
        8: F.col("number_of_trades"),
    }
    text = {1, 2, 3, 4, 5}
    cells = []
    for i in range(REST_ROW_LENGTH):
        cell = number.get(i, F.lit("0")).cast("string")
        cells.append(F.concat(F.lit('"'), cell, F.lit('"')) if i in text else cell)
    line = F.concat(F.lit("["), F.concat_ws(",", *cells), F.lit("]"))
    # A page spans PAGE_BARS bar lengths, so a group never holds more bars than that.
    page = F.floor(F.col("open_ms") / span)
    listed = F.sort_array(F.collect_list(F.struct("open_ms", line.alias("line"))))
    pages = rows.groupBy("symbol", page.alias("page")).agg(listed.getField("line").alias("lines"))
    value = F.concat(F.lit("["), F.concat_ws(",", "lines"), F.lit("]"))
    return pages.select("symbol", value.alias("value"))
