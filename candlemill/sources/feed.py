"""The multiplexed feed and the topic messages made from it.

Input frames carry ``value`` (JSON text) and any other columns, such as the
topic ``offset``; the other columns pass through. All functions work the same
on batch and streaming frames.
"""

from pyspark.sql import functions as F

from candlemill.functions.numeric import number
from candlemill.functions.timefn import format_text, from_epoch_ms, parse_text
from candlemill.schemas import ENVELOPE_SCHEMA, KLINE_SCHEMA, PRICES, VALUES

TICKER_COLS = ["type", "symbol", "price", "change_pct", "volume"]
KLINE_COLS = ["type", "symbol", "timestamp", *VALUES, "is_closed"]


def _once(rows, name, column):
    """Adds a costly column that is evaluated once per row.

    Filters on a plain column are pushed below it and evaluate it again for every
    field they test; they are not pushed below a generator.
    """
    return rows.withColumn(name, F.explode(F.array(column)))


def open_envelopes(raw):
    """Adds the parsed envelope ``msg``, its symbol and its stream type."""
    parsed = _once(raw, "msg", F.from_json("value", ENVELOPE_SCHEMA))
    part = lambda i: F.split_part(F.col("msg.stream"), F.lit("@"), F.lit(i))
    return parsed.withColumns({"symbol": F.upper(part(1)), "stream_type": part(2)})


def _passed(raw):
    return [c for c in raw.columns if c != "value"]


def _typed(opened):
    """Adds the typed fields of both message types, as structs."""
    data, k = F.col("msg.data"), F.col("msg.data.k")
    source = {"open": "o", "high": "h", "low": "l", "close": "c", "volume": "v"}
    ticker = F.struct(
        number(data.getField("c")).alias("price"),
        number(data.getField("P")).alias("change_pct"),
        number(data.getField("v")).alias("volume"),
    )
    kline = F.struct(
        format_text(from_epoch_ms(number(k.getField("t"), "long"))).alias("timestamp"),
        *[number(k.getField(source[c])).alias(c) for c in PRICES],
        number(k.getField("n"), "long").alias("number_of_trades"),
        k.getField("x").alias("is_closed"),
    )
    kind = F.col("stream_type")
    return _once(
        opened,
        "typed",
        F.struct(
            F.when(kind == "ticker", ticker).alias("ticker"),
            F.when(kind == "kline_1m", kline).alias("kline"),
        ),
    )


FIELDS = {"ticker": TICKER_COLS[2:], "kline": KLINE_COLS[2:]}


def _complete(prefix, names):
    ok = F.lit(True)
    for name in names:
        ok = ok & F.col(f"{prefix}.{name}").isNotNull()
    return ok


def _is(kind):
    """Whether a row holds a publishable message of this type."""
    return _complete(f"typed.{kind}", FIELDS[kind])


def _message(kind):
    fields = [F.col(f"typed.{kind}.{name}").alias(name) for name in FIELDS[kind]]
    return [F.lit(kind).alias("type"), F.col("symbol"), *fields]


def _demux(raw, kind, stream_type):
    opened = open_envelopes(raw).filter(F.col("stream_type") == stream_type)
    return _typed(opened).filter(_is(kind)).select(*_passed(raw), *_message(kind))


def demux_tickers(raw):
    """Ticker messages; a message lacking a readable field is not published."""
    return _demux(raw, "ticker", "ticker")


def demux_klines(raw):
    """One-minute candle messages; a message lacking a readable field is not published."""
    return _demux(raw, "kline", "kline_1m")


def publish(raw):
    """The feed as topic payloads of both types, in one pass: demultiplexed and encoded."""
    rows = _typed(open_envelopes(raw)).filter(_is("ticker") | _is("kline"))
    body = {kind: F.to_json(F.struct(*_message(kind))) for kind in FIELDS}
    text = F.when(_is("ticker"), body["ticker"]).otherwise(body["kline"])
    return rows.select(*_passed(raw), F.col("symbol").alias("key"), text.alias("value"))


def rejects(raw):
    """Messages the demultiplexer drops, with the reason; other streams are not listed."""
    kind = F.col("stream_type")
    # Text that is no JSON object reads as an envelope without fields.
    reason = (
        F.when(F.col("msg.stream").isNull() | F.col("msg.data").isNull(), "no envelope")
        .when((kind == "ticker") & ~_is("ticker"), "bad ticker")
        .when((kind == "kline_1m") & ~_is("kline"), "bad kline")
    )
    rows = _typed(open_envelopes(raw)).withColumn("reason", reason)
    return rows.filter(F.col("reason").isNotNull()).select(*raw.columns, "reason")


def message_price(price, close):
    """The price a log line shows: a falsy price (missing or 0) gives way to the close."""
    return F.when(F.coalesce(price, F.lit(0.0)) != 0, price).otherwise(close)


def _candle_messages(messages, symbols):
    """Candle messages of the allowed symbols, with their typed fields."""
    parsed = _once(messages, "msg", F.from_json("value", KLINE_SCHEMA))
    typed = F.struct(
        parse_text("msg.timestamp").alias("timestamp"),
        *[number(f"msg.{c}").alias(c) for c in PRICES],
        number("msg.number_of_trades", "long").alias("number_of_trades"),
        F.col("msg.is_closed").alias("is_closed"),
    )
    wanted = (F.col("msg.type") == "kline") & F.upper("msg.symbol").isin(list(symbols))
    return parsed, wanted, typed


def decode_klines(messages, symbols):
    """Topic messages to typed live candles of the allowed symbols.

    Tickers and other symbols are skipped; unreadable messages go to ``topic_rejects``.
    """
    parsed, wanted, typed = _candle_messages(messages, symbols)
    rows = _once(parsed.filter(wanted), "typed", typed).filter(_complete("typed", FIELDS["kline"]))
    fields = [F.col(f"typed.{name}").alias(name) for name in FIELDS["kline"]]
    return rows.select(*_passed(messages), F.upper("msg.symbol").alias("symbol"), *fields)


def topic_rejects(messages, symbols):
    """Topic messages that ought to be candles but cannot be read, with the reason.

    Tickers and candles of other symbols are no rejects; candles without a symbol are.
    """
    parsed, wanted, typed = _candle_messages(messages, symbols)
    rows = _once(parsed, "typed", typed)
    reason = (
        F.when(F.col("msg.type").isNull(), "no message")
        .when((F.col("msg.type") == "kline") & F.col("msg.symbol").isNull(), "no symbol")
        .when(wanted & F.col("typed.timestamp").isNull(), "bad time")
        .when(wanted & ~_complete("typed", FIELDS["kline"]), "bad field")
    )
    return rows.withColumn("reason", reason).filter(F.col("reason").isNotNull()).select(*messages.columns, "reason")


def encode(messages):
    """Keyed JSON payloads; the symbol is the key, so a symbol's messages keep their order."""
    body = [c for c in messages.columns if c in {*TICKER_COLS, *KLINE_COLS}]
    passed = [c for c in messages.columns if c not in body]
    return messages.select(
        *passed, F.col("symbol").alias("key"), F.to_json(F.struct(*body)).alias("value")
    )
