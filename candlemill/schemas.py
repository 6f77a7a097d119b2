"""Schemas and constants of the candle data model."""

from pyspark.sql import types as T

# The symbol universe, in its usual display order.
SYMBOLS = [
    "BTCUSDT",
    "ETHUSDT",
    "BNBUSDT",
    "SOLUSDT",
    "XRPUSDT",
    "ADAUSDT",
    "DOGEUSDT",
    "AVAXUSDT",
    "LINKUSDT",
    "DOTUSDT",
]

# Bar length, first start of an empty symbol, page sizes, topic.
MINUTE_MS = 60_000
EMPTY_START_MS = 1_672_531_200_000  # 2023-01-01 00:00 UTC
PAGE_BARS = 1000
JDBC_BATCH = 5000
LIVE_BARS = 300
TOPIC = "top10-crypto-live"
CANDLE_TABLE = "historical_prices_1m"

KEY = ["symbol", "timestamp"]
PRICES = ["open", "high", "low", "close", "volume"]
VALUES = PRICES + ["number_of_trades"]
CANDLE_COLS = KEY + VALUES

CANDLE_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType(), False),
        T.StructField("timestamp", T.TimestampNTZType(), False),
        *[T.StructField(c, T.DoubleType()) for c in PRICES],
        T.StructField("number_of_trades", T.LongType()),
    ]
)

# CSV cells are read as text and cast afterwards, so a bad cell becomes NULL
# instead of failing the scan, and no inference pass is needed.
CSV_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ["timestamp", *VALUES]]
)

KLINE_SCHEMA = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        *[T.StructField(c, T.StringType()) for c in VALUES],
        T.StructField("is_closed", T.BooleanType()),
    ]
)

# Feed numbers arrive as text or as numbers; text fields accept both.
ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField(
            "data",
            T.StructType(
                [
                    T.StructField("c", T.StringType()),
                    T.StructField("P", T.StringType()),
                    T.StructField("v", T.StringType()),
                    T.StructField(
                        "k",
                        T.StructType(
                            [
                                T.StructField("t", T.StringType()),
                                T.StructField("o", T.StringType()),
                                T.StructField("h", T.StringType()),
                                T.StructField("l", T.StringType()),
                                T.StructField("c", T.StringType()),
                                T.StructField("v", T.StringType()),
                                T.StructField("n", T.StringType()),
                                T.StructField("x", T.BooleanType()),
                            ]
                        ),
                    ),
                ]
            ),
        ),
    ]
)

# One landed topic record: the payload and its place in the topic. Partition and record time
# may be missing.
TOPIC_SCHEMA = T.StructType(
    [
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("time", T.TimestampNTZType()),
        T.StructField("value", T.StringType()),
    ]
)

REST_PAGE_TYPE = "array<array<string>>"

# Positions inside one REST row.
REST_POSITIONS = {
    "open_time": 0,
    "open": 1,
    "high": 2,
    "low": 3,
    "close": 4,
    "volume": 5,
    "close_time": 6,
    "number_of_trades": 8,
}
REST_ROW_LENGTH = 12
