"""Any frame with the eight candle columns, cast to the canonical types."""

from pyspark.sql import functions as F

from candlemill.functions.numeric import number
from candlemill.functions.timefn import parse_text
from candlemill.schemas import CANDLE_COLS, PRICES


def canonical(df):
    """Fixed column order and types; unreadable cells become NULL, never an error."""
    stored = dict(df.dtypes)["timestamp"]
    timestamp = (
        parse_text("timestamp") if stored == "string" else F.col("timestamp").cast("timestamp_ntz")
    )
    typed = {c: number(c) for c in PRICES}
    typed["number_of_trades"] = number("number_of_trades", "long")
    typed["symbol"] = F.col("symbol")
    typed["timestamp"] = timestamp
    return df.select(*[typed[c].alias(c) for c in CANDLE_COLS])
