"""Technical features of candles, in the three column sets models use.

The names of columns and models' inputs are fixed values, as models are trained with them.
"""

from pyspark.sql import functions as F

from candlemill.functions.numeric import hl_spread, price_change
from candlemill.functions.timefn import epoch_ms
from candlemill.operators.slices import SLICE_BARS, windowed
from candlemill.schemas import MINUTE_MS

# Window lengths in rows. Training frames reach 15 and 60 rows
# back and include the row itself; serving frames are 15 and 60 rows in all.
TRAIN_FRAMES = {"short": 16, "long": 61}
SERVE_FRAMES = {"tiny": 5, "short": 15, "long": 60}

#: Rows before a candle that its serving features reach back to.
SERVE_HISTORY = SERVE_FRAMES["long"] - 1

TRAIN_LAGS = {
    "lag_close_1": ("close", 1),
    "lag_close_3": ("close", 3),
    "lag_close_5": ("close", 5),
    "lag_volume_1": ("volume", 1),
}
SERVE_LAGS = {
    "lag_close_1": ("close", 1),
    "lag_close_2": ("close", 2),
    "lag_close_3": ("close", 3),
    "lag_close_5": ("close", 5),
    "lag_volume_1": ("volume", 1),
}

# The inputs of the models, in their order.
TRAIN_INPUTS = [
    "open",
    "high",
    "low",
    "close",
    "volume",
    "lag_close_1",
    "lag_close_3",
    "lag_close_5",
    "lag_volume_1",
    "hl_spread",
    "price_change_pct",
    "rolling_avg_15m",
    "rolling_avg_1h",
    "volatility_15m",
]
REG12_INPUTS = [
    "open",
    "high",
    "low",
    "close",
    "volume",
    "number_of_trades",
    "lag_close_1",
    "lag_close_2",
    "lag_volume_1",
    "hl_spread",
    "price_change_pct",
    "rolling_avg_close_5",
]


def _last(w, n):
    """Frame of the last ``n`` rows including the current one."""
    return w.rowsBetween(1 - n, 0)


def _lags(spec, w):
    return {name: F.lag(source, k).over(w) for name, (source, k) in spec.items()}


def _train_rolling(w):
    short, long = _last(w, TRAIN_FRAMES["short"]), _last(w, TRAIN_FRAMES["long"])
    return {
        "rolling_avg_15m": F.avg("close").over(short),
        "rolling_avg_1h": F.avg("close").over(long),
        "volatility_15m": F.stddev_samp("close").over(short),
    }


def _serve_rolling(w):
    short = _last(w, SERVE_FRAMES["short"])
    return {
        "rolling_avg_close_5": F.avg("close").over(_last(w, SERVE_FRAMES["tiny"])),
        "rolling_avg_15m": F.avg("close").over(short),
        "rolling_avg_1h": F.avg("close").over(_last(w, SERVE_FRAMES["long"])),
        "volatility_15m": F.coalesce(F.stddev_samp("close").over(short), F.lit(0.0)),
    }


def lags(candles, interval_ms=MINUTE_MS, slice_bars=SLICE_BARS):
    add = lambda df, w: df.withColumns(_lags(TRAIN_LAGS, w))
    return windowed(candles, add, 5, 0, interval_ms, slice_bars)


def rolling(candles, profile, interval_ms=MINUTE_MS, slice_bars=SLICE_BARS):
    """Moving averages and volatility with the ``train`` or ``serve`` frames."""
    columns, frames = {
        "train": (_train_rolling, TRAIN_FRAMES),
        "serve": (_serve_rolling, SERVE_FRAMES),
    }[profile]
    add = lambda df, w: df.withColumns(columns(w))
    return windowed(candles, add, frames["long"] - 1, 0, interval_ms, slice_bars)


def returns(candles):
    """Spread and bar return, without and with the zero guard."""
    return candles.withColumns(
        {
            "hl_spread": hl_spread(),
            "price_change_pct": price_change(zero_guard=False),
            "price_change_pct_guarded": price_change(zero_guard=True),
        }
    )


def _train_columns(w):
    return {
        **_lags(TRAIN_LAGS, w),
        "hl_spread": hl_spread(),
        "price_change_pct": price_change(zero_guard=False),
        **_train_rolling(w),
    }


def train_features(candles, interval_ms=MINUTE_MS, slice_bars=SLICE_BARS):
    """Candles with the nine training features; warm-up rows keep their NULLs."""
    add = lambda df, w: df.withColumns(_train_columns(w))
    back = TRAIN_FRAMES["long"] - 1
    return windowed(candles, add, back, 0, interval_ms, slice_bars)


def direction_label():
    """1.0 when the next close is higher; an unknown next close gives 0.0."""
    return F.when(F.col("next_close") > F.col("close"), F.lit(1.0)).otherwise(F.lit(0.0))


def training_set(candles, interval_ms=MINUTE_MS, slice_bars=SLICE_BARS, max_gap_ms=None):
    """Training features with the label; rows with any NULL or NaN are dropped.

    Features and the look-ahead share one window pass. The label compares adjacent
    candles, however far apart; ``max_gap_ms`` drops rows whose next candle is later.
    """

    def add(df, w):
        columns = {**_train_columns(w), "next_close": F.lead("close", 1).over(w)}
        if max_gap_ms is not None:
            columns["_next"] = F.lead("timestamp", 1).over(w)
        return df.withColumns(columns)

    back = TRAIN_FRAMES["long"] - 1
    rows = windowed(candles, add, back, 1, interval_ms, slice_bars)
    if max_gap_ms is not None:
        near = epoch_ms("_next") - epoch_ms("timestamp") <= max_gap_ms
        rows = rows.filter(near).drop("_next")
    return rows.withColumn("label", direction_label()).dropna("any")


def serve_features(candles, interval_ms=MINUTE_MS, slice_bars=SLICE_BARS):
    """Candles with the eleven serving features and no NULL among the lags."""

    def add(df, w):
        return df.withColumns(
            {
                **_lags(SERVE_LAGS, w),
                "hl_spread": hl_spread(),
                "price_change_pct": price_change(zero_guard=True),
                **_serve_rolling(w),
            }
        )

    back = SERVE_FRAMES["long"] - 1
    return windowed(candles, add, back, 0, interval_ms, slice_bars, fill=list(SERVE_LAGS))


def _lags_so_far(w):
    """Serving lags that never look ahead: a missing one takes the value before it within the
    longest frame, else 0.0."""
    reach = 1 - SERVE_FRAMES["long"]
    return {
        name: F.coalesce(F.last(source, True).over(w.rowsBetween(reach, -k)), F.lit(0.0))
        for name, (source, k) in SERVE_LAGS.items()
    }


def serve_features_so_far(candles, interval_ms=MINUTE_MS, slice_bars=SLICE_BARS):
    """The serving features a candle has the moment it is the newest one of its symbol.

    They equal ``serve_features`` but where that fills a missing lag from later candles: in a
    symbol's first rows, and next to candles without close or volume. A row needs the
    ``SERVE_HISTORY`` rows before it and no others, so new candles need no older history.
    """

    def add(df, w):
        return df.withColumns(
            {
                **_lags_so_far(w),
                "hl_spread": hl_spread(),
                "price_change_pct": price_change(zero_guard=True),
                **_serve_rolling(w),
            }
        )

    return windowed(candles, add, SERVE_HISTORY, 0, interval_ms, slice_bars)


def reg12_features(
    candles, interval_ms=MINUTE_MS, slice_bars=SLICE_BARS, with_next_close=False
):
    """The twelve inputs of the regression model, computed as for serving.

    Only the frames and lags this set needs are evaluated. ``with_next_close``
    adds the label source in the same window pass.
    """
    names = ["lag_close_1", "lag_close_2", "lag_volume_1"]
    wanted = {name: SERVE_LAGS[name] for name in names}
    extra = ["next_close"] if with_next_close else []

    def add(df, w):
        columns = {
            **_lags(wanted, w),
            "hl_spread": hl_spread(),
            "price_change_pct": price_change(zero_guard=True),
            "rolling_avg_close_5": F.avg("close").over(_last(w, SERVE_FRAMES["tiny"])),
        }
        if with_next_close:
            columns["next_close"] = F.lead("close", 1).over(w)
        return df.withColumns(columns)

    back, ahead = SERVE_FRAMES["tiny"] - 1, len(extra)
    rows = windowed(candles, add, back, ahead, interval_ms, slice_bars, fill=names)
    return rows.select("symbol", "timestamp", *REG12_INPUTS, *extra)


def features(candles, profile, interval_ms=MINUTE_MS, slice_bars=SLICE_BARS):
    """Feature frame of a profile: ``train``, ``serve`` or ``reg12``."""
    build = {"train": train_features, "serve": serve_features, "reg12": reg12_features}[profile]
    return build(candles, interval_ms, slice_bars)
