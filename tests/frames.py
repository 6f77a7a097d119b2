"""Made candles for tests, and the same features in pandas."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd

START = datetime(2024, 1, 1)


def random_rows(seed, sizes, p_gap=0.2, p_null=0.0, max_gap=200):
    """One-minute candles per symbol with gaps; ``sizes`` maps symbol to row count."""
    rng = np.random.default_rng(seed)
    rows = []
    for symbol, size in sizes.items():
        minute = int(rng.integers(0, 50))
        for _ in range(size):
            minute += int(rng.integers(2, max_gap)) if rng.random() < p_gap else 1
            price = [round(float(x), 2) for x in rng.uniform(1, 100, 4)]
            close = None if rng.random() < p_null else price[3]
            volume = None if rng.random() < p_null else round(float(rng.uniform(0, 9)), 2)
            at = START + timedelta(minutes=minute)
            rows.append(
                (symbol, at, price[0], max(price), min(price), close, volume, int(rng.integers(1, 9)))
            )
    return rows


def to_pandas(rows):
    names = "symbol timestamp open high low close volume number_of_trades".split()
    df = pd.DataFrame(rows, columns=names)
    for c in names[2:7]:
        df[c] = df[c].astype(float)
    return df.sort_values(["symbol", "timestamp"]).reset_index(drop=True)


def per_symbol(df, add):
    return pd.concat([add(g.copy()) for _, g in df.groupby("symbol")]).reset_index(drop=True)


def serve_golden(g):
    for name, source, k in [
        ("lag_close_1", "close", 1),
        ("lag_close_2", "close", 2),
        ("lag_close_3", "close", 3),
        ("lag_close_5", "close", 5),
        ("lag_volume_1", "volume", 1),
    ]:
        g[name] = g[source].shift(k).bfill().ffill().fillna(0.0)
    g["hl_spread"] = g.high - g.low
    with np.errstate(divide="ignore", invalid="ignore"):
        g["price_change_pct"] = np.where(g.open != 0, (g.close - g.open) / g.open, 0.0)
    for name, n in [("rolling_avg_close_5", 5), ("rolling_avg_15m", 15), ("rolling_avg_1h", 60)]:
        g[name] = g.close.rolling(n, min_periods=1).mean()
    g["volatility_15m"] = g.close.rolling(15, min_periods=1).std().fillna(0.0)
    return g


def train_golden(g):
    for name, source, k in [
        ("lag_close_1", "close", 1),
        ("lag_close_3", "close", 3),
        ("lag_close_5", "close", 5),
        ("lag_volume_1", "volume", 1),
    ]:
        g[name] = g[source].shift(k)
    g["hl_spread"] = g.high - g.low
    g["price_change_pct"] = ((g.close - g.open) / g.open).where(g.open != 0)
    g["rolling_avg_15m"] = g.close.rolling(16, min_periods=1).mean()
    g["rolling_avg_1h"] = g.close.rolling(61, min_periods=1).mean()
    g["volatility_15m"] = g.close.rolling(16, min_periods=1).std()
    return g


def assert_same(spark_df, golden, columns):
    got = spark_df.select("symbol", "timestamp", *columns).toPandas()
    got = got.sort_values(["symbol", "timestamp"]).reset_index(drop=True)
    want = golden[["symbol", "timestamp", *columns]]
    assert len(got) == len(want)
    assert (got.symbol == want.symbol).all()
    assert (got.timestamp.values == want.timestamp.values).all()
    for c in columns:
        np.testing.assert_allclose(
            got[c].astype(float), want[c].astype(float), rtol=1e-9, atol=1e-9, err_msg=c
        )
