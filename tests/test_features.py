import pytest
from frames import assert_same, per_symbol, random_rows, serve_golden, to_pandas, train_golden
from pyspark.sql import functions as F

from candlemill.operators import features
from candlemill.operators.slices import fill_both_ways, windowed
from candlemill.schemas import CANDLE_SCHEMA, MINUTE_MS

SIZES = {"HOT": 900, "A": 130, "B": 61, "C": 6, "D": 2, "E": 1}
TRAIN = [
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
SERVE = TRAIN + ["lag_close_2", "rolling_avg_close_5"]


# Slices much shorter than the longest frame, about as long, longer, and none.
@pytest.mark.parametrize("slice_bars", [7, 64, 10_080, None])
@pytest.mark.parametrize("p_null", [0.0, 0.3])
def test_profiles_match_pandas(candles, slice_bars, p_null):
    rows = random_rows(3, SIZES, p_null=p_null)
    df, plain = candles(rows), to_pandas(rows)
    serve = features.features(df, "serve", MINUTE_MS, slice_bars)
    assert_same(serve, per_symbol(plain, serve_golden), SERVE)
    train = features.features(df, "train", MINUTE_MS, slice_bars)
    assert_same(train, per_symbol(plain, train_golden), TRAIN)


def test_slices_hand_over_exact_edges(candles):
    """Look-back and look-ahead across many nearly empty slices."""
    rows = random_rows(5, {"A": 200, "B": 40}, p_gap=0.9, max_gap=400)

    def add(df, w):
        return df.withColumns(
            {
                "back": F.sum("close").over(w.rowsBetween(-9, 0)),
                "ahead": F.sum("close").over(w.rowsBetween(0, 4)),
            }
        )

    sliced = windowed(candles(rows), add, 9, 4, MINUTE_MS, 3)
    whole = windowed(candles(rows), add, slice_bars=None)
    assert sliced.exceptAll(whole).isEmpty() and whole.exceptAll(sliced).isEmpty()


def test_reg12_is_a_projection_of_serve(candles):
    df = candles(random_rows(7, SIZES, p_null=0.1))
    reg12 = features.features(df, "reg12", MINUTE_MS, 50)
    serve = features.features(df, "serve", MINUTE_MS, 50).select(*reg12.columns)
    assert reg12.exceptAll(serve).isEmpty() and serve.exceptAll(reg12).isEmpty()


@pytest.mark.parametrize("slice_bars", [5, None])
def test_fill_next_then_previous_then_zero(candles, slice_bars):
    rows = random_rows(11, {"A": 120, "B": 30}, p_null=0.8)
    rows += [r[:5] + (None,) + r[6:] for r in random_rows(12, {"EMPTY": 9})]
    golden = per_symbol(to_pandas(rows), lambda g: g.assign(close=g.close.bfill().ffill().fillna(0)))
    assert_same(fill_both_ways(candles(rows), ["close"], MINUTE_MS, slice_bars or 10_080), golden, ["close"])


def test_training_set_drops_warm_up_last_and_broken_rows(candles):
    rows = random_rows(2, {"A": 40, "B": 7, "C": 6}, p_gap=0)
    rows[20] = rows[20][:2] + (0.0,) + rows[20][3:]  # open = 0: no return, row dropped
    result = features.training_set(candles(rows))
    counts = {r["symbol"]: r["count"] for r in result.groupBy("symbol").count().collect()}
    assert counts == {"A": 40 - 5 - 1 - 1, "B": 1}
    golden = to_pandas(rows)
    golden["next_close"] = golden.groupby("symbol").close.shift(-1)
    for row in result.collect():
        match = golden[(golden.symbol == row.symbol) & (golden.timestamp == row.timestamp)]
        assert row.label == float(match.next_close.iloc[0] > match.close.iloc[0])


def test_labels_may_be_limited_to_near_candles(candles):
    rows = random_rows(8, {"A": 60}, p_gap=0.3)
    every = {r.timestamp for r in features.training_set(candles(rows)).collect()}
    near = features.training_set(candles(rows), max_gap_ms=3 * MINUTE_MS)
    times = [r[1] for r in rows]
    gap = dict(zip(times, [(b - a).total_seconds() for a, b in zip(times, times[1:])]))
    assert {r.timestamp for r in near.collect()} == {t for t in every if gap[t] <= 180}
    assert "_next" not in near.columns


def test_nan_rows_do_not_train(candles):
    rows = random_rows(2, {"A": 20}, p_gap=0)
    rows[10] = rows[10][:6] + (float("nan"),) + rows[10][7:]
    times = {r.timestamp for r in features.training_set(candles(rows)).collect()}
    assert rows[10][1] not in times and rows[11][1] not in times and rows[12][1] in times


def test_zero_open(candles):
    at = random_rows(1, {"A": 1})[0][1]
    row = features.returns(candles([("A", at, 0.0, 2.0, 1.0, 2.0, 1.0, 1)])).first()
    assert row.price_change_pct is None and row.price_change_pct_guarded == 0.0


def test_empty_input(spark):
    empty = spark.createDataFrame([], CANDLE_SCHEMA)
    for profile in ["train", "serve", "reg12"]:
        assert features.features(empty, profile).isEmpty()
    assert features.training_set(empty).isEmpty()
