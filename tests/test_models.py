import json
from datetime import timedelta

import pytest
from frames import START, random_rows
from pyspark.ml import PipelineModel

from candlemill.ml import direction
from candlemill.operators import features, quality
from candlemill.plans.refresh import refresh
from candlemill.sinks.candle_table import CandleTable

NOW = "2024-02-01 00:00:00"
SMALL = {"maxIter": 2, "maxDepth": 2}


@pytest.fixture(scope="module")
def rows():
    return random_rows(31, {"A": 200, "B": 100, "SHORT": 4}, p_gap=0.05)


def test_settings(spark):
    gbt = direction.classifier_pipeline().getStages()[1]
    assert (gbt.getMaxDepth(), gbt.getMaxIter(), gbt.getStepSize(), gbt.getSeed()) == (6, 80, 0.1, 42)
    gbt = direction.regressor_pipeline().getStages()[1]
    assert (gbt.getMaxDepth(), gbt.getMaxIter(), gbt.getLossType(), gbt.getSeed()) == (5, 50, "squared", 42)
    assert len(features.TRAIN_INPUTS) == 14 and len(features.REG12_INPUTS) == 12


def test_train_save_load_score(spark, candles, rows, scratch):
    df = candles(rows)
    model = direction.train(df, **SMALL)
    path = scratch("model")
    direction.save(model, path)
    direction.save(model, path)  # overwrites
    assert direction.load_first([scratch("nowhere")]) is None
    loaded = direction.load_first([scratch("nowhere"), path])
    assert isinstance(loaded, PipelineModel)
    symbols = spark.createDataFrame([("A",), ("B",), ("SHORT",), ("NONE",)], "symbol string")
    got = {r.symbol: r for r in direction.predict_latest(df, symbols, NOW, loaded).collect()}
    assert len(got) == 4
    for symbol in "AB":
        r = got[symbol]
        newest = max((x for x in rows if x[0] == symbol), key=lambda x: x[1])
        assert r.timestamp == newest[1] and r.current_price == newest[5]
        assert r.model_name == "PySpark GBTClassifier" and 50 <= r.confidence <= 100
        assert r.prediction_signal == ("UP 📈" if r.prediction_raw == 1.0 else "DOWN 📉")
    assert got["SHORT"].model_name == "Gradient Boosting Signal Engine"
    assert got["NONE"].model_name == "GBT Classifier"
    # The same rows scored through the whole training set give the same class.
    full = loaded.transform(features.train_features(df).dropna()).collect()
    for symbol in "AB":
        last = max((r for r in full if r.symbol == symbol), key=lambda r: r.timestamp)
        assert last.prediction == got[symbol].prediction_raw


def test_rule_when_there_is_no_model(spark, candles, rows):
    symbols = spark.createDataFrame([("A",)], "symbol string")
    got = direction.predict_latest(candles(rows), symbols, NOW, None).collect()
    assert [r.model_name for r in got] == ["Gradient Boosting Signal Engine"]


def test_evaluation_counts_the_later_fifth(candles, rows):
    df = candles(rows)
    usable = features.training_set(df).count()
    _, report = direction.train_and_evaluate(df, exact=True, **SMALL)
    row = report.first()
    assert 0 < row.n_test <= usable * 0.2 + 1 and 0 <= row.accuracy <= 1


def test_regressor(candles, rows):
    df = candles(rows)
    data = direction.regression_set(df)
    assert data.count() == len(rows) - 3  # the newest candle of each symbol has no label
    model = direction.train_regressor(df, **SMALL)
    assert "prediction" in model.transform(data).columns


def page(symbol, minutes):
    cells = [
        [t, "1", "2", "1", "2", "5", t + 59_999, "0", 3, "0", "0", "0"]
        for t in (1_704_067_200_000 + m * 60_000 for m in minutes)
    ]
    return symbol, json.dumps(cells)


def test_refresh_chain(spark, candles, rows, scratch):
    newest = max(x[1] for x in rows if x[0] == "A")
    minute = (newest - START) // timedelta(minutes=1)
    pages = spark.createDataFrame([page("A", range(minute - 2, minute + 4))], "symbol string, value string")
    now_ms = 1_704_067_200_000 + (minute + 3) * 60_000
    path = scratch("model")
    table = scratch("table")
    store = CandleTable(spark, table)
    store.insert_ignore(candles(rows))
    filled, _ = refresh(store, pages, now_ms, path, **SMALL)
    # Another session finds what was filled; running again commits nothing.
    other = CandleTable(spark.newSession(), table)
    assert other.read().count() == filled.count()
    files = set(other.read().inputFiles())
    refresh(store, pages, now_ms, path, **SMALL)
    assert set(other.read().inputFiles()) == files
    # Bars up to minute + 2 are closed; some around the newest may have been there.
    assert filled.filter("symbol = 'A'").agg({"timestamp": "max"}).first()[0] == newest + timedelta(minutes=2)
    assert direction.load_first([path]) is not None


def test_refresh_stops_at_the_gate(spark, candles, rows, scratch):
    broken = rows[:50] + [rows[50][:5] + (None,) + rows[50][6:]]
    pages = spark.createDataFrame([], "symbol string, value string")
    path = scratch("model")
    with pytest.raises(quality.QualityError):
        store = CandleTable(spark, scratch("table"))
        store.insert_ignore(candles(broken))
        refresh(store, pages, 0, path, **SMALL)
    assert direction.load_first([path]) is None
