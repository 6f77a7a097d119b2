"""Gradient-boosted trees on candle features: fit, evaluate, save, load, score."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from candlemill.operators.features import (
    REG12_INPUTS,
    TRAIN_INPUTS,
    features,
    reg12_features,
    training_set,
)
from candlemill.operators.newest import newest_n, newest_row
from candlemill.operators.signals import (
    CARRIED,
    HISTORY_ROWS,
    LATEST_WEIGHTS,
    rule_latest,
    signal_text,
)
from candlemill.operators.slices import SLICE_BARS
from candlemill.operators.split import SPLIT_AT, time_split
from candlemill.schemas import MINUTE_MS
from candlemill.session import scratch_path, scratch_root

# Model settings and the name a scored row carries.
CLASSIFIER = {"maxDepth": 6, "maxIter": 80, "stepSize": 0.1, "seed": 42}
REGRESSOR = {"maxDepth": 5, "maxIter": 50, "lossType": "squared", "seed": 42}
MODEL_NAME = "PySpark GBTClassifier"


def classifier_pipeline(**settings):
    gbt = GBTClassifier(featuresCol="features", labelCol="label", **{**CLASSIFIER, **settings})
    return Pipeline(stages=[_assembler(TRAIN_INPUTS), gbt])


def regressor_pipeline(**settings):
    gbt = GBTRegressor(featuresCol="features", labelCol="label", **{**REGRESSOR, **settings})
    return Pipeline(stages=[_assembler(REG12_INPUTS), gbt])


def _assembler(inputs):
    return VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="error")


def stored_once(rows, name):
    """Boosting reads its input many times: write it once to the shared folder.

    Unlike cached blocks, the files outlive a lost executor.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def fit_classifier(rows, **settings):
    """Fits on all given rows of a training set."""
    scratch_root(rows.sparkSession)  # boosting cuts its lineage in the checkpoint folder
    return classifier_pipeline(**settings).fit(rows.select(*TRAIN_INPUTS, "label"))


def train(candles, interval_ms=MINUTE_MS, slice_bars=SLICE_BARS, **settings):
    """Retrains on every usable candle, without split or evaluation."""
    rows = training_set(candles, interval_ms, slice_bars).select(*TRAIN_INPUTS, "label")
    return fit_classifier(stored_once(rows, "training"), **settings)


def train_and_evaluate(
    candles, exact=False, q=SPLIT_AT, interval_ms=MINUTE_MS, slice_bars=SLICE_BARS, **settings
):
    """Fits on the earlier candles, scores the later ones; the model and a one-row report."""
    rows = training_set(candles, interval_ms, slice_bars).select(
        "timestamp", *TRAIN_INPUTS, "label"
    )
    split = time_split(stored_once(rows, "training"), exact, q)
    split = stored_once(split.select(*TRAIN_INPUTS, "label", "is_train"), "split")
    model = fit_classifier(split.filter("is_train"), **settings)
    hit = (F.col("prediction") == F.col("label")).cast("double")
    report = model.transform(split.filter(~F.col("is_train"))).agg(
        F.count("*").alias("n_test"), F.avg(hit).alias("accuracy")
    )
    return model, report


def regression_set(candles, interval_ms=MINUTE_MS, slice_bars=SLICE_BARS):
    """The twelve inputs with the next close as label."""
    rows = reg12_features(candles, interval_ms, slice_bars, with_next_close=True)
    return rows.withColumnRenamed("next_close", "label").dropna("any")


def train_regressor(candles, interval_ms=MINUTE_MS, slice_bars=SLICE_BARS, **settings):
    scratch_root(candles.sparkSession)
    rows = stored_once(regression_set(candles, interval_ms, slice_bars), "regression")
    return regressor_pipeline(**settings).fit(rows.select(*REG12_INPUTS, "label"))


def save(model, path):
    model.write().overwrite().save(path)


def load(path):
    return PipelineModel.load(path)


def load_first(paths):
    """The first model that loads, or None: callers then use the rule."""
    for path in paths:
        try:
            return load(path)
        except Exception as error:  # a missing folder and a broken model are treated alike
            print(f"no model at {path}: {type(error).__name__}")
    return None


def score_latest(model, candles, profile="train", n=HISTORY_ROWS):
    """The model's prediction for the newest candle of every symbol, in one job.

    Features are those of ``profile``, which should be the one the model was
    trained with.
    """
    rows = newest_row(features(newest_n(candles, n), profile, slice_bars=None))
    usable = rows.dropna(subset=TRAIN_INPUTS)
    scored = model.transform(usable)
    chance = F.get(vector_to_array("probability"), F.col("prediction").cast("int"))
    return scored.select(
        "symbol",
        "timestamp",
        F.col("close").alias("current_price"),
        signal_text(F.col("prediction")).alias("prediction_signal"),
        F.col("prediction").alias("prediction_raw"),
        (chance * 100.0).alias("confidence_exact"),
        *CARRIED,
        F.lit(MODEL_NAME).alias("model_name"),
    )


def predict_latest(candles, symbols, now, model=None, profile="train", weights=LATEST_WEIGHTS):
    """One prediction per symbol: by the model if there is one, else by the rule.

    A symbol the model cannot score (too short a history) falls back to the rule,
    one without candles to the cold-start answer.
    """
    by_rule = rule_latest(candles, symbols, now, weights)
    if model is None:
        return by_rule
    by_model = score_latest(model, candles, profile)
    by_model = by_model.withColumn("confidence", F.round("confidence_exact", 1))
    rest = by_rule.join(by_model.select("symbol"), "symbol", "left_anti")
    return by_model.select(*by_rule.columns).unionByName(rest)


def importances(spark, model, inputs):
    """Feature importances of a fitted pipeline, one row per input."""
    values = model.stages[-1].featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(inputs, values)), "feature string, importance double")
