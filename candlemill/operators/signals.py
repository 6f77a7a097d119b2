"""Rule signals: the newest prediction, the back-test table and its accuracy."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from candlemill.functions.numeric import EPSILON, clamp
from candlemill.operators.features import serve_features
from candlemill.operators.newest import newest_n, newest_row, per_symbol

# Texts, rule weights (return, distance from the average),
# confidence formula, rows read.
UP = "UP 📈"
DOWN = "DOWN 📉"
MATCH = "✅ Match"
DIFF = "❌ Diff"
RULE_NAME = "Gradient Boosting Signal Engine"
COLD_NAME = "GBT Classifier"
LATEST_WEIGHTS = (0.5, 0.3)
BACKTEST_WEIGHTS = (0.6, 0.4)
BASE_CONFIDENCE = 70.0
CONFIDENCE_SLOPE = 500
MIN_CONFIDENCE = 60.0
MAX_CONFIDENCE = 95.0
COLD_CONFIDENCE = 75.0
HISTORY_ROWS = 100
BACKTEST_MARGIN = 10
MIN_BACKTEST_ROWS = 3

DISPLAY_NAMES = {
    "timestamp": "Time",
    "symbol": "Symbol",
    "close": "Current Price",
    "next_close": "Next Minute Price",
    "actual_trend": "Actual Trend",
    "predicted_signal": "AI Prediction Signal",
    "is_correct": "Accuracy Match",
}

CARRIED = ["price_change_pct", "rolling_avg_15m", "rolling_avg_1h", "volatility_15m", "hl_spread"]


def rule_score(weights):
    average = F.col("rolling_avg_15m")
    distance = (F.col("close") - average) / (average + F.lit(EPSILON))
    return F.lit(weights[0]) * F.col("price_change_pct") + F.lit(weights[1]) * distance


def signal_text(value):
    return F.when(value == 1.0, UP).otherwise(DOWN)


def rule_confidence(score):
    raw = F.lit(BASE_CONFIDENCE) + F.abs(score) * F.lit(CONFIDENCE_SLOPE)
    return clamp(raw, MIN_CONFIDENCE, MAX_CONFIDENCE)


def latest_history(candles, n=HISTORY_ROWS):
    """Serving features over the newest ``n`` candles of each symbol."""
    return serve_features(newest_n(candles, n), slice_bars=None)


def rule_latest(candles, symbols, now, weights=LATEST_WEIGHTS):
    """The rule's prediction for the newest candle of every symbol in ``symbols``.

    A symbol without candles gets the cold-start answer, stamped ``now``.
    """
    row = newest_row(latest_history(candles))
    scored = row.withColumn("score", rule_score(weights)).withColumn(
        "prediction_raw", F.when(F.col("score") >= 0, F.lit(1.0)).otherwise(F.lit(0.0))
    )
    predicted = scored.select(
        "symbol",
        "timestamp",
        F.col("close").alias("current_price"),
        signal_text(F.col("prediction_raw")).alias("prediction_signal"),
        "prediction_raw",
        rule_confidence(F.col("score")).alias("confidence_exact"),
        *CARRIED,
        F.lit(RULE_NAME).alias("model_name"),
    )
    return cold_start(symbols, predicted, now)


def cold_start(symbols, predicted, now):
    """Every symbol once, with default values where there is no prediction."""
    known = predicted.withColumn("_known", F.lit(True))
    joined = per_symbol(symbols.select("symbol"), known)
    defaults = {
        "timestamp": F.lit(now).cast("timestamp_ntz"),
        "current_price": F.lit(0.0),
        "prediction_signal": F.lit(UP),
        "prediction_raw": F.lit(1.0),
        "confidence_exact": F.lit(COLD_CONFIDENCE),
        **{c: F.lit(0.0) for c in CARRIED},
        "model_name": F.lit(COLD_NAME),
    }
    missing = F.col("_known").isNull()
    filled = {c: F.when(missing, d).otherwise(F.col(c)) for c, d in defaults.items()}
    return joined.select("symbol", *[e.alias(c) for c, e in filled.items()]).withColumn(
        "confidence", F.round("confidence_exact", 1)
    )


def _backtest_rows(candles, limit, weights):
    """Numeric back-test rows: newest ``limit + 10`` candles, then features, then the cut."""
    recent = newest_n(candles, limit + BACKTEST_MARGIN)
    w = W.partitionBy("symbol").orderBy("timestamp")
    rows = serve_features(recent, slice_bars=None).withColumns(
        {
            "next_close": F.lead("close").over(w),
            "_rows": F.count("*").over(W.partitionBy("symbol")),
        }
    )
    rows = rows.filter(F.col("_rows") >= MIN_BACKTEST_ROWS).withColumn("score", rule_score(weights))
    rows = rows.withColumns(
        {
            "actual": F.when(F.col("next_close") > F.col("close"), 1.0).otherwise(0.0),
            "predicted": F.when(F.col("score") >= 0, 1.0).otherwise(0.0),
        }
    )
    return newest_n(rows.dropna(subset=["next_close"]), limit)


def backtest(candles, limit=20, weights=BACKTEST_WEIGHTS):
    """Predicted against actual direction of the newest ``limit`` candles of each symbol."""
    rows = _backtest_rows(candles, limit, weights)
    hit = F.col("actual") == F.col("predicted")
    return rows.select(
        "timestamp",
        "symbol",
        "close",
        "next_close",
        signal_text(F.col("actual")).alias("actual_trend"),
        signal_text(F.col("predicted")).alias("predicted_signal"),
        F.when(hit, MATCH).otherwise(DIFF).alias("is_correct"),
    ).withColumnsRenamed(DISPLAY_NAMES)


def backtest_accuracy(candles, limit=20, weights=BACKTEST_WEIGHTS):
    """Share of matches per symbol in the back-test table."""
    rows = _backtest_rows(candles, limit, weights)
    hit = (F.col("actual") == F.col("predicted")).cast("double")
    return rows.groupBy("symbol").agg(
        F.count("*").alias("n_rows"), F.avg(hit).alias("accuracy")
    )
