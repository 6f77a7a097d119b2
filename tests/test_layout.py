"""The bucketed layout: same results as from plain candles, and no shuffle of rows."""

import uuid

import pytest
from frames import random_rows
from pyspark.sql import functions as F

from candlemill.operators import features, newest
from candlemill.schemas import MINUTE_MS
from candlemill.sinks import layout

ORDERING = "spark.sql.legacy.bucketedTableScan.outputOrdering"


@pytest.fixture
def lay_out(spark, scratch):
    names = []

    def write(candles, **settings):
        names.append(f"layout_{uuid.uuid4().hex}")
        return layout.write_layout(candles, names[-1], scratch(names[-1]), buckets=4, slice_bars=50, **settings)

    yield write
    for name in names:
        spark.sql(f"DROP TABLE {name}")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]


def same(got, want):
    assert sorted(got.columns) == sorted(want.columns)
    got = got.select(*want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_same_results_as_from_candles(candles, lay_out):
    df = candles(random_rows(4, {"HOT": 700, "A": 90, "B": 3}, p_null=0.1, p_gap=0.2)).cache()
    laid = lay_out(df)
    same(layout.candles_of(laid), df)
    same(layout.newest_of(laid, 70), newest.newest_n(df, 70))
    for build in [features.train_features, features.serve_features, features.training_set, features.reg12_features]:
        same(build(laid), build(df, MINUTE_MS, 50))


def test_empty_and_keyless(spark, candles, lay_out):
    assert features.training_set(lay_out(candles([]))).isEmpty()
    rows = random_rows(1, {"A": 5})
    broken = [candles(rows).withColumn(c, F.lit(None).cast(t)) for c, t in [("symbol", "string"), ("timestamp", "timestamp_ntz")]]
    laid = lay_out(candles(rows).unionByName(broken[0]).unionByName(broken[1]))
    same(layout.candles_of(laid), candles(rows))


def test_frames_beyond_the_layout_are_refused(candles, lay_out):
    laid = lay_out(candles(random_rows(1, {"A": 9})), back=5, ahead=0)
    features.lags(laid)
    for build in [features.train_features, features.training_set]:
        with pytest.raises(ValueError, match="5 rows back"):
            build(laid)


def test_nothing_is_shuffled_or_sorted(spark, candles, lay_out):
    laid = lay_out(candles(random_rows(6, {"A": 300, "B": 50})))
    text = plan(features.training_set(laid))
    assert "Exchange" not in text and text.count("Window [") == 1 and "Bucketed: true" in text
    before = spark.conf.get(ORDERING)
    spark.conf.set(ORDERING, "true")
    try:
        text = plan(features.training_set(laid))
        assert "Exchange" not in text and "Sort [" not in text
        same(features.training_set(laid), features.training_set(layout.candles_of(laid), MINUTE_MS, 50))
    finally:
        spark.conf.set(ORDERING, before)


def test_newest_rows_shuffle_counts_only(spark, candles, lay_out):
    laid = lay_out(candles(random_rows(6, {"A": 300, "B": 50})))
    text = plan(layout.newest_of(laid, 10))
    counting = text[text.index("n_rows") :]
    assert "HashAggregate" in counting
    # Counts are made inside the buckets and only then shuffled for the window over slices.
    below = counting[counting.rindex("Exchange") :]
    assert "HashAggregate" in below and "close" not in below.split("FileScan")[-1].split("ReadSchema")[-1]
