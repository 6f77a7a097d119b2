from datetime import datetime

import pytest
from pyspark.sql import functions as F

from candlemill.functions import timefn

# Clock changes in New York and Berlin, the epoch, and a time before it.
TIMES = [
    datetime(2024, 3, 10, 2, 30),
    datetime(2024, 3, 31, 2, 30),
    datetime(2024, 11, 3, 1, 30),
    datetime(1970, 1, 1),
    datetime(1969, 12, 31, 23, 59, 59),
    datetime(2024, 1, 1, 0, 0, 7, 179000),
]


@pytest.fixture(params=["UTC", "America/New_York", "Europe/Berlin"])
def zone(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


def test_round_trip_in_any_zone(spark, zone):
    epoch = datetime(1970, 1, 1)
    df = spark.createDataFrame([(t,) for t in TIMES], "t timestamp_ntz")
    rows = df.select(
        "t",
        timefn.epoch_ms("t").alias("ms"),
        timefn.epoch_s("t").alias("s"),
        timefn.from_epoch_ms(timefn.epoch_ms("t")).alias("back"),
        timefn.format_text("t").alias("text"),
        timefn.parse_text(timefn.format_text("t")).alias("parsed"),
    ).collect()
    for r in rows:
        want = round((r.t - epoch).total_seconds() * 1000)
        assert r.ms == want and r.back == r.t and r.s == want // 1000
        assert r.text == r.t.strftime("%Y-%m-%d %H:%M:%S")
        assert r.parsed == r.t.replace(microsecond=0)


def test_bad_text_and_numbers_are_null(spark, zone):
    texts = ["2024-13-01 00:00:00", "2024-01-01", "2024-01-01T00", "x", None, "2024-13-01 00:00"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert df.select(timefn.parse_text("t").alias("p")).filter(F.col("p").isNotNull()).isEmpty()
    far = spark.createDataFrame([(10**18,), (None,)], "ms long")
    assert far.select(timefn.from_epoch_ms("ms").alias("p")).filter(F.col("p").isNotNull()).isEmpty()


def test_text_with_zone_fraction_or_no_seconds(spark, zone):
    texts = ["2024-01-01T00:30:00", "2024-01-01 00:30", "2024-01-01T00:30Z", "2024-01-01T02:30:00.000+02:00"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(timefn.parse_text("t").alias("p"))
    assert {r.p for r in df.collect()} == {datetime(2024, 1, 1, 0, 30)}
