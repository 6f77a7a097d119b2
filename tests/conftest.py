import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from candlemill.schemas import CANDLE_COLS, CANDLE_SCHEMA  # noqa: E402
from candlemill.session import build_session, scratch_path  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", spark__sql__shuffle__partitions="3")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def scratch(spark):
    return lambda name: scratch_path(spark, f"test-{name}")


@pytest.fixture
def candles(spark):
    """Builds candles from (symbol, datetime, open, high, low, close, volume, trades) tuples."""

    def build(rows):
        df = spark.createDataFrame(rows, CANDLE_SCHEMA)
        assert df.columns == CANDLE_COLS
        return df

    return build
