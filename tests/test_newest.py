from frames import random_rows, to_pandas

from candlemill.operators import newest


def _keys(df):
    return sorted((r.symbol, r.timestamp) for r in df.select("symbol", "timestamp").collect())


def test_newest_n_over_many_tasks(candles):
    rows = random_rows(1, {"HOT": 500, "A": 30, "B": 3})
    golden = to_pandas(rows).groupby("symbol").tail(20)
    want = sorted(zip(golden.symbol, [t.to_pydatetime() for t in golden.timestamp]))
    for salts in [1, 3, 64]:
        assert _keys(newest.newest_n(candles(rows).repartition(16), 20, salts)) == want


def test_newest_n_of_one_symbol(candles):
    df = candles(random_rows(1, {"A": 30, "B": 30}))
    got = newest.newest_n_of(df, "A", 5).collect()
    assert [r.symbol for r in got] == ["A"] * 5
    assert [r.timestamp for r in got] == sorted((r.timestamp for r in got), reverse=True)


def test_newest_row_keeps_nulls(candles):
    rows = random_rows(1, {"A": 5}, p_gap=0)
    rows[-1] = rows[-1][:5] + (None,) + rows[-1][6:]
    row = newest.newest_row(candles(rows)).first()
    assert row.timestamp == rows[-1][1] and row.close is None


def test_symbols_without_rows_stay(spark, candles):
    symbols = spark.createDataFrame([("A",), ("NONE",)], "symbol string")
    rows = newest.per_symbol(symbols, newest.latest_timestamp(candles(random_rows(1, {"A": 5}))))
    got = {r.symbol: r.max_timestamp for r in rows.collect()}
    assert got["NONE"] is None and got["A"] is not None
