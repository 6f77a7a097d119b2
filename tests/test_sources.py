import os
import tempfile
from datetime import datetime

import pytest
from frames import random_rows
from pyspark.sql import functions as F

from candlemill.plans.refresh import seed
from candlemill.sinks.candle_table import CandleTable
from candlemill.schemas import CANDLE_COLS, CANDLE_SCHEMA, SYMBOLS
from candlemill.sinks import jdbc as jdbc_sink
from candlemill.sinks import tables
from candlemill.sinks.csvfiles import write_csv
from candlemill.sources import csvfiles, jdbc
from candlemill.sources.canonical import canonical

HEADER = "timestamp,open,high,low,close,volume,number_of_trades"


def test_plain_files_as_the_exchange_export_names_them(spark):
    folder = tempfile.mkdtemp(prefix="csv-")
    files = {
        "BTCUSDT_1m_1year.csv": "2024-01-01 00:00:00,1,3,0.5,2,10,7",
        "ETHUSDT_1m_1month.csv": "2024-01-01 00:00:00,1,3,0.5,x,10,7\nnot a time,1,1,1,1,1,1",
        "notes.csv": "2024-01-01 00:00:00,1,3,0.5,2,10,7",
        "BTCUSDT_5m_1year.csv": "2024-01-01 00:00:00,1,3,0.5,2,10,7",
    }
    for name, body in files.items():
        with open(os.path.join(folder, name), "w") as out:
            out.write(f"{HEADER}\n{body}\n")
    got = csvfiles.read_candles(spark, folder)
    assert got.columns == CANDLE_COLS
    rows = sorted(map(tuple, got.collect()), key=str)
    t = datetime(2024, 1, 1)
    assert ("BTCUSDT", t, 1.0, 3.0, 0.5, 2.0, 10.0, 7) in rows
    assert ("ETHUSDT", t, 1.0, 3.0, 0.5, None, 10.0, 7) in rows
    assert ("ETHUSDT", None, 1.0, 1.0, 1.0, 1.0, 1.0, 1) in rows
    assert len(rows) == 3
    rejected = {os.path.basename(r.path): r.n_rows for r in csvfiles.rejected_files(spark, folder).collect()}
    assert rejected == {"notes.csv": 1, "BTCUSDT_5m_1year.csv": 1}


@pytest.mark.parametrize(
    "path, symbol",
    [
        ("file:/d/BTCUSDT_1m_1year.csv", "BTCUSDT"),
        ("file:/d/BTCUSDT_1m_1month.csv", "BTCUSDT"),
        ("C:\\d\\BTCUSDT_1m_1year.csv", "BTCUSDT"),
        ("file:/d/file=BTCUSDT_1m_1year.csv/part-0.csv", "BTCUSDT"),
        ("file:/d/BTCUSDT_1m_1year.csv.gz", ""),
        ("file:/d/BTCUSDT.csv", ""),
    ],
)
def test_symbol_of_path(spark, path, symbol):
    df = spark.createDataFrame([(path,)], "p string")
    assert df.select(csvfiles.symbol_of_path(F.col("p"))).first()[0] == symbol


def test_csv_round_trip(spark, candles, scratch):
    df = candles(random_rows(1, {"AAA": 40, "BBB": 7}))
    path = scratch("csv")
    write_csv(df, path)
    back = csvfiles.read_candles(spark, path)
    assert back.exceptAll(df).isEmpty() and back.count() == 47


def test_seed_keeps_what_is_stored(spark, candles, scratch):
    rows = random_rows(1, {"AAA": 10}, p_gap=0)
    path = scratch("csv")
    write_csv(candles(rows), path, "1month")
    mine = ("AAA", rows[3][1], 0.0, 0.0, 0.0, 0.0, 0.0, 0)
    table = CandleTable(spark, scratch("table"))
    table.insert_ignore(candles([mine]))
    assert seed(spark, path, table).count() == 9
    seeded = {r.timestamp: r.close for r in table.read().collect()}
    assert len(seeded) == 10 and seeded[rows[3][1]] == 0.0 and seeded[rows[4][1]] == rows[4][5]


def test_canonical_types_from_decimals(candles):
    df = candles(random_rows(1, {"AAA": 5}))
    wide = df.withColumns({c: F.col(c).cast("decimal(38,18)") for c in ["open", "close"]})
    assert canonical(wide).dtypes == df.dtypes


def test_jdbc_predicates_cover_each_row_once(candles):
    rows = [(s, datetime(y, m, d, 23, 59), 1.0, 1.0, 1.0, 1.0, 1.0, 1)
            for s in ["A", "O'B"] for y in (2022, 2023, 2024) for m in (1, 2, 12) for d in (1, 28)]
    df = candles(rows)
    predicates = jdbc.scan_predicates(["A", "O'B"], (2023, 11), (2024, 2))
    assert len(predicates) == 2 * 5
    # Spark text doubles a quote with a backslash instead.
    texts = [p.replace("O''B", "O\\'B").replace("TIMESTAMP ", "TIMESTAMP_NTZ ") for p in predicates]
    assert sum(df.filter(p).count() for p in texts) == len(rows)
    assert df.filter(" OR ".join(f"({p})" for p in texts)).count() == len(rows)


def test_jdbc_write_options_and_merge_statement():
    options = jdbc_sink.writer_options()
    assert options["truncate"] == "true" and options["batchsize"] == "5000"
    statement = jdbc_sink.merge_statement("staging")
    assert "ON CONFLICT (symbol, timestamp) DO UPDATE SET open = excluded.open" in statement
    assert statement.count("excluded.") == 6
    assert jdbc_sink.merge_statement("staging", update=False).endswith("DO NOTHING")


def test_table_is_created_once_and_reflected(spark, candles, scratch):
    location = scratch("table")
    name = "candles_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    tables.create_table(spark, location, name)
    df = candles(random_rows(1, {"AAA": 5, "BBB": 6}))
    tables.append_rows(df, name)
    tables.create_table(spark, location, name)
    stored = tables.read_rows(spark, name)
    assert stored.dtypes == df.dtypes and stored.exceptAll(df).isEmpty() and stored.count() == 11
    assert {f.name: f.dataType for f in spark.table(name).schema} == {
        f.name: f.dataType for f in CANDLE_SCHEMA
    }
    assert sorted(os.listdir(location))[-2:] == ["symbol=AAA", "symbol=BBB"]
    spark.sql(f"DROP TABLE {name}")


def test_symbol_universe():
    assert len(SYMBOLS) == len(set(SYMBOLS)) == 10 and all(s == s.upper() for s in SYMBOLS)
