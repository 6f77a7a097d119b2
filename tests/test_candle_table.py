"""The stored table: commits, commits that died, and which folders are read."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlemill.operators import merge, newest, quality
from candlemill.schemas import CANDLE_SCHEMA
from candlemill.sinks.candle_table import CandleTable, _with_parts
from candlemill.sinks.files import exists

T0 = datetime(2024, 1, 1)


def row(symbol, day, close):
    return (symbol, T0 + timedelta(days=day), close, close, close, close, close, 1)


def table(df):
    return {(r.symbol, (r.timestamp - T0).days): r.close for r in df.collect()}


@pytest.fixture
def store(spark, scratch):
    return CandleTable(spark, scratch("store"))


def test_commits_like_the_merges(spark, candles, store):
    assert store.read().isEmpty() and store.newest(3).isEmpty()
    store.insert_ignore(candles([row("A", 0, 1.0), row("A", 40, 2.0), row("B C/D", 0, 3.0)]))
    before = set(store.read().inputFiles())
    added = store.insert_ignore(candles([row("A", 0, 9.0), row("A", 1, 4.0)]))
    assert table(added) == {("A", 1): 4.0}
    assert table(store.read()) == {("A", 0): 1.0, ("A", 1): 4.0, ("A", 40): 2.0, ("B C/D", 0): 3.0}
    store.upsert(candles([row("A", 0, 5.0), row("E", 70, 6.0)]))
    want = {("A", 0): 5.0, ("A", 1): 4.0, ("A", 40): 2.0, ("B C/D", 0): 3.0, ("E", 70): 6.0}
    assert table(store.read()) == want
    assert table(store.read(["E"])) == {("E", 70): 6.0} and store.read(["E"]).dtypes == store.read().dtypes
    # Folders no commit touched keep their files.
    kept = before & set(store.read().inputFiles())
    assert len(kept) == 2 and all("2024-02" in f or "D" in f for f in kept)


def test_odd_symbols_are_kept(spark, candles, store):
    """An empty name, names Hive would read as NULL, and names that differ in case only."""
    names = ["", "__HIVE_DEFAULT_PARTITION__", "null", "a", "A", "x=y/z %41"]
    rows = [row(s, 0, float(i)) for i, s in enumerate(names)]
    store.insert_ignore(candles(rows))
    store.upsert(candles([row("", 1, 9.0)]))
    want = {(s, 0): float(i) for i, s in enumerate(names)}
    assert table(store.read()) == {**want, ("", 1): 9.0}
    assert table(store.read([""])) == {("", 0): 0.0, ("", 1): 9.0}


def test_known_rows_and_rows_without_key_commit_nothing(spark, candles, store):
    store.insert_ignore(candles([row("A", 0, 1.0)]))
    files = set(store.read().inputFiles())
    keyless = candles([row("A", 1, 1.0)]).withColumn("symbol", F.lit(None).cast("string"))
    assert store.insert_ignore(candles([row("A", 0, 7.0)])).isEmpty()
    assert store.insert_ignore(keyless).isEmpty()
    store.upsert(keyless)
    assert set(store.read().inputFiles()) == files


def test_a_commit_that_died_while_staging_changed_nothing(spark, candles, store, monkeypatch):
    store.insert_ignore(candles([row("A", 0, 1.0)]))
    # Files without the mark of a finished write.
    half = candles([row("A", 0, 8.0)]).withColumns({"part_symbol": F.lit("s-A"), "part_month": F.lit("2024-01")})
    spark.conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        half.write.partitionBy("part_symbol", "part_month").parquet(store.staging)
    finally:
        spark.conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert table(store.read()) == {("A", 0): 1.0}
    store.upsert(candles([row("A", 0, 2.0)]))
    assert table(store.read()) == {("A", 0): 2.0}


@pytest.mark.parametrize("put", [False, True])
def test_a_commit_that_died_while_replacing_is_ended(spark, candles, store, monkeypatch, put):
    store.insert_ignore(candles([row("A", 0, 1.0), row("B", 0, 1.0)]))
    whole = CandleTable._put

    def dies(self):
        if put:  # in place, but the staged copy not yet gone
            kept = store.spark.read.parquet(store.staging).collect()
            schema = store.spark.read.parquet(store.staging).schema
            whole(self)
            store.spark.createDataFrame(kept, schema).write.partitionBy("part_symbol", "part_month").parquet(store.staging)
        raise RuntimeError("died")

    monkeypatch.setattr(CandleTable, "_put", dies)
    batch = candles([row("A", 0, 2.0), row("A", 3, 3.0)])
    with pytest.raises(RuntimeError):
        store.upsert(batch)
    monkeypatch.setattr(CandleTable, "_put", whole)
    want = {("A", 0): 2.0, ("A", 3): 3.0, ("B", 0): 1.0}
    assert table(CandleTable(spark, store.path).read()) == want
    store.upsert(batch)
    assert table(store.read()) == want


def test_with_arrival_the_last_counts_whenever_it_is_committed(spark, candles, scratch):
    schema = T.StructType([*CANDLE_SCHEMA, T.StructField("arrival", T.DecimalType(38, 0))])
    store = CandleTable(spark, scratch("store"), schema)
    numbered = lambda rows, at: candles(rows).withColumn("arrival", F.lit(at).cast("decimal(38,0)"))
    store.insert_ignore(candles([row("A", 0, 1.0)]).withColumn("arrival", F.lit(None).cast("decimal(38,0)")))
    store.upsert(numbered([row("A", 0, 5.0), row("A", 1, 5.0)], 5))
    store.upsert(numbered([row("A", 0, 4.0), row("A", 2, 4.0)], 4))  # a replay of something older
    assert table(store.read()) == {("A", 0): 5.0, ("A", 1): 5.0, ("A", 2): 4.0}


def test_repeated_keys_are_reduced_the_same_way_each_time(spark, candles, store):
    batch = candles([row("A", 0, 3.0), row("A", 0, 5.0), row("A", 0, 4.0)])
    assert table(merge.upsert(candles([]), batch)) == {("A", 0): 5.0}
    assert table(merge.insert_ignore(candles([]), batch.repartition(5))) == {("A", 0): 3.0}
    store.upsert(batch)
    assert table(store.read()) == {("A", 0): 5.0}


def test_newest_reads_no_more_months_than_needed(spark, candles, store):
    dense = [row("A", d, float(d)) for d in range(0, 120)]
    sparse = [row("B", d, float(d)) for d in range(0, 120, 40)]
    store.insert_ignore(candles(dense + sparse))
    months = {(r.part_symbol, r.part_month) for r in store.newest_parts(3).collect()}
    assert {m for s, m in months if s == "s-A"} == {"2024-04"}
    assert len({m for s, m in months if s == "s-B"}) == 3
    got, want = store.newest(3), store.read()
    assert table(newest.newest_n(got, 3)) == table(newest.newest_n(want, 3))
    assert got.count() < want.count()


def test_commits_read_only_the_folders_they_touch(spark, candles, store):
    store.insert_ignore(candles([row(s, d, 1.0) for s in "AB" for d in range(0, 120, 10)]))
    parts = spark.createDataFrame([("s-A", "2024-02")], "part_symbol string, part_month string")
    plan = store._within(parts)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    text = store.read(["A"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "part_symbol" in text.split("PartitionFilters: [")[1].split("]")[0]


def notes(store):
    return {(r.symbol, r.month): (r.n_rows, r.n_null_prices, r.n_duplicate_keys) for r in store.faults().collect()}


def test_faults_are_counted_as_parts_are_written(spark, candles, store):
    with pytest.raises(quality.QualityError, match="no candles"):
        store.gate()
    store.insert_ignore(candles([row("A", 0, 1.0), row("B", 0, 1.0)]))
    store.gate()
    assert not exists(spark, store.noted)  # nothing was found, nothing noted
    store.insert_ignore(candles([row("A", 1, None), row("A", 40, 2.0), row("", 0, None)]))
    want = {("A", "2024-01"): (2, 1, 0), ("", "2024-01"): (1, 1, 0)}
    assert notes(store) == want
    # A commit elsewhere, and one that adds nothing, forget no fault.
    store.upsert(candles([row("B", 1, 1.0)]))
    store.insert_ignore(candles([row("A", 1, 5.0)]))
    assert notes(CandleTable(spark, store.path)) == want
    for gated in [store.gate, lambda: quality.gate(store.read())]:
        with pytest.raises(quality.QualityError, match="2 candles lack"):
            gated()
    store.upsert(candles([row("A", 1, 5.0)]))
    assert notes(store) == {("", "2024-01"): (1, 1, 0)}
    store.upsert(candles([row("", 0, 5.0)]))
    assert notes(store) == {}
    store.gate()


def test_repeated_keys_are_counted(spark, candles, store):
    """Merges leave no repeated keys; a fault of theirs would be noted all the same."""
    twice = candles([row("A", 0, 1.0), row("A", 0, 2.0), row("A", 1, 2.0), row("A", 40, 2.0), row("B", 0, 1.0)])
    store._commit(_with_parts(twice))
    assert notes(store) == {("A", "2024-01"): (3, 0, 1)}
    with pytest.raises(quality.QualityError, match="duplicate"):
        store.gate()


def test_faults_of_a_commit_that_died(spark, candles, store, monkeypatch):
    store.insert_ignore(candles([row("A", 0, 1.0)]))
    with monkeypatch.context() as broken:
        broken.setattr(CandleTable, "_note_faults", lambda self: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.insert_ignore(candles([row("A", 1, None)]))
    other = CandleTable(spark, store.path)
    with pytest.raises(quality.QualityError):
        other.gate()
    assert notes(other) == {("A", "2024-01"): (2, 1, 0)}


def test_checks_share_the_pass_that_writes(spark, candles, store, monkeypatch):
    store.insert_ignore(candles([row("A", 0, 1.0), row("A", 40, 1.0)]))
    rows = store._table()
    text = store._checked(rows, Observation())._jdf.queryExecution().executedPlan().toString()
    assert [text.count(x) for x in ("CollectMetrics", "Exchange hashpartitioning", "Sort [", "Scan parquet")] == [1, 1, 1, 1]
    assert text.index("CollectMetrics") < text.index("Exchange")
    # A clean commit reads its staged parts once, to put them in place, and the gate reads none.
    reads = []
    staged = CandleTable._read_staged
    monkeypatch.setattr(CandleTable, "_read_staged", lambda self: reads.append(1) or staged(self))
    store.upsert(candles([row("A", 0, 2.0)]))
    store.gate()
    assert len(reads) == 1
