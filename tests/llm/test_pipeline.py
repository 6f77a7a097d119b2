"""The pipeline's stages, one after the other, on the smallest tables."""

import compare
import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op1_url_filter", "op5_warc", "op9_mixing"])
def test_same_rows_as_sql(spark, name):
    con = compare.connect(SF_DIR)
    df, sql = queries()[name](spark, SF_DIR), oracle_sql()[name]
    assert compare.difference(compare.spark_rows(df), compare.sql_rows(con, sql)) is None
    assert compare.type_difference(df, con, sql) is None


def test_stages(spark, scratch):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = scratch(name)
        stage(spark, docs, SF_DIR).write.parquet(path)
        docs = spark.read.parquet(path)
        kept = {r.doc_id for r in docs.select("doc_id").collect()}
        assert docs.columns == columns and kept <= ids
        if name == "quality":
            good = {i for i in ids if labels.get(i) == 1}
            assert len(kept & good) >= 0.98 * len(good)
        if name == "repeated_passages":
            assert kept == ids
        ids = kept
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert {r.doc_id for r in mixed} == ids
    whole = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, mixed))
