"""Every registered query against its SQL, at the smallest scale."""

import compare
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from candlemill.plans.queries import QUERIES as OWN

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    assert compare.difference(compare.spark_rows(df), compare.sql_rows(con, SQL[name])) is None
    assert compare.type_difference(df, con, SQL[name]) is None


def test_only_models_go_without_sql():
    assert set(SQL) <= set(QUERIES)
    assert set(OWN) - set(SQL) == {"gbt_train", "gbt_accuracy", "gbt_score", "gbt_regression"}


def test_entry(spark):
    assert not entry(spark).isEmpty()
