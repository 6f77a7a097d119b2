"""Runs a registered query and its SQL, and compares the results as sets of rows."""

import math
from decimal import Decimal

import duckdb

TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


SQL_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def type_difference(df, con, sql):
    relation = con.sql(sql)
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    ours = {name: SQL_TYPES.get(kind, kind) for name, kind in df.dtypes}
    return None if ours == theirs else {k: (ours.get(k), theirs.get(k)) for k in ours if ours.get(k) != theirs.get(k)}


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0 if value else 0.0)
    return str(value)


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return sorted(df.columns), _sorted_rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    relation = con.sql(sql)
    names = relation.columns
    return sorted(names), _sorted_rows(names, relation.fetchall())


def difference(spark_result, sql_result):
    """None when equal, else a short description."""
    if spark_result[0] != sql_result[0]:
        return f"columns {spark_result[0]} != {sql_result[0]}"
    ours, theirs = spark_result[1], sql_result[1]
    if ours == theirs:
        return None
    only_ours = [r for r in ours if r not in set(theirs)][:3]
    only_theirs = [r for r in theirs if r not in set(ours)][:3]
    return f"{len(ours)} rows vs {len(theirs)}; ours {only_ours}; theirs {only_theirs}"
