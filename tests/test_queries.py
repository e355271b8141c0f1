"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from quire import scenarios, scenarios_rows

QUERIES = scenarios.QUERIES | scenarios_rows.QUERIES
ORACLE_SQL = scenarios.ORACLE_SQL | scenarios_rows.ORACLE_SQL

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(cols), Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def test_every_query_has_oracle():
    assert set(ORACLE_SQL) == set(QUERIES)
    assert set(E.oracle_sql()) >= set(ORACLE_SQL) and set(E.queries()) >= set(QUERIES)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() == spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert {"dataset_name", "dataset_rows"} <= set(df.columns)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = _bag(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(ORACLE_SQL[name])
    want = _bag([d[0] for d in cur.description], cur.fetchall())
    assert got == want
