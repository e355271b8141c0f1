"""The registered queries over the smallest tables, and the pipeline against brute force."""

import hashlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_disclosure import brute as brute_pii
from test_near_dedup import brute as brute_near

import corpus_pipeline
from quire.llm import registry
from quire.llm.sentencepiece_dropout import MODEL, load

SF = "/root/testdata/sf0.001"
TABLES = "documents pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(repr([round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order]) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_sql(spark, con, name):
    df = registry.QUERIES[name](spark, SF)
    got = bag(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(registry.ORACLE_SQL[name])
    assert got == bag([d[0] for d in cur.description], cur.fetchall())


def test_names():
    assert sorted(int(q[2:].split("_")[0]) for q in registry.QUERIES) == list(range(1, 14))


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.written(stage(spark, docs, SF), name)
        kept[name] = ({r.doc_id: r for r in before.collect()}, {r.doc_id: r for r in docs.collect()})
        if name != "sentencepiece":
            assert docs.columns == columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before, after = kept["quality"]
    assert np.mean([(i in after) == bool(labels[i]) for i in before if i in labels]) > 0.9
    before, after = kept["near_dedup"]
    want = brute_near([(i, r.text) for i, r in before.items()], 80)
    assert set(after) == set(want.values())
    before, after = kept["decontaminate"]
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert not [i for i, r in before.items() if any(t in r.text for t in items) and i in after]
    assert len(before) - len(after) < 0.15 * len(before)
    before, after = kept["pii"]
    assert set(before) == set(after)
    for i, r in before.items():
        found = brute_pii(r.text)
        assert (r.text == after[i].text) == (not found) and after[i].n_chars == len(after[i].text)
        assert not any(r.text[a:b] in after[i].text for k, a, b in found if k == 0)
    before, after = kept["sentencepiece"]
    m = load(MODEL, 0.1, 7, 4)
    for i, r in before.items():
        assert m.decode(bytes(after[i].ids)).decode() == r.text
        assert after[i].text_sha256 == hashlib.sha256(r.text.encode()).hexdigest() and len(after[i].ids) == 2 * after[i].n_pieces


def test_rows_without_id_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(30).withColumn("spans", F.lit("x"))
    docs = docs.unionByName(docs.limit(1).withColumn("doc_id", F.lit(None).cast("long")))
    out = corpus_pipeline.near_dedup(spark, docs, SF)
    assert out.filter("doc_id is null").count() == 1 and out.columns == docs.columns
