from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import queries

SF = "/root/testdata/sf0.001"
TABLES = "documents benchmark labels pages conversations embeddings".split()


def test_stages(spark):
    """Each stage keeps columns and takes rows away; the last one has token ids of all that is left."""
    docs = queries.table(spark, SF, "documents")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = corpus_pipeline.stored(stage(spark, docs, SF), f"test-{k}")
        left = {r.doc_id for r in out.select("doc_id").collect()}
        assert left <= ids and out.count() == len(left)
        if k < 4:
            assert out.columns == docs.columns
            docs, ids = out, left
    assert left == ids
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.decoded == (texts[r.doc_id] or "") for r in out.collect())


def test_stages_on_odd_tables(spark):
    schema = queries.table(spark, SF, "documents").schema
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "a b c d e f", "en", "s", 1), (3, "a b c d e f", "en", "s", 1), (3, "a b c d e f", "en", "s", 1)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for _, stage in corpus_pipeline.STAGES[:4]:
            docs = stage(spark, docs, SF)
            assert docs.columns == schema.names
        assert corpus_pipeline.STAGES[4][1](spark, docs, SF).count() <= len(data)


#: Names that the stages and their operators use themselves.
INTERNAL = "kept keep_id group_size full_hash _quality score _text _may _bucket _map _at _gone _of _row _rest _id _t _n _p _b node counts prefix n label ids decoded a.b".split()


def test_columns_named_like_internal_ones(spark):
    """Such columns of the caller come out of each stage as they went in."""
    docs = queries.table(spark, SF, "documents")
    own = docs.select("doc_id", "text", *[F.concat(F.lit(c), F.col("doc_id")).alias(c) for c in INTERNAL], "lang")
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, own, SF)
        plain = stage(spark, docs, SF)
        assert out.columns == own.columns
        rows = out.collect()
        assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in plain.collect())
        assert all(r[c] == f"{c}{r.doc_id}" for r in rows for c in INTERNAL)


def test_near_stage_drops_rows_not_ids(spark):
    """Unrelated rows that share a null or repeated id with a near copy stay; of near copies one is left."""
    schema = queries.table(spark, SF, "documents").schema
    a, b, c = ("%s %s %s %s %s %s" % tuple(x * 6) for x in "xyz")
    texts = [(1, a), (None, a + " "), (None, "a clean text of no one else"), (3, b), (4, b + " "), (4, "another clean text of id four"), (None, c), (None, c + " ")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in texts], schema)
    left = [(r.doc_id, r.text) for r in corpus_pipeline.near_stage(spark, docs, SF).collect()]
    assert sorted(t.strip() for _, t in left) == sorted([a, b, c, texts[2][1], texts[5][1]])
    assert {(1, a), (3, b), texts[2], texts[5]} <= set(left)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(queries.ORACLE_SQL[name])
    got = queries.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(want.project(", ".join(columns)).fetchall())
