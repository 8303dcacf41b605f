from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import queries
from strata.llm.neighbours import CrossPolytope, depth, hadamard, nearest

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, asks, k):
    """Query id -> ids and scores of the nearest, from all pairs."""
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if v is not None and None not in v and np.isfinite(v).all() and any(v)]
    size = max((len(v) for _, v in ok), default=0)
    x = np.array([np.pad(v, (0, size - len(v))) for _, v in ok])
    out = {}
    for place, (i, _) in enumerate(ok):
        if i is not None and asks(i):
            s = (x * x[place]).sum(axis=1)
            order = sorted((j for j in range(len(ok)) if j != place), key=lambda j: (-s[j], ok[j][0] is None, ok[j][0] or 0))[:k]
            out[i] = [(ok[j][0], s[j]) for j in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]])


def test_hadamard():
    x = np.random.default_rng(1).normal(size=(5, 16))
    y = hadamard(x)
    assert np.allclose(hadamard(y), x) and np.allclose((x * x).sum(axis=1), (y * y).sum(axis=1))


def test_buckets_are_first_among_ranked():
    x = np.random.default_rng(2).normal(size=(40, 10))
    for levels in (1, 2):
        h = CrossPolytope(10, 3, levels)
        own = h.buckets(x)
        table, bucket = h.ranked(x, 6)
        for t in range(3):
            first = np.argmax(table == t, axis=1)
            has = (table == t).any(axis=1)
            assert (bucket[np.arange(40), first] == own[:, t])[has].all()


def test_depth_follows_rows():
    assert [depth(n, 64) for n in (0, 10, 50_000, 5_000_000, 600_000_000)] == [1, 1, 1, 2, 3]


def test_all_buckets_are_exact(spark):
    """With every bucket looked into nothing is missed; levels of two also tile by two hashes."""
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(300)]
    want = brute(rows, lambda i: i % 20 == 0, 7)
    df = spark.createDataFrame(rows, SCHEMA)
    same(found(nearest(df, F.col("vec_id") % 20 == 0, 7, probes=8 * 16)), want)


def test_tiles(spark, monkeypatch):
    """A bucket of many different, nearly equal vectors is cut into tiles and loses nothing."""
    from strata.llm import neighbours

    monkeypatch.setattr(neighbours, "TILE", 16)
    monkeypatch.setattr(neighbours, "QUERY_TILE", 3)
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in np.eye(8)[0] + 0.01 * rng.normal(size=8)]) for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    same(found(nearest(df, F.col("vec_id") % 10 == 0, 5, probes=8)), brute(rows, lambda i: i % 10 == 0, 5))


@pytest.mark.parametrize("clashing", [False, True])
def test_odd_rows(spark, clashing):
    """Nulls, zeros, non-finite parts, copies, repeated rows, other lengths and sizes, no id."""
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(0, 60)] + [(20, [1.0, 2.0, 3.0]), (None, [1.0, 2.0, 3.0]), (100, None), (120, [0.0, 0.0, 0.0])]
    rows += [(140, [1.0, None, 1.0]), (160, [float("inf"), 1.0, 1.0]), (180, [float("nan"), 1.0, 1.0]), (200, [1.0]), (220, []), (240, [1e30, -1e30, 0.0]), (241, [-0.0, 5.0, 1e-30])]
    df = spark.createDataFrame(rows, SCHEMA)
    if clashing:
        df = df.withColumns({c: F.lit("x") for c in ("id", "rank", "score", "node", "vector", "q", "best", "query_id")})
    got = nearest(df, F.col("vec_id") % 20 == 0, 5).collect()
    lists = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        lists.setdefault(r.query_id, []).append(r.id)
    want = brute(rows, lambda i: i % 20 == 0, 5)
    assert lists.keys() == want.keys()
    for q in want:
        if q != 20:  # which repeats: both rows ask
            assert lists[q] == [i for i, _ in want[q]]
    assert len(lists[20]) == 10 and sorted(lists[20])[-1] < 60


def test_few_and_no_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [-1.0, 0.0]), (2, [0.0, 1.0])]
    same(found(nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, 20)), brute(rows, lambda i: i % 20 == 0, 20))
    for some in ([], [(0, None)], [(0, [])], [(1, [1.0])], [(0, [1.0])]):
        got = nearest(spark.createDataFrame(some, SCHEMA), F.col("vec_id") % 20 == 0, 20)
        assert got.columns == ["query_id", "rank", "id", "score"] and got.count() == 0


@pytest.mark.parametrize("levels", [None, 2])
def test_recall(spark, levels):
    """At least 0.9 of the true neighbours on the given table, whose vectors have no clusters."""
    df = queries.table(spark, "/root/testdata/sf0.1", "embeddings").select("vec_id", "embedding")
    want = brute([tuple(r) for r in df.collect()], lambda i: i % 20 == 0, 20)
    got = found(nearest(df, F.col("vec_id") % 20 == 0, 20, levels=levels))
    assert got.keys() == want.keys() and all(len(x) == 20 for x in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)
