from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, asks, n_positives=5, n_negatives=3):
    """From all pairs, in Python integers."""
    ok = [(i, [math.floor(256 * float(np.float32(x))) for x in v], y) for i, v, y in rows if y is not None and v is not None and None not in v and np.isfinite(v).all()]
    anchors = {}
    for i, v, y in ok:
        if i is not None and asks(i):
            anchors[i] = min(anchors.get(i, (y, v)), (y, v))
    out = []
    for a, (label, v) in sorted(anchors.items()):
        scored = [(-sum(p * q for p, q in zip(v, w)), i is None, i or 0, i, y) for i, w, y in ok if i != a]
        scored.sort(key=lambda r: r[:3])
        for s, _, _, positive, _ in [r for r in scored if r[4] == label][:n_positives]:
            inside = [r for r in scored if r[4] != label and 50 * -s <= 100 * -r[0] <= 95 * -s][:n_negatives]
            out += [(a, positive, rank, r[3], -s, -r[0]) for rank, r in enumerate(inside, 1)]
    return out


def found(df):
    key = lambda r: tuple((x is None, x or 0) for x in r)
    return sorted(map(tuple, df.collect()), key=key)


def expected(rows, asks=lambda i: i % 5 == 0, **more):
    return sorted(brute(rows, asks, **more), key=lambda r: tuple((x is None, x or 0) for x in r))


def random(n, seed, d=6, labels=3, spread=1.0):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in np.float32(1 + spread * rng.normal(size=d))], int(rng.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("spread", [1.0, 0.01])
def test_like_brute_force(spark, spread, monkeypatch):
    """Also over several blocks of anchors and many tiles, where bounds prune."""
    monkeypatch.setattr(H, "TILE", 16)
    rows = random(200, 1, spread=spread) + [(1000 + i, [1.5, 0.0, 1.0, 1.0, 2.0, 1.0], i % 3) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = expected(rows)
    assert want
    for block_rows in (1024, 10):
        assert found(H.hard_negatives(df, F.col("vec_id") % 5 == 0, block_rows=block_rows)) == want


def test_odd_rows(spark):
    """Nulls, non-finite and huge components, other lengths, ties, repeated rows and ids, clashing columns."""
    rows = [*random(30, 2, d=3), (None, [1.0, 1.0, 1.0], 0), (None, [1.0, 1.0, 1.0], 1), (40, None, 1), (45, [1.0, 1.0, 1.0], None), (50, [1.0, None, 1.0], 1), (55, [float("inf"), 1.0, 0.0], 0)]
    rows += [(60, [float("nan"), 1.0, 0.0], 0), (65, [], 1), (70, [2.0], 2), (75, [1.0, 1.0, 1.0], 0), (75, [1.0, 1.0, 1.0], 0), (75, [1.0, 2.0, 1.0], 1), (76, [0.9, 0.9, 0.9], 1), (77, [0.9, 0.9, 0.9], 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("anchor", "score", "rank", "none", "id", "_label", "_id", "_v")})
    assert found(H.hard_negatives(df, F.col("vec_id") % 5 == 0)) == expected(rows)
    rows += [(80, [3e12, 1e3, 1.0], 0), (81, [2e3, 1.0, 1.0], 0), (82, [1.5e3, 1.0, 2.0], 1)]  # products beyond what a double holds
    df = spark.createDataFrame(rows, SCHEMA)
    top = 2**63 - 1
    clip = lambda r: (*r[:4], *(max(-top - 1, min(top, x)) for x in r[4:]))
    got = [r for r in found(H.hard_negatives(df, F.col("vec_id") % 5 == 0)) if r[0] != 80]
    assert got == [clip(r) for r in expected(rows) if r[0] != 80]


def test_empty(spark):
    for rows in ([], [(0, None, 1)], [(0, [], 1)], [(0, [1.0], 1)], [(1, [1.0], 1), (2, [1.0], 2)]):
        got = H.hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 5 == 0)
        assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"] and got.count() == 0


def test_bounds_hold_and_prune():
    """Bounds along the tree contain the exact scores; of clustered anchors few rows are scored again."""
    rng = np.random.default_rng(5)
    anchors = H.scaled(np.repeat(rng.normal(size=(4, 16)), 10, axis=0) + 0.001 * rng.normal(size=(40, 16)), 256)
    block = H.Block(list(range(40)), [0] * 40, anchors)
    assert sorted(block.tree.order) == list(range(40)) and all(block.tree.order.index(p) < block.tree.order.index(k) for k, p in enumerate(block.tree.parent) if p >= 0)
    x = H.scaled(rng.normal(size=(500, 16)), 256)
    scores = H.Scores(block, x)
    again = 0
    for a in block.tree.order:
        scores.bounds(a)
        exact = x @ anchors[a]
        assert (scores.low[a] <= exact).all() and (exact <= scores.high[a]).all()
        best = np.partition(exact, -5)[-5]
        at = np.flatnonzero(scores.high[a] >= best) if block.tree.parent[a] >= 0 else np.arange(500)
        again += len(at)
        scores.settle(a, at)
    assert again < 40 * 500 / 3
