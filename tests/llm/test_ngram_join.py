from __future__ import annotations

import random
import re

import numpy as np

from strata.llm import ngram_join as nj
from strata.llm.components import components
from strata.llm.ngram_join import CountTree, ngram_join


def brute(rows, percent=80):
    sets = []
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        sets.append((i, frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()))
    label = list(range(len(rows)))
    links = [0] * len(rows)

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                links[a], links[b] = links[a] + 1, links[b] + 1
                p, q = find(a), find(b)
                label[max(p, q)] = min(p, q)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min((x for x in (least.get(find(k)), i) if x is not None), default=None)
    return sorted(((i, len(s), least[find(k)], links[k]) for k, (i, s) in enumerate(sets)), key=str)


def corpus(seed, families=12, copies=8):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    rows, i = [], 0
    common = r.choices(words, k=40)
    for _ in range(families):
        base = r.choices(words, k=r.choice([6, 30, 80, 200])) + (common if r.random() < 0.5 else [])
        for _ in range(r.randint(1, copies)):
            text = list(base)
            for _ in range(r.randint(0, max(1, len(text) // 40))):
                text[r.randrange(len(text))] = r.choice(words)
            rows.append((i, " ".join(text)))
            i += 1
    r.shuffle(rows)
    return rows


def result(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_against_brute_force(docs):
    rows = corpus(1) + [(900, None), (901, ""), (902, " \n"), (903, "one two"), (904, "One  TWO"), (905, "one"), (906, "a b c d e"), (907, "a b c d e")]
    assert result(ngram_join(docs(rows))) == brute(rows)


def test_chains_and_large_blocks(docs, monkeypatch):
    """Variants far from each other, linked over others; blocks beyond a tile are dealt to several tasks."""
    monkeypatch.setattr(nj, "TILE", 8)
    r = random.Random(5)
    base = [f"b{k}" for k in range(120)]
    rows = []
    for i in range(60):
        text = list(base)
        for k in range(i % 12):
            text[(k * 10 + i // 12) % 120] = f"x{i}_{k}"
        rows.append((i, " ".join(text)))
    r.shuffle(rows)
    assert result(ngram_join(docs(rows))) == brute(rows)


def test_pivots_change_no_link(docs, monkeypatch):
    """The links come from the trees alone: without pivots every block is searched by itself, with the same result."""
    for seed in (3, 4):
        rows = corpus(seed)
        want = brute(rows)
        assert result(ngram_join(docs(rows))) == want
        with monkeypatch.context() as m:
            m.setattr(nj, "bounded", lambda pairs, table, percent: pairs.where("1 = 0"))
            m.setattr(nj, "TILE", 16)
            assert result(ngram_join(docs(rows))) == want


def test_no_tree_no_link(docs, monkeypatch):
    monkeypatch.setattr(nj.CountTree, "search", lambda *a: (np.zeros(0, np.int64), np.zeros(0, np.int64)))
    monkeypatch.setattr(nj, "ship", lambda spark: None)
    assert nj._candidates.__globals__["CountTree"] is nj.CountTree
    part = nj.pa.table({"n": [3, 3], "counts": [b"\x01" * 32] * 2})
    assert [len(v) for v in nj._candidates(part, np.array([0, 1]), np.array([0, 1]), 80)] == [0, 0]


def test_large_group_of_near_copies(docs):
    """All of thousands of links are counted, though no task sends them on; sets meet in matrices there."""
    r = random.Random(8)
    base = [f"b{k}" for k in range(150)]
    rows = []
    for i in range(300):
        text = list(base)
        for _ in range(r.randint(0, 3)):
            text[r.randrange(150)] = f"x{r.randrange(30)}"
        rows.append((i, " ".join(text)))
    want = brute(rows)
    assert sum(x[3] for x in want) > 10_000
    assert result(ngram_join(docs(rows))) == want


def test_overlaps_either_way():
    r = np.random.default_rng(1)
    sets = [np.unique(r.integers(0, 400, r.integers(1, 200)).astype(np.uint64)) for _ in range(60)]
    x, y = (v.ravel() for v in np.meshgrid(np.arange(60), np.arange(60)))
    want = [len(np.intersect1d(sets[a], sets[b])) for a, b in zip(x, y)]
    assert nj.exact_overlaps(sets, x, y).tolist() == want
    some = r.permutation(3600)[:200]
    assert nj.exact_overlaps(sets, x[some], y[some]).tolist() == [want[k] for k in some]


def test_null_ids_repeated_rows_and_clashing_columns(docs):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, None), (None, "q r s t u v"), (2, "long " * 60_000)]
    got = result(ngram_join(docs(rows, clashing=True)))
    assert got == sorted([(1, 2, 1, 2), (1, 2, 1, 2), (None, 2, 1, 2), (None, 0, None, 0), (None, 2, None, 0), (2, 1, 2, 0)], key=str)
    assert ngram_join(docs([])).count() == 0
    assert result(ngram_join(docs([(1, None)]))) == [(1, 0, 1, 0)]


def test_tree_against_all_pairs():
    """Every pair that the bound allows, from trees of several levels; most others are never looked at."""
    r = np.random.default_rng(0)
    base = r.poisson(3, (40, nj.GROUPS))
    counts = (base[r.integers(0, 40, 1500)] + r.integers(0, 2, (1500, nj.GROUPS))).astype(np.int32)
    sizes = counts.sum(axis=1).astype(np.int64)
    tree = CountTree(counts, sizes)
    assert len(tree.levels) >= 4 and sorted(tree.order) == list(range(1500))
    q, p = tree.search(counts, sizes, 80)
    overlap = np.minimum(counts[:, None], counts[None]).sum(axis=2)
    want = 180 * overlap >= 80 * (sizes[:, None] + sizes[None])
    assert set(zip(q.tolist(), p.tolist())) == set(zip(*map(list, np.nonzero(want))))
    for n in (0, 1, 8, 9):
        assert len(CountTree(counts[:n], sizes[:n]).search(counts[:n], sizes[:n], 80)[0]) == want[:n, :n].sum()


def test_components(spark):
    r = random.Random(2)
    links = [(r.randrange(200), r.randrange(200)) for _ in range(150)] + [(1000 + i, 1001 + i) for i in range(64)] + [(5, 5)]
    want = {x: x for e in links for x in e if e[0] != e[1]}
    for _ in range(200):
        for a, b in links:
            if a != b:
                want[a] = want[b] = min(want[a], want[b])
    got = {row.node: row.label for row in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
