from __future__ import annotations

import math
import re
from collections import Counter

import pytest

from strata.llm.lexical_search import lexical_search, length_factor

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(docs, items, k):
    """Every item against every document, by the formulas."""
    rows = [(i, Counter(TERM.findall(t.translate(LOWER)))) for i, t in docs if t is not None]
    rows = [(i, c, sum(c.values())) for i, c in rows if c]
    n_docs, total = len(rows), sum(n for *_, n in rows)
    df = Counter(t for _, c, _ in rows for t in c)
    terms = {}
    for item, text in items:
        if item is not None and text is not None:
            terms.setdefault(item, set()).update(TERM.findall(text.translate(LOWER)))
    out = []
    for item, own in sorted(terms.items()):
        scored = []
        for i, c, n in rows:
            m = 50 + 50 * n * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in own if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, rank, r[3], -r[0]) for rank, r in enumerate(sorted(scored)[:k], 1)]
    return out


def found(df, item="item_id", doc="doc_id"):
    return sorted(((r[item], r["rank"], r[doc], r["score"]) for r in df.collect()), key=lambda r: r[:2])


def corpus(n):
    """Texts of words of very different frequencies, joined by signs that separate."""
    out = []
    for i in range(n):
        words = [f"w{(i * i * k + 7 * k) % (3 + k * k * 5)}" for k in range(1, 3 + i % 23)]
        out.append((i, "the " + ", ".join(words) + " THE end." if i % 3 else "the -" + "_".join(words)))
    return out


@pytest.mark.parametrize("options", [{}, {"shard_docs": 7, "owners": (0.02, 0.3)}, {"shard_postings": 40, "block_terms": 30}, {"owners": ()}])
def test_like_brute_force(spark, docs, options):
    rows = corpus(300)
    items = [(k, " ".join(t for _, t in rows[k * 9 : k * 9 + 2])) for k in range(25)]
    got = found(lexical_search(docs(rows), spark.createDataFrame(items, "item_id long, text string"), k=6, **options))
    assert got == brute(rows, items, 6)


def test_odd_rows(spark, docs):
    """Nulls, empty texts, ties, repeated rows and ids, a long text, other alphabets, clashing columns."""
    rows = [
        (1, "same words here"), (2, "same words here"), (2, "same words here"), (None, "same words here"), (3, None), (4, ""), (5, " .,- "),
        (6, "word " * 50_000 + "rare"), (7, "ÄRGER straße 日本 日本"), (8, "x" * 300_000), (None, "rare"),
    ]
    items = [(1, "Same HERE"), (1, "rare"), (2, None), (3, ""), (4, "absent"), (None, "same"), (5, "日本 Ärger ÄRGER"), (6, "x" * 300_000)]
    frame = spark.createDataFrame([(*i, "x", 1) for i in items], "item_id long, text string, score string, rank int")
    for clashing in (False, True):
        assert found(lexical_search(docs(rows, clashing), frame, k=4)) == brute(rows, items, 4)


def test_empty_tables(spark, docs):
    one = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    for d, i in ((docs([]), one), (docs([(1, "a b")]), one.limit(0)), (docs([(1, None)]), one)):
        got = lexical_search(d, i)
        assert got.columns == ["item_id", "rank", "doc_id", "score"] and got.count() == 0


def test_large_products():
    import numpy as np

    assert length_factor(np.array([10**9], np.int64), 10**12, 10**15).tolist() == [50 + 50 * 10**9 * 10**12 // 10**15]
