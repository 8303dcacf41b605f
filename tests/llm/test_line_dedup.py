from __future__ import annotations

import random

from strata.llm.line_dedup import line_dedup


def brute(rows):
    first, where = {}, {}
    for d, text in sorted(set(rows)):
        lines = (text or "").split("\n")
        for k in range(len(lines) - 2):
            w = tuple(lines[k : k + 3])
            first.setdefault(w, (d, k))
            where.setdefault(d, []).append((w, k))
    out = {}
    for d, text in rows:
        lines = (text or "").split("\n")
        gone = {k + j for w, k in where.get(d, []) if first[w] != (d, k) for j in range(3)}
        out[d] = (len(lines), sorted(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone))
    return out


def result(df):
    return {r.doc_id: (r.n_lines, r.removed, r.text) for r in df.collect()}


def test_against_brute_force(docs):
    r = random.Random(3)
    rows = [(d, "\n".join(r.choices("abcde", k=r.randint(0, 14)))) for d in range(80)]
    rows += [(100, None), (101, ""), (102, "a\na\na\na\na"), (103, "x\r\ny\nz"), (104, "\n".join(f"l{k}" for k in range(20_000)))]
    assert result(line_dedup(docs(rows))) == brute(rows)


def test_merges_overlapping_windows(docs):
    rows = [(2, "0\na\nb\nc\nd\n1"), (1, "a\nb\nc\nd")]
    assert result(line_dedup(docs(rows))) == {1: (4, [], "a\nb\nc\nd"), 2: (6, [1, 2, 3, 4], "0\n1")}


def test_edge_cases(docs):
    rows = [(1, "a\nb\nc"), (1, "a\nb\nc"), (None, "a\nb\nc"), (None, None), (1, "q\na\nb\nc")]
    got = sorted(((r.doc_id or 0, r.n_lines, r.removed, r.text, r.node) for r in line_dedup(docs(rows, clashing=True)).collect()), key=str)
    assert got == sorted([(0, 3, [], "a\nb\nc", "x"), (0, 1, [], "", "x"), (1, 3, [0, 1, 2], "", "x"), (1, 3, [0, 1, 2], "", "x"), (1, 4, [1, 2, 3], "q", "x")], key=str)
    assert line_dedup(docs([])).count() == 0
