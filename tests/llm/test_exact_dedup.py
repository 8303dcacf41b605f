from __future__ import annotations

import hashlib

from strata.llm.exact_dedup import exact_dedup, suspects


def test_groups(docs):
    rows = [(5, "a  b"), (3, "a\tb"), (9, "a b"), (4, "a c"), (7, None), (6, ""), (8, " "), (2, "x" * 70 + "1"), (1, "x" * 70 + "2"), (10, "long " * 100_000), (11, "long\n" * 100_000)]
    got = {r.doc_id: r for r in exact_dedup(docs(rows)).collect()}
    assert {k: (r.keep_id, r.group_size, r.kept) for k, r in got.items()} == {
        5: (3, 3, False), 3: (3, 3, True), 9: (3, 3, False), 4: (4, 1, True), 7: (6, 2, False), 6: (6, 2, True), 8: (8, 1, True),
        2: (2, 1, True), 1: (1, 1, True), 10: (10, 2, True), 11: (10, 2, False),
    }
    assert got[5].full_hash == hashlib.sha256(b"a b").hexdigest()


def test_full_hash_only_where_needed(docs):
    """Texts alone in their length or prefix are not hashed whole (but for chance hits of the bitmap)."""
    rows = docs([(1, "abc"), (2, "abd"), (3, "abcd"), (4, "same"), (5, "same")])
    assert suspects(rows)[1] == 1
    got = {r.doc_id: r.full_hash for r in exact_dedup(rows).collect()}
    assert got[1] is None and got[3] is None and got[4] == got[5] is not None


def test_repeated_rows_null_ids_and_clashing_columns(docs):
    rows = [(1, "t"), (1, "t"), (2, "t"), (None, "t"), (None, "alone"), (None, None), (None, None)]
    got = exact_dedup(docs(rows, clashing=True), carry=["node", "_x"]).collect()
    assert len(got) == 7 and all(r.node == "x" for r in got)
    t = [(r.keep_id, r.group_size, r.kept) for r in got if r.group_size == 4]
    assert sorted(t) == [(1, 4, False)] * 2 + [(1, 4, True)] * 2
    assert sorted(r.group_size for r in got if r.doc_id is None) == [1, 2, 2, 4]
    assert all(r.kept for r in got if r.doc_id is None and r.group_size < 4)
    assert exact_dedup(docs([])).count() == 0


def test_native(docs):
    plan = exact_dedup(docs([(1, "a"), (2, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))
