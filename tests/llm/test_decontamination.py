from __future__ import annotations

import random

import pytest

from strata.llm.decontamination import ERRORS, MASKS, MIN_WORDS, WINDOW, complete, contamination, drop_contaminated

WORDS = [f"word{k}" for k in range(300)]


def brute(docs, items):
    found = set()
    for d, text in docs:
        t = (text or "").lower().split()
        for i, item in items:
            w = (item or "").lower().split()
            size, errors = (WINDOW, ERRORS) if len(w) >= WINDOW else (len(w), 0)
            if size >= MIN_WORDS and any(sum(x != y for x, y in zip(t[a : a + size], w[b : b + size])) <= errors for a in range(len(t) - size + 1) for b in range(len(w) - size + 1)):
                found.add((d, i))
    return found


def test_masks_miss_no_window():
    assert complete(MASKS, WINDOW, ERRORS)
    assert not complete(("1111111",), WINDOW, ERRORS)


def test_against_brute_force(spark, docs):
    r = random.Random(4)
    items = [(i, " ".join(r.choices(WORDS, k=r.choice([3, 5, 8, 13, 14, 30, 60])))) for i in range(25)] + [(90, None), (91, ""), (92, "word1 Word2"), (93, "word1 word2")]
    items += [(94, items[0][1].upper()), (None, items[1][1])] + [(k, items[2][1]) for k in range(95, 120)]
    rows = []
    for d in range(400):
        text = r.choices(WORDS, k=r.randint(0, 120))
        if d % 2:
            part = r.choice(items[:25])[1].split()
            a = r.randrange(len(part))
            part = part[a : a + r.choice([5, 13, 20, 60])]
            for _ in range(r.choice([0, 1, 2, 3, 6])):
                part[r.randrange(len(part))] = "changed"
            at = r.randint(0, len(text))
            text[at:at] = part
        rows.append((d, " ".join(text).replace("word7 ", "WORD7 ")))
    rows += [(900, None), (901, "")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    want = brute(rows, items)
    assert len(want) > 10
    for block_words in (10**6, 60):  # at once, and in many blocks
        got = contamination(docs(rows, clashing=True), benchmark, block_words=block_words).collect()
        assert {(x.doc_id, x.item_id) for x in got} == want and len(got) == len(want)
        assert all(x.covered <= x.words and x.start < x.stop for x in got)
        left = drop_contaminated(docs(rows, clashing=True), benchmark, block_words=block_words)
        assert {x.doc_id for x in left.collect()} == {d for d, _ in rows} - {d for d, _ in want}
        assert left.columns == docs(rows, clashing=True).columns


def test_edge_cases(spark, docs):
    benchmark = spark.createDataFrame([(1, " ".join(WORDS[:20]))], "item_id bigint, text string")
    text = " ".join(WORDS[:20])
    rows = [(None, text), (2, text), (2, text), (3, "x " * 100_000 + text)]
    got = contamination(docs(rows), benchmark).collect()
    assert sorted((r.doc_id or 0, r.item_id, r.matched, r.covered) for r in got) == [(0, 1, 13, 20), (2, 1, 13, 20), (2, 1, 13, 20), (3, 1, 13, 20)]
    assert [r.start for r in got if r.doc_id == 3] == [100_000]
    assert contamination(docs([]), benchmark).count() == 0
    empty = benchmark.where("1 = 0")
    assert contamination(docs(rows), empty).count() == 0 and drop_contaminated(docs(rows), empty).count() == 4
    with pytest.raises(ValueError):
        contamination(docs(rows), benchmark, masks=("1111111",))


def test_signs_between_words(spark, docs):
    """Whatever separates the words, the words are the same."""
    item = " ".join(WORDS[:20])
    signs = [", ", ". ", "-", "; (", "\n", ") ", "  "]
    text = "".join(w + signs[i % len(signs)] for i, w in enumerate(WORDS[:20]))
    benchmark = spark.createDataFrame([(1, item), (2, text.upper()), (3, "word1"), (4, "word1 word2 word3 word4")], "item_id bigint, text string")
    rows = [(1, text), (2, f"x {item.title()}!"), (3, "word1 word2 word3 word4")]
    assert {(r.doc_id, r.item_id) for r in contamination(docs(rows), benchmark).collect()} == {(1, 1), (1, 2), (2, 1), (2, 2)}
    assert [r.doc_id for r in drop_contaminated(docs(rows), benchmark).collect()] == [3]


def test_one_name_for_both_ids(spark, docs):
    benchmark = spark.createDataFrame([("a", " ".join(WORDS[:20]))], "doc_id string, text string")
    got = contamination(docs([(7, " ".join(WORDS[:20]))]), benchmark, item_column="doc_id")
    assert got.columns[:2] == ["doc_id", "item_doc_id"] and tuple(got.first())[:2] == (7, "a")


def test_many_items_of_one_opening(spark, docs):
    """Items that share a passage with a text are all reported; dropping stops at the first."""
    opening = " ".join(WORDS[:20])
    benchmark = spark.createDataFrame([(i, f"{opening} {' '.join(random.Random(i).choices(WORDS, k=15))}") for i in range(500)], "item_id bigint, text string")
    rows = [(d, f"{opening} text{d}") for d in range(8)] + [(100, "clean")]
    assert contamination(docs(rows), benchmark).count() == 8 * 500
    assert [r.doc_id for r in drop_contaminated(docs(rows), benchmark).collect()] == [100]
