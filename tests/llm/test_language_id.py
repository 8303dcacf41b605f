from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm.common import text_buffer
from strata.llm.language_id import SCRIPTS, Model, Text, language_id, train

EN = "the house and the garden with the river that runs through this old town "
DE = "das haus und der garten mit dem fluss der durch diese alte stadt fließt "
RU = "дом и сад у реки которая течёт через этот старый город "


@pytest.fixture(scope="module")
def model(spark):
    rows = [(EN * 5, "en"), (DE * 5, "de"), (RU * 5, "ru"), (None, "en"), ("text without a label", None), ("", "de")]
    return train(spark.createDataFrame(rows, "text string, lang string"))


def test_scripts_and_words():
    t = Text(*text_buffer(pa.array(["Ab1é дом", "", "漢字 x", "123 !"])))
    assert t.first.tolist() == [0, 3, 3, 5, 5]
    assert [SCRIPTS[s] for s in t.script] == ["latin", "latin", "cyrillic", "han", "latin"]


def test_labels_spans_and_scripts(docs, model):
    assert model.languages == ["de", "en", "ru"]
    got = {r.doc_id: r for r in language_id(docs([(1, EN), (2, DE), (3, RU), (4, EN * 2 + RU), (5, EN * 3 + DE * 2)]), model, with_spans=True).collect()}
    assert {k: r.lang_pred for k, r in got.items()} == {1: "en", 2: "de", 3: "ru", 4: "en", 5: "en"}
    assert got[1].score == 1.0 and 0.5 < got[4].score < 1
    assert [s.lang for s in got[4].spans] == ["en", "ru"] and [s.lang for s in got[5].spans] == ["en", "de"]
    text = EN * 2 + RU
    assert text[got[4].spans[1].start : got[4].spans[1].stop] == RU.strip()


def test_edge_cases(docs, model):
    rows = [(1, None), (2, ""), (3, "12 !? 3"), (4, EN), (4, EN), (None, DE), (5, EN * 5000)]
    got = language_id(docs(rows, clashing=True), model).collect()
    assert len(got) == 7 and set(got[0].asDict()) == {*docs([], True).columns, "score"}
    by = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert by[1] == by[2] == by[3] == ("und", 0.0) and by[4] == by[5] == ("en", 1.0) and by[None][0] == "de"
    assert language_id(docs([]), model).count() == 0
    assert language_id(docs([(1, "日本")]), model).first().lang_pred in model.languages  # no language uses the script


def test_no_labels(spark, docs):
    empty = train(spark.createDataFrame([], "text string, lang string"))
    assert language_id(docs([(1, EN)]), empty).first().lang_pred == "und"


def test_viterbi_is_the_best_path(model):
    """Against every labelling of a short text."""
    text = Text(*text_buffer(pa.array(["the haus und дом river", "garden", ""])))
    got, scores, switch = model.labels(text, 3.0), model.word_scores(text), 3.0
    for a, b in zip(text.first[:-1], text.first[1:]):
        paths = itertools.product(range(3), repeat=b - a)
        best = max(paths, key=lambda p: sum(scores[a + i, x] for i, x in enumerate(p)) - switch * sum(x != y for x, y in zip(p, p[1:])))
        assert got[a:b].tolist() == list(best)


def test_narrowing():
    counts = np.zeros(2 * (1 << 16) + 2 * len(SCRIPTS), np.int64)
    counts[2 << 16 :][SCRIPTS.index("latin")] = 100
    counts[2 << 16 :][len(SCRIPTS) + SCRIPTS.index("greek")] = 100
    m = Model(["a", "b"], counts)
    t = Text(*text_buffer(pa.array(["abc αβγ"])))
    assert m.labels(t, 1.0).tolist() == [0, 1]


def test_held_out_accuracy(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang is not null")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    found = language_id(rows.where(held), train(rows.where(~held)))
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.93


def test_every_letter_counts(docs, model):
    """Only texts that are null or hold no letter are undetermined, whatever the script."""
    texts = ["ଓଡ଼ିଆ", "ދިވެހި", "ＡＢＣ ｄｅｆ", "ꆈꌠ", "ᠮᠣᠩᠭᠣᠯ", "ㄅㄆㄇ", "ﷺ ﻻ", "ª º", "µ", "ℕ", "𝒜", "ǅ", "ʰ", "\u0301", "\u0301 12", "1234 ?", "🙂", "Ⅷ", "हिन्दी", "ไทย", "ꙮ"]
    for i, r in enumerate(language_id(docs(list(enumerate(texts))), model).orderBy("doc_id").collect()):
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in texts[i])), texts[i]
        assert 0 <= r.score <= 1 and (r.score > 0) == (r.lang_pred != "und")


def test_long_rows_alone_and_together(model):
    """The words that go one by one get the labels of the steps that go together."""
    import time

    from strata.llm import language_id as L

    texts = [EN * k + DE * (k % 3) + RU * (k % 2) + "x" * (k % 5) for k in range(1, 120, 7)]
    text = Text(*text_buffer(pa.array(texts)))
    got = model.labels(text, 12.0)
    old = L.NARROW
    try:
        L.NARROW = 0  # all steps together
        assert (model.labels(text, 12.0) == got).all()
    finally:
        L.NARROW = old
    long = Text(*text_buffer(pa.array([(EN + DE) * 70_000])))  # 10 MB
    began = time.time()
    assert len(model.labels(long, 12.0)) == len(long.start) > 1_900_000
    assert time.time() - began < 60
