from __future__ import annotations

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm.sentencepiece_codec import Codec, encode_decode

P = pytest.importorskip("public_tokenizers")
MODEL = P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def codec():
    with open(MODEL, "rb") as f:
        return Codec(f.read(), cache_chunks=50)


def check(codec, texts):
    ids, decoded = codec.batch(texts)
    want = codec.sp.encode([t or "" for t in texts], add_eos=True)
    assert [np.frombuffer(x, "<i4").tolist() for x in ids] == want
    assert decoded == codec.sp.decode(want)


def test_odd_texts(codec):
    check(codec, [None, "", " ", "  ", "a", " a", "a ", "a  b", "\n", "a\nb", "▁", "a▁b", " ▁ b", "</s><s><unk>", "<0x0A>", "é🙂日本\x00", "x" * 3000, " " * 500, "aé" * 400])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n\tthe▁aéß<>/s0日🙂\x00INGing."), max_size=80), min_size=1, max_size=5))
def test_like_the_library(codec, texts):
    check(codec, texts)


def test_no_texts(codec):
    ids, decoded = codec.batch([])
    assert list(ids) == [] and list(decoded) == []


def test_agenda_alone_is_right(codec):
    """Without the library's check: both forms of the agenda on words of many lengths."""
    words = ["the", "unbelievable", "Donaudampfschifffahrt", "ciónmente", "日本語", "a" * 47, "re" * 30]
    flat, counts = codec._agendas([" " + w for w in words[:6]], 48)
    ends = np.cumsum(counts)
    for i, w in enumerate(words[:6]):
        assert flat[ends[i] - counts[i] : ends[i]].tolist() == codec.sp.encode(w)
    for w in words:
        assert codec.agenda(" " + w).tolist() == codec.sp.encode(w)


def test_operator(docs):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = [(1, "The quick brown fox"), (1, "The quick brown fox"), (2, None), (None, ""), (3, "word " * 30_000)]
    got = encode_decode(docs(rows, clashing=True)).collect()
    assert len(got) == 5
    for r in got:
        text = {1: rows[0][1], 3: rows[4][1]}.get(r.doc_id, "")
        assert r.ids == sp.encode(text, add_eos=True) and r.decoded == text and r.node == "x"
    assert encode_decode(docs([])).count() == 0


def test_long_chunks_leave_the_cache(codec):
    """Text without spaces is one chunk; the cache is bounded by what it holds, not by how many."""
    for k in range(6):
        check(codec, ["ab%d" % k * 100_000, "日本語%d" % k * 1000])
        assert sum(map(len, codec.cache)) <= 4_000_000 + 2 * 1_000_000
    assert sum(map(len, codec.before)) <= 4_000_000 + 2 * 1_000_000
    check(codec, ["x" * 1_000_000])
