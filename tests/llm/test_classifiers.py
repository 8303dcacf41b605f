from __future__ import annotations

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from strata.llm.common import text_buffer
from strata.llm.quality_classifier import Ftrl, labelled_sample, learn, quality
from strata.llm.toxicity import LEET, decode, language_model, language_models, look_alike, restore, restore_text, suspicious, toxicity

WORDS = "river garden house stone window letter summer winter bridge market people water morning evening friend".split()


def make(n, seed):
    r = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        bad, toxic = i % 5 == 0, i % 7 == 0
        text = r.choices(WORDS, k=r.randint(8, 60))
        if bad:
            text = [w + "$$$" for w in text]
        if toxic:
            text.insert(r.randrange(len(text)), r.choice(["idiot", "moronic", "scumbag"]))
        rows.append((i, " ".join(text)))
        labels.append((i, 0 if bad else 1, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def data(spark, docs):
    rows, labels = make(600, 1)
    return docs(rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_ftrl_against_a_plain_loop():
    """The same updates, coordinate by coordinate."""
    rng, p, size = np.random.default_rng(3), Ftrl(alpha=0.3, l1=0.05, l2=0.1, epochs=2), 6
    rows = [(np.append(np.sort(rng.choice(size, 3, False)), size), np.append(rng.random(3), 1.0)) for _ in range(40)]
    labels = rng.integers(0, 2, 40)
    z, n = [0.0] * (size + 1), [0.0] * (size + 1)

    def weight(i):
        return 0.0 if abs(z[i]) <= p.l1 else -(z[i] - np.sign(z[i]) * p.l1) / ((p.beta + n[i] ** 0.5) / p.alpha + p.l2)

    for _ in range(p.epochs):
        for (index, x), y in zip(rows, labels):
            w = {i: weight(i) for i in index}
            g = 1 / (1 + np.exp(-sum(w[i] * v for i, v in zip(index, x)))) - y
            for i, v in zip(index, x):
                s = ((n[i] + (g * v) ** 2) ** 0.5 - n[i] ** 0.5) / p.alpha
                z[i] += g * v - s * w[i]
                n[i] += (g * v) ** 2
    assert np.allclose(learn(rows, labels, size, p), [weight(i) for i in range(size + 1)])


def test_quality_on_new_texts(spark, docs, data):
    rows, labels = make(100, 2)
    new = docs([(10_000 + i, t) for i, t in rows])
    train_docs, train_labels = data
    got = {r.doc_id: r.score for r in quality(train_docs.unionByName(new), train_labels).collect()}
    assert all((got[10_000 + i] >= 0.3) == bool(q) for i, q, _ in labels)


def test_sample_bound_and_conflicts(spark):
    rows = [(i, i % 2) for i in range(5000)] + [(1, 0), (None, 1), (7, None), (9, 1)]
    labels = spark.createDataFrame(rows, "doc_id bigint, quality int")
    all_ = labelled_sample(labels, labels.quality, 10**6)
    assert all_.count() == 4999 and all_.where("_id = 1").count() == 0
    assert 300 < labelled_sample(labels, labels.quality, 500).count() < 700


def test_quality_edge_cases(spark, docs, data):
    labels = data[1]
    rows = [(1, None), (2, ""), (3, " \n"), (4, "river $$$"), (4, "river $$$"), (None, "x"), (5, "river garden " * 30_000)]
    got = quality(docs(rows, clashing=True), labels).collect()
    assert len(got) == 7 and all(0 <= r.score <= 1 and r.node == "x" for r in got)
    by = {(r.doc_id, r.text): r.score for r in got}
    assert by[1, None] == by[2, ""] == by[3, " \n"]
    assert quality(docs([]), labels).count() == 0
    none = labels.where("1 = 0")
    assert [r.score for r in quality(docs([(1, "a b")]), none).collect()] == [0.5]
    assert [r.score for r in toxicity(docs([(1, "a b")]), none).collect()] == [0.5]


@pytest.fixture(scope="module")
def costs(spark, docs):
    return language_model(docs([(1, " ".join(WORDS * 20 + ["idiot", "stupid", "moron"] * 10)), (2, None), (3, "")]))


def test_language_model_counts_every_text(costs):
    p = np.exp(-costs)
    assert np.allclose(p.sum(axis=2), 1, atol=1e-3)
    r, i, v = (ord(c) - 96 for c in "riv")
    assert costs[0, 0, r] < 4 and costs[0, r, i] < 1 and costs[r, i, v] < 2


def test_deobfuscation(costs):
    assert restore("1d10t", costs) == "idiot"
    assert restore("$tup1d", costs) == "stupid"
    assert restore("i d i o t", costs) == "idiot"
    assert restore("i.d.i.o.t", costs) == "idiot"
    assert restore("mooooron", costs) == "moron"
    assert restore_text("you 1d10t, s-t-u-p-i-d river. Moooron!", costs, {}) == "you idiot, stupid river. moron!"
    for plain in ("the river is cold", "1995 was 20% more", "U.S. and a b c", "a a a a a", "good bookkeeper"):
        flagged = suspicious(*text_buffer(pa.array([plain])))[0]
        assert not flagged or restore_text(plain, costs, {}) == plain, plain


@pytest.fixture(scope="module")
def models(spark, docs):
    text = "you are such a loser and an idiot here i hate that hat shit y idiota you stupid moron as a house "
    return language_models(docs([(1, text * 20), (2, " ".join(WORDS * 20))]))


@pytest.mark.parametrize(
    "text, want",
    [
        ("such a l o s e r here", "such a loser here"),
        ("y o u i d i o t", "you idiot"),
        ("y i d i o t a", "y idiota"),
        ("y.o.u.i.d.i.o.t", "you.idiot"),
        ("i hat3 that", "i hate that"),
        ("sh1+", "shit"),
        ("l 0 s e r", "loser"),
        ("1 d 1 0 t", "idiot"),
        ("s.t.u.p.1.d", "stupid"),
        ("1 2 3 4 5", "1 2 3 4 5"),
        ("house$$$ river!", "house$$$ river!"),
        ("you i  d  i  o  t here", "you idiot here"),
        ("l/o/s/e/r", "loser"),
        ("l, o, s, e, r", "loser"),
        ("l~o~s~e~r", "loser"),
        ("l.o-s_e.r", "loser"),
        ("l\u00a0o\u00a0s\u00a0e\u00a0r", "loser"),
        ("an i\u200bd\u200bi\u200bo\u200bt", "an idiot"),
        ("an іdіоt here", "an idiot here"),
        ("an ídiöt here", "an idiot here"),
        ("an ｉｄｉｏｔ here", "an idiot here"),
        ("a, b, c, d", "a, b, c, d"),
        ("an mp3 of B2B, R2D2 and H2O in 3D for C++", "an mp3 of B2B, R2D2 and H2O in 3D for C++"),
        ("stup1d-mp3", "stupid-mp3"),
        ("по-русски über été ÜBEL ASÍ querró", "по-русски über été ÜBEL ASÍ querró"),
    ],
)
def test_word_breaks_and_signs_anywhere(models, text, want):
    flagged = suspicious(*text_buffer(pa.array([text])), models[1])[0]
    assert (restore_text(text, models[0], {}, models[1]) if flagged else text) == want


def cheapest(token, costs, words):
    """The cost of the best of all paths through a token's lattice, each added up on its own."""
    seps = set(" .-_*/,~")

    def options(i):
        c = token[i]
        out = [("keep", None)] if not (c.isalpha() or c in LEET) or c in seps else [("sign", None)] if not c.isalpha() else []
        if not c.isalpha() and not c.isdigit():
            out.append(("skip", 0.3 if c in seps else 6.0 if c in LEET else 4.0))
        out += [("letter", (c, 0.0))] if c.isalpha() else [("letter", (x, 1.0)) for x in LEET.get(c, "")]
        out += [("letter", (look_alike(c), 3.0))] if look_alike(c) else []
        k = i - 1
        if k >= 0 and token[k] in seps and token[k] != c:
            while k >= 0 and token[k] in seps:
                k -= 1
        return out + ([("again", None)] if k >= 0 and token[k] == c else [])

    first = next((i for i, c in enumerate(token) if c.isalnum()), len(token))
    best = np.inf
    for path in itertools.product(*map(options, range(len(token)))):
        total, word, done = 0.0, [], []

        def symbol(z):
            x, y = ([0, 0] + word)[-2:]
            tri = float(costs[x, y, z])
            counts = [words[-1]]
            for k in range(1, len(word) + 2):
                h = 0
                for v in [*word, z][:k]:
                    h = (h + v + 1) * 0x9E3779B97F4A7C13 % 2**64
                counts.append(min(counts[-1], float(words[h >> 45])))
            if counts[-2] == 0:
                return tri
            return -np.log((counts[-1] + 2 * np.exp(-tri)) / (counts[-2] + 2))

        for i, (kind, how) in enumerate(path):
            c = token[i]
            if kind in ("keep", "sign"):
                stay = 0.0 if kind == "keep" or (i < first and c in "!|(<") else 6.0
                if stay and any(token[k : k + 3] == c * 3 for k in range(max(i - 2, 0), i + 1)):
                    stay = 0.0 if not word else 1.0 if token[i - 1] != c else stay
                total += stay + (symbol(0) if word else 0.0)
                word = []
            elif kind == "skip":
                total += how
            elif kind == "again":
                same = {x for k, x in ((k, h[0]) for k, h in options(i) if k == "letter")}
                total += 0.5 if word and word[-1] in [s for x in same for s in symbols(x)[-1:]] else np.inf
            else:
                total += how[1]
                for z in symbols(how[0]):
                    total += symbol(z)
                    word = [*word, z]
            if total >= best:
                break
        else:
            best = min(best, total + (symbol(0) if word else 0.0))
    return best


def symbols(c):
    return [ord(c) - 96] if c < "\x80" else [27 + (b - 128) % 37 for b in c.encode()]


def test_decoding_is_the_best_of_all_paths(models):
    rnd = random.Random(5)
    tokens = ["1d10t", "i d i", "lo$er", "a$$$", "!d!", "h4t", "s.h-1", "ооt", "ídi", "oo0o", "mp3", "*a*", "$$$s", "o  o"]
    tokens += ["".join(rnd.choice("idot1!0$ .*-saé3") for _ in range(rnd.randint(1, 6))) for _ in range(150)]
    for token in tokens:
        cost, text = decode(token, *models)
        assert abs(cost - cheapest(token, *models)) < 1e-6, (token, text)


def test_long_tokens_are_decoded(models):
    for text, want in [
        (" ".join("youidiot" * 6), ("you idiot " * 6).strip()),
        ("idi" + "o" * 80 + "t", "idiot"),
        ("-".join(["1d10t", "l0ser", "stup1d"] * 6), "-".join(["idiot", "loser", "stupid"] * 6)),
    ]:
        assert len(text) > 64 and suspicious(*text_buffer(pa.array([text])))[0]
        assert restore_text(text, models[0], {}, models[1]) == want


def test_toxicity_finds_plain_and_disguised(docs, data):
    new = docs([(10_000, "river garden idiot house"), (10_001, "river garden 1d10t house"), (10_002, "river i d i o t house"), (10_003, "river garden house"), (10_004, None), (10_005, ""), (10_005, ""), (10_006, "house " * 50_000 + "idiooot")])
    frame = data[0].unionByName(new).selectExpr("*", "'x' as score", "'y' as restored", "'z' as node")
    got = [r for r in toxicity(frame, data[1], with_text=True, keep=["doc_id", "node", "score"]).collect() if r.doc_id >= 10_000]
    by = {r.doc_id: r for r in got}
    assert len(got) == 8 and {k for k, r in by.items() if r.score >= 0.5} == {10_000, 10_001, 10_002, 10_006}
    assert by[10_001].restored == "river garden idiot house" and by[10_000].node == "z"
    assert toxicity(docs([]), data[1]).count() == 0
