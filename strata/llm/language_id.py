"""Language ID of whole texts and of spans within them.

1. The script of a word (of its characters, by their names) narrows the
   candidates to languages that use it in the training texts.
2. A word's score for a language is the log-likelihood of its byte trigrams,
   its edges included, from counts over all training texts.
3. Viterbi over the words of a text, with a penalty for a switch, labels spans
   of one language. All texts of a slice take a step together.

The model is a table of ``2**BITS`` trigram buckets per language. The languages
themselves are gathered by the driver: labels, of which there are few.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ship, slices, summed, text_buffer

BITS = 16
SWITCH = 12.0
NARROW = 64  # rows times languages of a step below which rows go one by one
SMOOTHING = 0.5
LEAST_SHARE = 0.005  # of a language's words, for a script to be its own
UNKNOWN = "und"

# Names of scripts as they stand in the names of characters.
NAMED = (
    "LATIN", "GREEK", "CYRILLIC", "ARMENIAN", "HEBREW", "ARABIC", "SYRIAC", "THAANA", "NKO", "DEVANAGARI", "BENGALI", "GURMUKHI", "GUJARATI", "ORIYA",
    "TAMIL", "TELUGU", "KANNADA", "MALAYALAM", "SINHALA", "THAI", "LAO", "TIBETAN", "MYANMAR", "GEORGIAN", "HANGUL", "ETHIOPIC", "CHEROKEE", "KHMER",
    "MONGOLIAN", "YI", "BOPOMOFO", "HIRAGANA", "KATAKANA", "CJK", "TIFINAGH", "COPTIC", "VAI", "JAVANESE", "BALINESE",
)
# Scripts that are called otherwise, or used together.
CALLED = {"CJK": "han", "HIRAGANA": "kana", "KATAKANA": "kana"}
# A mark is part of a word and no letter; a letter of no script above is of "other".
SCRIPTS = ["none", "mark", "latin", "other", *sorted({CALLED.get(x, x.lower()) for x in NAMED} - {"latin"})]
MARK, LATIN = SCRIPTS.index("mark"), SCRIPTS.index("latin")


@functools.cache
def script_ranges() -> tuple[np.ndarray, np.ndarray]:
    """First code points of ranges, and the script of each, from the characters' names and categories."""
    number = {name: SCRIPTS.index(CALLED.get(name, name.lower())) for name in NAMED}

    def script(c: str) -> int:
        if not c.isalpha():
            return MARK if unicodedata.category(c)[0] == "M" else 0
        return next((number[w] for w in unicodedata.name(c, "").split() if w in number), SCRIPTS.index("other"))

    start, found, last = [], [], None
    for point in range(sys.maxunicode + 1):
        now = script(chr(point))
        if now != last:
            start.append(point)
            found.append(now)
            last = now
    return np.array(start), np.array(found)


_ASCII = np.zeros(256, bool)
_ASCII[[*range(65, 91), *range(97, 123)]] = True
_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32


class Text:
    """Words (runs of letters) of a slice: ``start``, ``stop``, ``first`` (by row), ``script``, and trigrams of their bytes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        n = len(data)
        letter = _ASCII[data]
        script = np.where(letter, LATIN, 0).astype(np.int8)
        lead = np.flatnonzero(data >= 0xC0)
        if len(lead):
            b = np.append(data, np.zeros(3, np.uint8)).astype(np.int64)
            size = np.where(b[lead] < 0xE0, 2, np.where(b[lead] < 0xF0, 3, 4))
            low = lambda k: b[lead + k] & 0x3F
            point = np.where(size == 2, (b[lead] & 0x1F) << 6 | low(1), np.where(size == 3, (b[lead] & 0x0F) << 12 | low(1) << 6 | low(2), (b[lead] & 0x07) << 18 | low(1) << 12 | low(2) << 6 | low(3)))
            start, scripts = script_ranges()
            found = scripts[np.searchsorted(start, point, "right") - 1]
            for k in range(4):
                at = lead[size > k] + k
                on = at < n
                script[at[on]] = found[size > k][on]
            letter = script > 0
        inside = np.zeros(n + 2, bool)
        inside[1:-1] = letter
        edge = np.zeros(n + 1, bool)  # a row begins here
        edge[offsets] = True
        first = letter & (~inside[:n] | edge[:n])
        last = letter & (~inside[2:] | edge[1:])
        self.start, self.stop = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.first = np.searchsorted(self.start, offsets)
        low = _LOWER[data]
        before, after = np.zeros(n, np.uint32), np.zeros(n, np.uint32)
        before[1:], after[:-1] = low[:-1], low[1:]
        before[first], after[last] = 0, 0
        at = np.flatnonzero(letter)
        key = (before[at] << np.uint32(16)) | (low[at] << np.uint32(8)) | after[at]
        self.trigrams = ((key * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.int64)
        self.begin = np.append(0, np.cumsum(self.stop - self.start))  # of each word's trigrams
        self.script = np.maximum.reduceat(script[at], self.begin[:-1]).astype(np.int64) if len(at) else np.zeros(0, np.int64)

    def rows(self) -> np.ndarray:
        """Row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


class Model:
    """Languages, trigram scores (bucket by language), and which languages use a script."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        n = len(languages)
        self.languages = languages
        grams = counts[: n << BITS].reshape(n, 1 << BITS).astype(float) + SMOOTHING
        self.scores = np.log(grams / grams.sum(axis=1, keepdims=True)).T.astype(np.float32).copy()
        scripts = counts[n << BITS :].reshape(n, len(SCRIPTS)).astype(float)
        self.uses = (scripts >= LEAST_SHARE * np.maximum(scripts.sum(axis=1, keepdims=True), 1)).T

    def word_scores(self, text: Text) -> np.ndarray:
        """Scores of each word, the best at 0; languages that do not use its script far below."""
        if not len(text.start):
            return np.zeros((0, len(self.languages)))
        s = np.add.reduceat(self.scores[text.trigrams], text.begin[:-1], axis=0).astype(float)
        uses = self.uses[text.script]
        known = uses.any(axis=1)
        s = np.where(uses, s, -np.inf)
        s[~known] = 0  # a script that no language uses says nothing
        s -= s.max(axis=1, keepdims=True)
        return np.maximum(s, -1000.0)

    def labels(self, text: Text, switch: float) -> np.ndarray:
        """Language of each word: Viterbi over the words of each row."""
        s, first = self.word_scores(text), text.first
        out = np.zeros(len(s), np.int64)
        sizes = np.diff(first)
        order = np.argsort(-sizes, kind="stable")
        begin, sizes = first[:-1][order], sizes[order]
        longest = int(sizes[0]) if len(sizes) else 0
        active = np.searchsorted(-sizes, -np.arange(longest), "left")  # rows with more than t words
        own = np.arange(s.shape[1])
        back = np.zeros(s.shape, np.uint8 if s.shape[1] < 256 else np.uint16)
        value = np.zeros((len(sizes), s.shape[1]))
        # steps of few rows cost as much as steps of many: the last words of long texts go one by one
        wide = int(np.searchsorted(-active, -NARROW // max(s.shape[1], 1), "right")) if longest else 0
        wide = min(max(wide, 1), longest)
        for t in range(wide):
            k = active[t]
            at = begin[:k] + t
            v = value[:k]
            if t:
                best = v.argmax(axis=1)
                change = v[np.arange(k), best][:, None] - switch
                stay = v >= change
                back[at] = np.where(stay, own, best[:, None])
                v = np.maximum(v, change)
            value[:k] = v + s[at]
        now = np.zeros(len(sizes), np.int64)
        left = int(active[wide]) if wide < longest else 0  # rows that go on
        for r in range(left):
            rest = slice(begin[r] + wide, begin[r] + sizes[r])
            path, before = _one_by_one(value[r].tolist(), s[rest].tolist(), switch)
            out[rest], now[r] = path, before
        for t in range(wide - 1, -1, -1):
            k = active[t]
            ends = active[t + 1] if t + 1 < wide else left
            now[ends:k] = value[ends:k].argmax(axis=1)
            at = begin[:k] + t
            out[at] = now[:k]
            now[:k] = back[at, now[:k]]
        return out


def _one_by_one(value: list[float], scores: list[list[float]], switch: float) -> tuple[list[int], int]:
    """The best path of a text's last words, and the label of the word before, from the values there."""
    back = []
    for s in scores:
        top = max(value)
        best, change = value.index(top), top - switch
        back.append([j if v >= change else best for j, v in enumerate(value)])
        value = [(v if v >= change else change) + x for v, x in zip(value, s)]
    now = value.index(max(value))
    path = []
    for row in reversed(back):
        path.append(now)
        now = row[now]
    return path[::-1], now


def train(docs: DataFrame, language_column: str = "lang", text_column: str = "text") -> Model:
    """Count the trigrams and scripts of every language over all rows with one."""
    docs = docs.select(docs[text_column].alias("_text"), docs[language_column].cast("string").alias("_lang")).where("_lang is not null and _text is not null")
    languages = sorted(r[0] for r in docs.select("_lang").distinct().collect())
    number = {x: i for i, x in enumerate(languages)}
    n = len(languages)

    def count(batch: pa.RecordBatch, total: np.ndarray) -> None:
        for b in slices(batch, "_text"):
            text = Text(*text_buffer(b.column("_text")))
            lang = np.array([number[x] for x in b.column("_lang").to_pylist()], np.int64)[text.rows()]
            total[: n << BITS] += np.bincount(np.repeat(lang << BITS, text.stop - text.start) + text.trigrams, minlength=n << BITS)
            total[n << BITS :] += np.bincount(lang * len(SCRIPTS) + text.script, minlength=n * len(SCRIPTS))

    if not languages:
        return Model([UNKNOWN], np.zeros((1 << BITS) + len(SCRIPTS), np.int64))
    return Model(languages, summed(docs, count, (n << BITS) + n * len(SCRIPTS)))


def language_id(docs: DataFrame, model: Model, text_column: str = "text", keep: list[str] | None = None, with_spans: bool = False, switch: float = SWITCH) -> DataFrame:
    """``keep`` columns of ``docs`` (all by default) plus ``lang_pred``, ``score`` and, ``with_spans``, ``spans``.

    ``lang_pred`` is the language whose spans hold most of the text's letters
    (ties: the first in alphabetical order) and ``score`` its share of them; a
    text that is null or has no letters gets ``und`` and 0. ``spans`` are
    (start, stop, lang) in code points, from a span's first word to its last.
    Repeated rows are labelled alike, columns of ``docs`` named like an output
    are replaced, and an empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    outputs = ["lang_pred", "score", *["spans"] * with_spans]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in outputs]
    span = "array<struct<start:bigint,stop:bigint,lang:string>>"
    schema = docs.select(*[docs[c] for c in keep], F.lit(UNKNOWN).cast("string").alias("lang_pred"), F.lit(0.0).alias("score"), *[F.lit(None).cast(span).alias("spans")] * with_spans).schema
    shared = spark.sparkContext.broadcast(model)  # a table of fixed size for each language

    def spans(data: np.ndarray, offsets: np.ndarray, text: Text, labels: np.ndarray, row: np.ndarray, names: list[str]) -> list[list[dict]]:
        point = np.append(0, np.cumsum((data & 0xC0) != 0x80))
        new = np.flatnonzero(np.append(True, (labels[1:] != labels[:-1]) | (row[1:] != row[:-1]))[: len(labels)])
        ends = np.append(new[1:], len(labels)) - 1
        out: list[list[dict]] = [[] for _ in range(len(offsets) - 1)]
        for a, z in zip(new.tolist(), ends[: len(new)].tolist()):
            base = point[offsets[row[a]]]
            out[row[a]].append({"start": int(point[text.start[a]] - base), "stop": int(point[text.stop[z]] - base), "lang": names[labels[a]]})
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = np.array([*m.languages, UNKNOWN], object)
        n = len(m.languages)
        for whole in batches:
            parts: list[list] = [[], [], []]
            for b in slices(whole, "_text", 4 << 20):
                data, offsets = text_buffer(b.column("_text"))
                text = Text(data, offsets)
                labels, row = m.labels(text, switch), text.rows()
                known = m.uses[text.script].any(axis=1) if len(row) else np.zeros(0, bool)
                size = np.where(text.script == MARK, 0, text.stop - text.start)  # marks alone are no letters
                letters = np.where(known, size, 0)
                share = np.bincount(row * n + labels, letters, b.num_rows * n).reshape(-1, n)
                total = share.sum(axis=1)
                # words of scripts that no language uses count only where a text has no others
                share[total == 0] = np.bincount(row * n + labels, size, b.num_rows * n).reshape(-1, n)[total == 0]
                total = share.sum(axis=1)
                best = np.where(total > 0, share.argmax(axis=1), n)
                parts[0] += names[best].tolist()
                parts[1] += (share.max(axis=1) / np.maximum(total, 1)).tolist()
                if with_spans:
                    parts[2] += spans(data, offsets, text, labels, row, names.tolist())
            extra = [pa.array(p, t) for p, t in zip(parts, (pa.string(), pa.float64(), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("lang", pa.string())]))))]
            yield pa.RecordBatch.from_arrays([*whole.columns[1:], *extra[: len(outputs)]], names=[*keep, *outputs])

    return docs.select(docs[text_column].alias("_text"), *[docs[c].alias(f"_k{i}") for i, c in enumerate(keep)]).mapInArrow(run, schema)
