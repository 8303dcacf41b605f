"""Toxicity: noisy-channel deobfuscation, then a score of the restored text.

1. A language model is counted over all texts of the corpus: trigrams of letter
   bytes, and a sketch of all beginnings of words (``DEPTH`` letters at most),
   so that a known word costs what its frequency says, any other its trigrams.
2. Tokens that look disguised - a digit or symbol beside a letter, a letter
   three times in a row, single letters or signs set apart, an unknown word
   with letters of several alphabets, or with several accents, whose look-alikes are
   a known one -
   become a lattice: a character may stand for itself, for a letter it resembles,
   for nothing (a separator, a repetition), or end a word. Viterbi finds the best
   words under the language model and the channel's costs; they replace the
   token, unless its signs would become words that the corpus does not know
   (``mp3``, ``H2O`` and ``C++`` stay).
3. The restored text is scored by logistic regression over the words that occur
   in it and their beginnings, learnt with FTRL updates from a bounded sample of
   labelled rows, over the features that are commoner under label 1.
"""

from __future__ import annotations

import functools
import math
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import _BYTE_LOWER, Words, mix, ship, slices, stored, summed, text_buffer
from strata.llm.quality_classifier import Ftrl, labelled_sample, learn

MAX_ROWS = 16_000
SHARDS = 8
PARAMS = Ftrl(alpha=0.5, l1=0.5, l2=0.02, epochs=8)
PREFIXES = (4, 5, 6)  # bytes of a word's beginning that are features
LEAST_ROWS = 2  # rows of label 1 of a shard that a feature is in, to be learnt
LEAST_SHARE = 0.4  # of a shard's rows with a feature that have label 1

# The letters that a character may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "*": "aeiou", "#": "h",
}
# Letters of other alphabets that look like those of a to z.
LOOKS = {
    **dict(zip("авекмнорстухѕіјԁһ", "abekmhopctyxsijdh")),
    **dict(zip("αβεικνορτυχ", "abeiknoptux")),
    "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ß": "b",
}
SEPARATORS = " .-_*/,~"
COST_LEET, COST_SKIP, COST_REPEAT, COST_ODD, COST_SIGN, COST_LOOK = 1.0, 0.3, 0.5, 4.0, 6.0, 3.0
SHORTEST = 3  # letters of a word that signs are read as
ACCENTS = 2  # of a word that is read without them; a rare word has one
SKETCH = 1 << 19  # counters of the beginnings of words
DEPTH = 20  # letters of a beginning
PRIOR = 2.0  # weight of the trigrams against the counts of a beginning

# The language model's symbols: 0 for the edge of a word, a-z, and bytes of other letters.
_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[65:91] = np.arange(1, 27)
_SYMBOL[97:123] = np.arange(1, 27)
_SYMBOL[128:256] = 27 + np.arange(128) % 37
_LETTER = _SYMBOL > 0
_LEET = np.zeros(256, bool)
_LEET[[ord(c) for c in LEET]] = True
_APART = np.zeros(256, bool)
_APART[[ord(c) for c in SEPARATORS]] = True
_WORD = _LETTER.astype(np.uint8)
_WORD[48:58] = 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_UNIT = r"[^\W_]|[@$!|+(<*#]"
# Four or more letters (or signs that may be letters) set apart, two letters at least.
_GAP = r"(?:[ .\-_/,~]{1,3}+|\*)"
_RUN = re.compile(rf"(?<![^\W_])(?:{_UNIT})(?:{_GAP}(?:{_UNIT})){{3,}}(?![^\W_])")
_CHUNK = re.compile(r"[^\s,;:?]+")
# A sign before a letter or after one (where ! * ( < alone are punctuation), or a letter three times.
_DISGUISED = re.compile(r"[0-9@$!|+(<*#][^\W\d_]|[^\W\d_][!*(<]*[0-9@$|+#]|([^\W\d_])\1\1", re.IGNORECASE)
_SIGN = re.compile(r"[0-9@$!|+(<*#]")
_LETTERS = re.compile(r"[^\W\d_]")
_SPELT = re.compile(r"[^\W\d_]+")
_STRETCHED = re.compile(r"([^\W\d_])\1{4,}", re.IGNORECASE)
_PARTS = re.compile(r"([-_./~]+)")
_HIGH = re.compile(r"[^\x00-\x7f]")
_BLANK = re.compile("[\u00a0\u2000-\u200a\u202f\u3000]")  # as a space
_NOTHING = re.compile("[\u00ad\u200b-\u200d\u2060\ufeff]")  # no width
_AFTER = _LEET.copy()
_AFTER[[ord(c) for c in "!*(<"]] = False
_ASCII = _LETTER.copy()
_ASCII[128:] = False


def base(c: str) -> str:
    """A character without its marks and its form (wide, bold)."""
    plain = unicodedata.normalize("NFKD", c)
    return plain[0] if len(plain) == 1 or unicodedata.combining(plain[1]) else c


@functools.cache
def look_alike(c: str) -> str:
    """The letter of a to z that a character resembles, or ""."""
    if c < "\x80":
        return ""
    c = base(c.lower())
    return c if "a" <= c <= "z" else LOOKS.get(c, "")


def _edges(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where runs of letters, or of other bytes, and rows begin and end."""
    edge = np.zeros(len(data) + 1, bool)
    letter = _LETTER[data]
    edge[1:-1] = letter[1:] != letter[:-1]
    edge[offsets] = True
    return np.flatnonzero(edge)


def _count_trigrams(batch: pa.RecordBatch, total: np.ndarray) -> None:
    for b in slices(batch, "_text"):
        data, offsets = text_buffer(b.column("_text"))
        if not len(data):
            continue
        s = np.zeros(len(data) + 2 * b.num_rows + 2, np.int32)  # two edges before each row
        where = np.arange(len(data)) + np.repeat(2 * np.arange(1, b.num_rows + 1), np.diff(offsets))
        s[where] = _SYMBOL[data]
        a, m, z = s[:-2], s[1:-1], s[2:]
        a = a * (m != 0)  # nothing from beyond the edge
        used = (m != 0) | (z != 0)
        total += np.bincount((a * 4096 + m * 64 + z)[used], minlength=len(total))


def _count_words(batch: pa.RecordBatch, total: np.ndarray) -> None:
    """Adds all beginnings of words, a word with its end, and (last) the words."""
    for b in slices(batch, "_text"):
        data, offsets = text_buffer(b.column("_text"))
        edges = _edges(data, offsets)
        on = _LETTER[data[edges[:-1]]] if len(data) else np.zeros(0, bool)
        at, end = edges[:-1][on], edges[1:][on]
        total[-1] += len(at)
        h = np.zeros(len(at), np.uint64)
        found = []
        for _ in range(DEPTH):
            h = _longer(h, _SYMBOL[data[at]].astype(np.uint64))
            found.append(h)
            at = at + 1
            over = at == end
            found.append(_longer(h[over], np.uint64(0)))
            h, at, end = h[~over], at[~over], end[~over]
            if not len(at):
                break
        total[:-1] += np.bincount((np.concatenate(found) >> np.uint64(45)).astype(np.int64), minlength=SKETCH)


_STEP = 0x9E3779B97F4A7C13


def _longer(h, symbol):  # noqa: ANN001, ANN202
    """The hash of a beginning with one more symbol."""
    return (h + symbol + np.uint64(1)) * np.uint64(_STEP)


def language_models(docs: DataFrame, text_column: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Costs (negative logarithms) of a symbol after two others, and counts of
    beginnings of words (the last one: of all words), from all texts."""

    def count(batch: pa.RecordBatch, total: np.ndarray) -> None:
        _count_trigrams(batch, total[: 64**3])
        _count_words(batch, total[64**3 :])

    total = summed(docs.select(docs[text_column].alias("_text")), count, 64**3 + SKETCH + 1)
    counts = total[: 64**3].reshape(64, 64, 64).astype(float)
    two, one = counts.sum(axis=0), counts.sum(axis=(0, 1))
    p1 = (one + 1) / (one.sum() + 64)
    p2 = (two + 8 * p1) / (two.sum(axis=1, keepdims=True) + 8)
    p3 = (counts + 8 * p2) / (counts.sum(axis=2, keepdims=True) + 8)
    words = total[64**3 :].astype(np.float32)
    usual = np.median(words[:-1])  # what beginnings share a counter with
    words[:-1] = np.maximum(words[:-1] - usual - 6 * np.sqrt(usual), 0)
    return -np.log(p3).astype(np.float32), words


def language_model(docs: DataFrame, text_column: str = "text") -> np.ndarray:
    """Costs (negative logarithms) of a symbol after two others, from all texts."""
    return language_models(docs, text_column)[0]


def decode(token: str, costs: np.ndarray, words: np.ndarray | None = None) -> tuple[float, str]:
    """The likeliest letters behind ``token`` (Viterbi over its lattice), and their cost.

    What is no letter may also stay and end a word, so letters set apart become
    one word, several, or stay as they are, whichever is likeliest. Digits are
    never left out. ``words`` (``language_models``) tells the known beginnings
    apart; without it, or beyond them, trigrams decide.
    """
    chars = [c.lower() if len(c.lower()) == 1 else c for c in token]
    lead = next((i for i, c in enumerate(chars) if c >= "\x80" or _WORD[ord(c)]), len(chars))  # signs ahead of all letters may be brackets
    root = (0, float(words[-1])) if words is not None and words[-1] else None  # hash and count of a known beginning

    def add(state: tuple, z: int) -> tuple[float, tuple | None]:
        """The cost of symbol ``z`` in ``state``, and the beginning it makes if that is known."""
        x, y, start = state
        cost = float(costs[x, y, z])
        if start is None:
            return cost, None
        h = (start[0] + z + 1) * _STEP & 0xFFFFFFFFFFFFFFFF
        n = min(float(words[h >> 45]), start[1])
        return -math.log((n + PRIOR * math.exp(-cost)) / (start[1] + PRIOR)), (h, n) if n else None

    empty = (0, 0, root)
    states: dict[tuple, tuple[float, tuple]] = {empty: (0.0, ())}  # last two symbols, beginning -> cost, bytes (linked)
    last = None  # the character ahead of separators
    for i, c in enumerate(chars):
        own = c.encode("utf-8", "replace")
        arcs: list[tuple[bytes, float]] = []
        if c >= "\x80" or _LETTER[own[0]]:
            arcs.append((own, 0.0))
            if look := look_alike(c):
                arcs.append((look.encode(), COST_LOOK))
            skip = keep = None
        else:
            arcs += [(x.encode(), COST_LEET) for x in LEET.get(c, "")]
            skip = None if c.isdigit() else COST_SKIP if c in SEPARATORS else COST_SIGN if c in LEET else COST_ODD
            keep = 0.0 if c in SEPARATORS or c not in LEET or (i < lead and c in "!|(<") else COST_SIGN
            beside = chars[max(i - 2, 0) : i + 3]
            ornament = keep and any(beside[k : k + 3] == [c, c, c] for k in range(3))  # three or more of a sign
        before = last if i and chars[i - 1] in SEPARATORS and chars[i - 1] != c else chars[i - 1] if i else None
        again = {int(_SYMBOL[x[-1]]) for x, _ in arcs} if before == c else ()
        after: dict[tuple, tuple[float, tuple]] = {}
        for state, (cost, letters) in states.items():
            y = state[1]
            if keep is not None:
                stay = keep if not ornament else 0.0 if not y else COST_LEET if chars[i - 1] != c else keep
                new = cost + stay + (add(state, 0)[0] if y else 0.0)
                old = after.get(empty)
                if old is None or new < old[0]:
                    after[empty] = (new, (letters, own))
            leave = COST_REPEAT if y in again else skip
            if leave is not None and ((old := after.get(state)) is None or cost + leave < old[0]):
                after[state] = (cost + leave, letters)
            for letter, extra in arcs:
                to, new = state, cost + extra
                for b in letter:
                    z = int(_SYMBOL[b])
                    more, start = add(to, z)
                    to, new = (to[1], z, start), new + more
                old = after.get(to)
                if old is None or new < old[0]:
                    after[to] = (new, (letters, letter))
        states = after
        if c not in SEPARATORS:
            last = c
    best, letters = min(((cost + (add(state, 0)[0] if state[1] else 0.0), letters) for state, (cost, letters) in states.items()), key=lambda s: s[0])
    out = []
    while letters:
        letters, letter = letters
        out.append(letter)
    text = b"".join(reversed(out)).decode("utf-8", "ignore")
    return best, token if text == "".join(chars) else text


def restore(token: str, costs: np.ndarray, words: np.ndarray | None = None) -> str:
    """The likeliest letters behind ``token`` (``decode``)."""
    return decode(token, costs, words)[1]


def is_known(word: str, words: np.ndarray) -> bool:
    """Whether the corpus holds a word (of ``DEPTH`` letters; a longer one's beginning), and so all its beginnings."""
    data = _LOWER[np.frombuffer(word.lower().encode("utf-8", "replace"), np.uint8)]
    h = 0
    for z in [*_SYMBOL[data[:DEPTH]].tolist(), *[0] * (len(data) < DEPTH)]:
        h = (h + z + 1) * _STEP & 0xFFFFFFFFFFFFFFFF
        if not words[h >> 45] > 0:
            return False
    return True


def suspicious(data: np.ndarray, offsets: np.ndarray, known: np.ndarray | None = None) -> np.ndarray:
    """Rows that may hold a disguised token, by byte patterns; ``known`` are counts of ``language_models``."""
    n = len(offsets) - 1
    if len(data) < 3:
        return np.zeros(n, bool)
    letter, low, leet = _LETTER[data], _LOWER[data], _LEET[data]
    marks = np.zeros(len(data), bool)
    marks[:-1] = leet[:-1] & letter[1:]
    marks[:-1] |= (letter | leet)[:-1] & _AFTER[data[1:]]  # also behind other signs
    marks[:-2] |= letter[:-2] & (low[:-2] < 128) & (low[:-2] == low[1:-1]) & (low[:-2] == low[2:])
    sums = np.append(0, np.cumsum(marks))
    found = sums[offsets[1:]] > sums[offsets[:-1]]
    found |= _set_apart(data, offsets)
    if (data >= 128).any():
        found |= _foreign(data, offsets, known)
    return found


def _set_apart(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows with three letters or signs alone, neighbours but for separators."""
    apart = _APART[data]
    more = apart.copy()
    more[1:] &= apart[:-1]
    more[0] = False
    more &= data != ord("*")
    sums = np.append(0, np.cumsum(~more))
    data, offsets = data[~more], sums[offsets]  # a separator for each row of them
    marks = np.zeros(len(data), bool)
    unit = _LETTER[data] | _LEET[data]
    apart = np.zeros(len(data), bool)
    apart[:-1] = unit[:-1] & _APART[data[1:]]  # a letter or sign with a separator after it
    alone = apart.copy()
    alone[1:] &= ~(unit[:-1] & ~_APART[data[:-1]])
    if len(data) > 4:
        marks[:-4] = alone[:-4] & alone[2:-2] & unit[4:]
    sums = np.append(0, np.cumsum(marks))
    return sums[offsets[1:]] > sums[offsets[:-1]]


def _foreign(data: np.ndarray, offsets: np.ndarray, known: np.ndarray | None) -> np.ndarray:
    """Rows with blanks or letter forms beyond the alphabets, words of several of them, or unknown words with accents."""
    # blanks and letter forms: their leading bytes, then what follows
    first = np.flatnonzero((data == 0xC2) | (data == 0xE2) | (data == 0xE3) | (data == 0xEF) | (data == 0xF0))
    b0, b1, b2 = data[first], data[np.minimum(first + 1, len(data) - 1)], data[np.minimum(first + 2, len(data) - 1)]
    odd = (b0 == 0xC2) & ((b1 == 0xA0) | (b1 == 0xAD)) | (b0 == 0xE2) & (b1 == 0x80) & ((b2 < 0x8E) | (b2 == 0xAF)) | (b0 == 0xE2) & (b1 == 0x81) & (b2 == 0xA0)
    odd |= (b0 == 0xE3) & (b1 == 0x80) & (b2 == 0x80) | (b0 == 0xEF) & (b1 >= 0xBB) & (b1 <= 0xBD) | (b0 == 0xF0) & (b1 == 0x9D)
    found = np.zeros(len(offsets) - 1, bool)
    found[np.searchsorted(offsets, first[odd], "right") - 1] = True
    # leading bytes of two, of letters that resemble others, and the words around them
    lead = np.flatnonzero((data >= 0xC3) & (data <= 0xD4))
    edges = _edges(data, offsets)
    word, where = np.unique(np.searchsorted(edges, lead, "right"), return_inverse=True)
    accents = np.bincount(where, data[lead] <= 0xC9, len(word))
    others = np.bincount(where, data[lead] >= 0xCE, len(word))
    word = word[(others > 0) | (accents >= ACCENTS if known is not None else False)]
    if not len(word):
        return found
    begin, size = edges[word - 1], edges[word] - edges[word - 1]
    end = np.cumsum(size)
    start = end - size
    d = data[np.repeat(begin - start, size) + np.arange(end[-1])]
    d[1:][(d[:-1] == 0xC3) & (d[1:] < 0x9F) & (d[1:] != 0x97)] += 0x20  # small letters of Latin-1
    if known is None:
        sums = np.append(0, np.cumsum(_ASCII[d]))
        on = sums[end] > sums[start]
    else:
        lead = np.flatnonzero((d >= 0xC3) & (d <= 0xD4))
        look = _looks()[(d[lead].astype(np.int64) & 0x1F) << 6 | d[np.minimum(lead + 1, len(d) - 1)] & 0x3F]
        bare, keep = d.copy(), np.ones(len(d) + 1, bool)
        bare[lead[look > 0]] = look[look > 0]
        keep[lead[look > 0] + 1] = False
        place = np.append(0, np.cumsum(keep[:-1]))
        bare = bare[keep[:-1]]
        sums = np.append(0, np.cumsum(bare >= 128))
        on = (sums[place[end]] == sums[place[start]]) & ~_known(d, start, end, known)
        on[on] = _known(bare, place[start[on]], place[end[on]], known)
    found[np.searchsorted(offsets, begin[on], "right") - 1] = True
    return found


@functools.cache
def _looks() -> np.ndarray:
    """Look-alikes (bytes; 0 for none) of the code points of two bytes."""
    return np.array([ord(look_alike(chr(p)) or "\0") for p in range(0x800)], np.uint8)


def _known(data: np.ndarray, start: np.ndarray, end: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Which words, from ``start`` to ``end``, the corpus holds (``is_known``)."""
    out = np.zeros(len(start), bool)
    at, which, h = start, np.arange(len(start)), np.zeros(len(start), np.uint64)
    held = lambda h: counts[(h >> np.uint64(45)).astype(np.int64)] > 0
    for _ in range(DEPTH):
        if not len(at):
            return out
        h = _longer(h, _SYMBOL[data[at]].astype(np.uint64))
        at = at + 1
        on = held(h)
        h, at, end, which = h[on], at[on], end[on], which[on]
        over = at == end
        out[which[over]] = held(_longer(h[over], np.uint64(0)))
        h, at, end, which = h[~over], at[~over], end[~over], which[~over]
    out[which] = True
    return out


def restore_text(text: str, costs: np.ndarray, cache: dict[str, str], words: np.ndarray | None = None) -> str:
    """``text`` with its disguised tokens restored."""

    def known(token: str) -> str:
        if len(token) > 64:  # not worth a place in the cache
            return restore(_STRETCHED.sub(r"\1\1\1\1", token), costs, words)
        if token not in cache:
            if len(cache) > 50_000:
                cache.clear()
            cache[token] = restore(token, costs, words)
        return cache[token]

    def run(m: re.Match) -> str:
        token = m.group()
        letters = _LETTERS.findall(token.lower())
        if len(letters) < 2 or len(set(letters) | set(_SIGN.findall(token))) < 2:
            return token  # numbers; one letter again and again is no word
        out = known(token)
        plain = len(set(re.findall(r"[^\w]|_", token)) - set(LEET)) < 2 and not re.search(r"[/,~]|  ", token)
        return out if plain or sure(token, out) else token

    def sure(token: str, out: str) -> bool:
        """Whether all words that ``token`` has only as ``out`` are words of the corpus."""
        if words is None or not words[-1]:
            return True
        new = set(_SPELT.findall(out)) - set(_SPELT.findall(token.lower()))
        return all(len(w) >= SHORTEST and is_known(w, words) for w in new)

    def token_of(token: str) -> str:
        out = known(token)
        if out == token or not (_SIGN.search(token) or _HIGH.search(token)) or sure(token, out):
            return out
        parts = _PARTS.split(token)
        return "".join(token_of(p) for p in parts) if len(parts) > 1 else token

    def foreign(token: str) -> bool:
        """An unknown word whose look-alikes are a known one (without ``words``: one of several alphabets)."""
        for w in _SPELT.findall(token):
            bare = "".join(look_alike(c) or c for c in w)
            if bare == w or not bare.isascii():
                continue
            odd = [c for c in w if c >= "\x80"]
            if len(odd) < ACCENTS and odd[0] < "\u0250":
                continue
            if words is None or not words[-1]:
                found = re.search(r"[a-z]", w, re.IGNORECASE) and any(c > "\u02ff" for c in w)
            else:
                found = is_known(bare, words) and not is_known(w, words)
            if found:
                return True
        return False

    def chunk(m: re.Match) -> str:
        whole = m.group()
        found = _DISGUISED.search(whole)
        if not found:
            if whole.isascii():
                return whole
            key = "\n" + whole  # no token has one
            if key not in cache:
                cache[key] = token_of(whole) if foreign(whole) else whole
            return cache[key]
        start = whole.rfind(".", 0, found.start()) + 1
        token = whole[start:].rstrip(".!*")
        return whole[:start] + token_of(token) + whole[start + len(token) :]

    if not text.isascii():
        text = _NOTHING.sub("", _BLANK.sub(" ", text))
    return _CHUNK.sub(chunk, _RUN.sub(run, text))


def restored(batch: pa.RecordBatch, column: str, models: tuple[np.ndarray, np.ndarray], cache: dict[str, str]) -> pa.Array:
    texts = batch.column(column)
    rows = np.flatnonzero(suspicious(*text_buffer(texts), models[1] if models[1][-1] else None))
    if not len(rows):
        return texts
    values = texts.to_pylist()
    for i in rows.tolist():
        values[i] = restore_text(values[i], models[0], cache, models[1])
    return pa.array(values, texts.type)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit features of all rows (words and their beginnings) and each one's row."""
    data, offsets = text_buffer(texts)
    words = Words(data, offsets, kinds=_WORD)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(words.first))
    keys, rows = [words.hash], [row]
    size = words.end - words.start
    for k in PREFIXES:
        long = np.flatnonzero(size > k)
        start = words.start[long]
        h = np.full(len(long), k, np.uint64)
        for j in range(k):
            h = h * np.uint64(0x9E3779B97F4A7C13) + _BYTE_LOWER[data[start + j]]
        keys.append(mix(h))
        rows.append(row[long])
    return np.concatenate(keys), np.concatenate(rows)


def _sorted_features(batch: pa.RecordBatch, models: tuple[np.ndarray, np.ndarray], cache: dict[str, str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of a slice's restored texts, each once a row, by row, and each one's row."""
    keys, row = features(restored(batch, "_text", models, cache))
    order = np.lexsort((keys, row))
    keys, row = keys[order], row[order]
    new = np.append(True, (keys[1:] != keys[:-1]) | (row[1:] != row[:-1]))[: len(keys)]
    return keys[new], row[new]


def train(docs: DataFrame, sample: DataFrame, models: tuple[np.ndarray, np.ndarray], id_column: str, text_column: str, shards: int = SHARDS, params: Ftrl = PARAMS) -> tuple[np.ndarray, np.ndarray, float]:
    """Features with a weight (sorted), their weights, and the intercept.

    First each shard of the sample names the features that ``LEAST_ROWS`` of its
    rows with label 1 have, ``LEAST_SHARE`` of all its rows that have it; then
    one learner goes over the sample's rows, reduced to those features.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(docs[id_column].alias("_id"), docs[text_column].alias("_text")).join(F.broadcast(sample), "_id")
    rows = stored(rows.select("_text", "_y", F.xxhash64("_id", F.lit(11)).alias("_at"), F.pmod(F.xxhash64("_id", F.lit(10)), F.lit(shards)).alias("_shard")), "toxic-sample")
    model = spark.sparkContext.broadcast(models)

    def name(group: pa.Table) -> pa.Table:
        all_keys, toxic, cache = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], {}
        for whole in group.select(["_text", "_y"]).to_batches():
            for b in slices(whole, "_text"):
                keys, row = _sorted_features(b, model.value, cache)
                all_keys.append(keys)
                toxic.append(keys[b.column("_y").to_numpy()[row] == 1])
        known, times = np.unique(np.concatenate(toxic), return_counts=True)
        known, times = known[times >= LEAST_ROWS], times[times >= LEAST_ROWS]
        counts = np.sort(np.concatenate(all_keys))
        n = np.searchsorted(counts, known, "right") - np.searchsorted(counts, known, "left")
        return pa.table({"k": pa.array(known[times >= LEAST_SHARE * n].view(np.int64), pa.int64())})

    named = rows.groupBy("_shard").applyInArrow(name, "k bigint").distinct().collect()  # words of a bounded sample
    known = np.unique(np.array([r.k for r in named], np.int64).view(np.uint64))
    shared = spark.sparkContext.broadcast(known)

    def reduce_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, cache = shared.value, {}
        for whole in batches:
            for b in slices(whole, "_text"):
                keys, row = _sorted_features(b, model.value, cache)
                at = np.searchsorted(known, keys)
                on = known[np.minimum(at, max(len(known) - 1, 0))] == keys if len(known) else np.zeros(len(keys), bool)
                ends = np.append(0, np.cumsum(np.bincount(row[on], minlength=b.num_rows))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(at[on].astype(np.int32)))
                yield pa.RecordBatch.from_arrays([b.column("_y"), b.column("_at"), lists], names=["_y", "_at", "f"])

    def fit(group: pa.Table) -> pa.Table:
        group = group.sort_by([("_at", "ascending"), ("_y", "ascending")])
        index = [(np.append(np.array(f, np.int64), len(known)), 1.0) for f in group.column("f").to_pylist()]
        w = learn(index, group.column("_y").to_numpy(), len(known), params)
        return pa.table({"w": pa.array([w.tobytes()], pa.binary())})

    found = rows.select("_text", "_y", "_at").mapInArrow(reduce_, "_y int, _at bigint, f array<int>").withColumn("_one", F.lit(0)).groupBy("_one").applyInArrow(fit, "w binary").collect()
    w = np.frombuffer(found[0].w) if found else np.zeros(len(known) + 1)
    on = np.flatnonzero(w[:-1])
    return known[on], w[on], float(w[-1])


def toxicity(docs: DataFrame, labels: DataFrame, label_column: str = "toxic", id_column: str = "doc_id", text_column: str = "text", keep: list[str] | None = None, with_text: bool = False, max_rows: int = MAX_ROWS) -> DataFrame:
    """Train on ``labels`` (all rows given; hold out before) and score every row of ``docs``.

    Returns ``keep`` columns (all by default), ``score`` (probability of label
    1) and, ``with_text``, the ``restored`` text. Null or empty text gets the
    intercept's probability; repeated rows score alike; an empty table gives an
    empty result; without labels every score is 0.5. Columns of ``docs`` named
    like an output are replaced.
    """
    spark = docs.sparkSession
    models = language_models(docs, text_column)
    known, weights, intercept = train(docs, labelled_sample(labels, F.col(label_column), max_rows, id_column), models, id_column, text_column)
    outputs = ["score", *["restored"] * with_text]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in outputs]
    schema = docs.select(*[docs[c] for c in keep], F.lit(0.0).alias("score"), *[F.lit(None).cast("string").alias("restored")] * with_text).schema
    mask = np.zeros(1 << 16, bool)
    mask[(known >> np.uint64(48)).astype(np.int64)] = True
    model = spark.sparkContext.broadcast((models, known, weights, intercept, mask))  # fixed size, and words of a bounded sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, known, weights, intercept, mask = model.value
        cache: dict[str, str] = {}
        for whole in batches:
            scores, texts = [], []
            for b in slices(whole, "_text"):
                text = restored(b, "_text", models, cache)
                keys, row = features(text)
                may = np.flatnonzero(mask[(keys >> np.uint64(48)).astype(np.int64)])
                dot = np.full(b.num_rows, intercept)
                if len(may):
                    at = np.minimum(np.searchsorted(known, keys[may]), len(known) - 1)
                    hit = known[at] == keys[may]
                    once = np.unique(row[may][hit] * len(known) + at[hit])
                    dot += np.bincount(once // len(known), weights[once % len(known)], b.num_rows)
                scores.append(1 / (1 + np.exp(-np.clip(dot, -30, 30))))
                texts.append(text)
            if scores:
                extra = [pa.concat_arrays([t.cast(pa.string()) for t in texts])] * with_text
                yield pa.RecordBatch.from_arrays([*whole.columns[1:], pa.array(np.concatenate(scores)), *extra], names=[*keep, *outputs])

    return docs.select(docs[text_column].alias("_text"), *[docs[c].alias(f"_k{i}") for i, c in enumerate(keep)]).mapInArrow(run, schema)
