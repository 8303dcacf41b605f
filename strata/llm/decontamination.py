"""Benchmark decontamination with spaced seeds.

Fixed masks pick some of the words of a short stretch and ignore the others, so
a hash survives substitutions at the positions ignored. Every mask's hash at
every position of the benchmark's items is joined with those of the training
texts. A hit fixes an alignment of an item and a text; around it the words are
compared one by one, and a window of ``WINDOW`` words of which all but
``ERRORS`` agree is contamination. The masks find every such window (checked
for the parameters given). Items of fewer words are matched whole, and those of
fewer than ``MIN_WORDS`` words, which name no passage, match nothing.

Words are runs of letters and digits; A-Z and a-z are alike, other characters
separate. The benchmark is cut into blocks of about ``BLOCK_WORDS`` words by a
hash of their different texts; a block is broadcast and the texts are scanned
once for each, so texts are never shuffled and a benchmark of any size
is matched whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Words, mix, ship, slices, stored, text_buffer

MASKS = ("1111101", "1011000111")
WINDOW = 13
ERRORS = 2
BLOCK_WORDS = 1_000_000
MIN_WORDS = 5
MATCH = "words bigint, matched bigint, covered bigint, start bigint, stop bigint"

_KINDS = np.zeros(256, np.uint8)
_KINDS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_ODD = np.random.default_rng(4).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def complete(masks: tuple[str, ...], window: int, errors: int) -> bool:
    """Whether some mask fits between any ``errors`` substitutions of a window."""
    places = [{o + i for i, c in enumerate(m) if c == "1"} for m in masks for o in range(window - len(m) + 1)]
    return all(any(not p & set(e) for p in places) for e in combinations(range(window), errors))


def seeds(hashes: np.ndarray, mask: str) -> np.ndarray:
    """The hash of ``mask`` at each position of a sequence of word hashes."""
    n = max(len(hashes) - len(mask) + 1, 0)
    out = np.full(n, np.uint64(len(mask)), np.uint64)
    for i, c in enumerate(mask):
        if c == "1":
            out += hashes[i : i + n] * _ODD[i % 256]
            if i % 256 == 255:
                out = mix(out)
    return mix(out)


class Block:
    """Items of a block, and their seeds: sorted hashes, each with (item, position) entries."""

    def __init__(self, ids: list, texts: list[str | None], masks: tuple[str, ...], window: int):
        texts = pa.array(texts, pa.string())
        words = Words(*text_buffer(texts), kinds=_KINDS)
        same: dict[bytes, int] = {}  # items of equal words are one
        self.ids: list[list] = []
        self.words: list[np.ndarray] = []
        for i, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist())):
            w = words.hash[a:b]
            if b - a >= MIN_WORDS:
                k = same.setdefault(w.tobytes(), len(self.words))
                if k == len(self.words):
                    self.words.append(w)
                    self.ids.append([])
                self.ids[k].append(ids[i])
        short = sorted({len(w) for w in self.words if len(w) < window})
        self.masks = [*masks, *("1" * n for n in short)]
        keys, item, place, which = [], [], [], []
        for k, w in enumerate(self.words):
            for m in masks if len(w) >= window else ["1" * len(w)]:
                h = seeds(w, m)
                keys.append(h)
                item.append(np.full(len(h), k))
                place.append(np.arange(len(h)))
                which.append(np.full(len(h), self.masks.index(m)))
        cat = lambda x, t: np.concatenate([np.zeros(0, t), *x]).astype(t)
        keys = cat(keys, np.uint64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.item, self.place, self.which = keys[order], cat(item, np.int64)[order], cat(place, np.int64)[order], cat(which, np.int64)[order]
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(self.keys >> np.uint64(44)).astype(np.int64)] = True

    def hits(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position in the sequence, item, position in the item) of all equal seeds."""
        at, item, place = [], [], []
        for k, m in enumerate(self.masks):
            h = seeds(hashes, m)
            may = np.flatnonzero(self.filter[(h >> np.uint64(44)).astype(np.int64)])
            low, high = np.searchsorted(self.keys, h[may], "left"), np.searchsorted(self.keys, h[may], "right")
            n = high - low
            entry = np.repeat(low - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum()) if len(n) else np.zeros(0, np.int64)
            on = self.which[entry] == k
            at.append(np.repeat(may, n)[on])
            item.append(self.item[entry][on])
            place.append(self.place[entry][on])
        return np.concatenate(at), np.concatenate(item), np.concatenate(place)


def aligned(text: np.ndarray, item: np.ndarray, shift: int, window: int, errors: int) -> tuple[int, np.ndarray]:
    """Equal words of the best window of an alignment, and the item's words in windows that pass."""
    low, high = max(0, -shift), min(len(item), len(text) - shift)
    covered = np.zeros(len(item), bool)
    size = min(window, len(item))
    allowed = errors if len(item) >= window else 0
    if high - low < size:
        return 0, covered
    equal = item[low:high] == text[low + shift : high + shift]
    sums = np.append(0, np.cumsum(equal))
    inside = sums[size:] - sums[:-size]
    for a in np.flatnonzero(inside >= size - allowed).tolist():
        covered[low + a : low + a + size] = True
    return int(inside.max()), covered


def matches_of(batch: pa.RecordBatch, column: str, block: Block, window: int, errors: int, any_item: bool = False) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(row, item, best window's equal words, covered words, first and last word in the text) of a slice.

    With ``any_item`` a row that matches is not compared with further items.
    """
    words = Words(*text_buffer(batch.column(column)), kinds=_KINDS)
    at, item, place = block.hits(words.hash)
    if not len(at):
        return
    row = np.searchsorted(words.first, at, "right") - 1
    found: dict[tuple[int, int], list] = {}
    done: set[int] = set()
    for r, k, shift in np.unique(np.stack([row, item, at - place], axis=1), axis=0).tolist():
        if r in done:
            continue
        first = int(words.first[r])
        text = words.hash[first : int(words.first[r + 1])]
        best, covered = aligned(text, block.words[k], shift - first, window, errors)
        if covered.any():
            if any_item:
                done.add(r)
            where = np.flatnonzero(covered) + shift - first
            old = found.get((r, k))
            if old is None:
                found[r, k] = [best, covered, int(where[0]), int(where[-1])]
            else:
                found[r, k] = [max(best, old[0]), old[1] | covered, min(old[2], int(where[0])), max(old[3], int(where[-1]))]
    for (r, k), (best, covered, a, z) in sorted(found.items()):
        yield r, k, best, int(covered.sum()), a, z


def texts_of(benchmark: DataFrame, text_column: str) -> DataFrame:
    """(_no, _text): the different texts of the benchmark's items, so that copies of one take no room."""
    texts = benchmark.select(benchmark[text_column].alias("_text")).where("_text is not null").distinct()
    return stored(texts.withColumn("_no", F.monotonically_increasing_id()), "benchmark-texts")


def blocks(rows: DataFrame, masks: tuple[str, ...], window: int, errors: int, block_words: int) -> Iterator[Block]:
    """The benchmark's texts (``texts_of``), a bounded share of them at a time."""
    if not complete(masks, window, errors):
        raise ValueError(f"masks {masks} miss windows of {window} words with {errors} substitutions")
    chars = rows.agg(F.sum(F.length("_text"))).first()[0] or 0
    n = 1 + chars // (5 * block_words)
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("_text"), F.lit(n)) == k).collect()  # about block_words words
        part.sort(key=lambda r: r._no)
        if part:
            yield Block([r._no for r in part], [r._text for r in part], masks, window)


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text",
    masks: tuple[str, ...] = MASKS, window: int = WINDOW, errors: int = ERRORS, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row for each document and benchmark item that it holds a window of.

    Columns: both ids, ``words`` of the item, ``matched`` words of the best
    window, ``covered`` words of the item in windows that pass, and the words
    ``start`` to ``stop`` of the text that they span. Where both ids have one
    name, the item's comes out as ``item_<name>``. Null or empty texts and
    items match nothing; items of equal words are all reported; a repeated row
    is reported again, a null id as null; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    frame = docs.select(docs[text_column].alias("_text"), docs[id_column].alias("_id"))
    kinds = docs.schema[id_column].dataType.simpleString(), benchmark.schema[item_column].dataType.simpleString()
    item_name = f"item_{item_column}" if item_column == id_column else item_column
    schema = f"`{id_column}` {kinds[0]}, `{item_name}` {kinds[1]}, {MATCH}"
    texts = texts_of(benchmark, item_text)
    found = []
    for block in blocks(texts, masks, window, errors, block_words):
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            b = shared.value
            names = ["_id", "_no", *(c.split()[0] for c in MATCH.split(", "))]
            for whole in batches:
                for part in slices(whole, "_text"):
                    ids, rows = part.column("_id"), []
                    for r, k, best, covered, a, z in matches_of(part, "_text", b, window, errors):
                        rows += [(r, i, len(b.words[k]), best, covered, a, z + 1) for i in b.ids[k]]
                    if rows:
                        columns = list(zip(*rows))
                        yield pa.RecordBatch.from_arrays([ids.take(pa.array(columns[0])), pa.array(columns[1], pa.int64()), *(pa.array(c, pa.int64()) for c in columns[2:])], names=names)

        found.append(frame.mapInArrow(run, f"_id {kinds[0]}, _no bigint, {MATCH}"))
    if not found:
        return spark.createDataFrame([], schema)
    items = benchmark.select(benchmark[item_column].alias("_item"), benchmark[item_text].alias("_text")).join(texts, "_text").select("_no", "_item")
    every = reduce(DataFrame.unionByName, found).join(items, "_no")
    return every.select(F.col("_id").alias(id_column), F.col("_item").alias(item_name), *(c.split()[0] for c in MATCH.split(", ")))


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_column: str = "item_id", item_text: str = "text",
    masks: tuple[str, ...] = MASKS, window: int = WINDOW, errors: int = ERRORS, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` without the rows that hold a window of a benchmark item; all columns stay."""
    spark = docs.sparkSession
    ship(spark)
    for block in blocks(texts_of(benchmark, item_text), masks, window, errors, block_words):
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            for whole in batches:
                for part in slices(whole, text_column):
                    keep = np.ones(part.num_rows, bool)
                    keep[[m[0] for m in matches_of(part, text_column, shared.value, window, errors, any_item=True)]] = False
                    yield part.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
