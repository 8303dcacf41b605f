"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Encoding keeps an agenda of adjacent symbol pairs whose concatenation is a
piece, ordered by score (ties: leftmost first), and merges the best one until
none is left; what is no piece then falls back to bytes. A text is cut before
each run of spaces, where no merge can cross if no piece has a space after
another character (looked up when the model loads). Equal chunks are encoded
once: short ones together, one agenda step of all of them per numpy pass, long
ones with a heap. Every chunk that enters the cache is checked against the
sentencepiece library, a few dozen a call; where they differ the library's ids
hold.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from strata.llm.common import ship, slices

CACHE_CHUNKS = 120_000
CACHE_CHARS = 4_000_000  # of the chunks in a generation, with CACHE_CHUNKS of ordinary words about a third of that
SHORT = 48  # chunks up to so many characters go through the numpy agenda
_NONE = np.int32(2**31 - 1)
_CHUNK = re.compile(r" ( *[^ ]*)")
_MARK = "▁"


class Codec:
    """Encoder and decoder of one model, given as the bytes of its file."""

    def __init__(self, model: bytes, cache_chunks: int = CACHE_CHUNKS):
        import sentencepiece

        sp = self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = self.size = sp.get_piece_size()
        self.eos = sp.eos_id()
        normal = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.text = [sp.id_to_piece(i) for i in range(n)]
        ids = {self.text[i]: i for i in normal}
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.byte_of = {i: b for b, i in enumerate(self.byte_ids)}
        # characters that are part of a piece but are none themselves get ids beyond the vocabulary
        for piece in list(ids):
            for c in piece:
                ids.setdefault(c, len(self.text)) == len(self.text) and self.text.append(c)
        self.ids = ids
        order = {s: k for k, s in enumerate(sorted({sp.get_score(i) for i in normal}, reverse=True))}
        self.rank = np.full(len(self.text), _NONE, np.int32)
        self.rank[normal] = [order[sp.get_score(i)] for i in normal]
        pairs = {}
        for i in normal:
            p = self.text[i]
            for k in range(1, len(p)):
                a, b = ids.get(p[:k]), ids.get(p[k:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = i
        self.pairs = pairs
        self._index(pairs)
        self.char = np.full(0x110000, -1, np.int32)
        for c, i in ids.items():
            if len(c) == 1:
                self.char[ord(c)] = i
        self.char[0x20] = self.char[ord(_MARK)]
        pieces = [self.text[i] for i in normal]
        self.cuts = not any(_MARK in p.lstrip(_MARK) for p in pieces)
        self.is_byte = np.zeros(n, bool)
        self.is_byte[self.byte_ids] = True
        self.plain = ["" if sp.is_control(i) else self.text[i].replace(_MARK, " ") for i in range(n)]
        # Chunks without their first space. The generation before serves until the next one is full.
        self.cache: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.other: dict[str, str] = {}
        self.cache_chunks, self.cached_chars = cache_chunks, 0

    def _index(self, pairs: dict[int, int]) -> None:
        """Open addressing: pair -> merged id, for lookups of whole arrays."""
        bits = max(4, (4 * len(pairs)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.merged = np.full(1 << bits, -1, np.int32)
        left = np.fromiter(pairs, np.int64, len(pairs))
        value = np.fromiter(pairs.values(), np.int32, len(pairs))
        slot = self._slot(left)
        while len(left):
            free = self.keys[slot] == -1
            _, one = np.unique(np.where(free, slot, -1 - np.arange(len(slot))), return_index=True)
            take = one[free[one]]
            self.keys[slot[take]], self.merged[slot[take]] = left[take], value[take]
            rest = np.ones(len(left), bool)
            rest[take] = False
            left, value, slot = left[rest], value[rest], (slot[rest] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def lookup(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merged id of each pair, -1 for none."""
        out = np.full(len(a), -1, np.int32)
        todo = np.flatnonzero((a >= 0) & (b >= 0))
        key = (a[todo].astype(np.int64) << 32) | b[todo]
        slot = self._slot(key)
        while len(todo):
            found = self.keys[slot]
            hit = found == key
            out[todo[hit]] = self.merged[slot[hit]]
            on = ~hit & (found != -1)
            todo, key, slot = todo[on], key[on], (slot[on] + 1) & self.mask
        return out

    def _agendas(self, chunks: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks (of up to ``width`` characters) and how many each has; one merge of every chunk a round."""
        n, w = len(chunks), width + 1
        lens = np.fromiter(map(len, chunks), np.int64, n)
        points = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32)
        inside = (np.arange(w) < lens[:, None]).ravel()
        sym = np.full(n * w, -2, np.int32)
        sym[inside] = self.char[points]
        raw = np.zeros(n * w, np.uint32)
        raw[inside] = points
        # Flat positions row * w + column; the last column of a row is never a symbol.
        nxt = np.arange(1, n * w + 1, dtype=np.int32)
        prv = np.arange(-1, n * w - 1, dtype=np.int32)
        into = self.lookup(sym[:-1], sym[1:])
        into = np.append(into, np.int32(-1))
        best = np.where(into >= 0, self.rank[into], _NONE).reshape(n, w)
        base = np.arange(n, dtype=np.int64) * w
        while len(base):
            # rows that are done leave the matrix
            at = best.argmin(axis=1)
            low = np.take_along_axis(best, at[:, None], 1)[:, 0]
            on = np.flatnonzero(low != _NONE)
            if len(on) < len(base):
                best, base, at = best[on], base[on], at[on]
            k = len(base)
            if not k:
                break
            cells, row = best.ravel(), np.arange(k) * w
            here = base + at
            gone = nxt[here].astype(np.int64)
            after = nxt[gone]
            merged = into[here]
            sym[here], sym[gone] = merged, -3
            cells[row + gone - base] = _NONE
            nxt[here] = after
            prv[after] = here
            m = self.lookup(merged, sym[after])
            into[here] = m
            cells[row + at] = np.where(m >= 0, self.rank[m], _NONE)
            has = np.flatnonzero(at > 0)
            if len(has):
                left = prv[here[has]].astype(np.int64)
                m = self.lookup(sym[left], merged[has])
                into[left] = m
                cells[row[has] + left - base[has]] = np.where(m >= 0, self.rank[m], _NONE)
        alive = inside & (sym != -3)
        flat, counts = sym[alive], alive.reshape(n, w).sum(axis=1)
        odd = np.flatnonzero((flat < 0) | (flat >= self.size))
        if not len(odd):
            return flat, counts
        chars = [[self.byte_ids[b] for b in chr(c).encode("utf-8", "surrogatepass")] for c in raw[alive][odd].tolist()]
        sizes = np.ones(len(flat), np.int64)
        sizes[odd] = [len(c) for c in chars]
        starts = np.cumsum(sizes) - sizes
        out = np.repeat(flat, sizes)
        for at, ids in zip(starts[odd].tolist(), chars):
            out[at : at + len(ids)] = ids
        return out, np.add.reduceat(sizes, np.cumsum(counts) - counts)

    def _with_bytes(self, symbols: list[int], chars: list[str]) -> np.ndarray:
        out: list[int] = []
        for s, c in zip(symbols, chars):
            if 0 <= s < self.size:
                out.append(s)
            else:
                out += [self.byte_ids[b] for b in c.encode("utf-8", "surrogatepass")]
        return np.array(out, np.int32)

    def agenda(self, chunk: str) -> np.ndarray:
        """The same for one chunk of any length, with a heap."""
        sym = self.char[np.frombuffer(chunk.encode("utf-32-le", "surrogatepass"), np.uint32)].tolist()
        n = len(sym)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        rank, pairs, heap = self.rank, self.pairs, []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < n and sym[i] >= 0 and sym[j] >= 0:
                m = pairs.get(sym[i] << 32 | sym[j])
                if m is not None:
                    heapq.heappush(heap, (int(rank[m]), i, j, sym[i], sym[j], m))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, a, b, m = heapq.heappop(heap)
            if sym[i] != a or sym[j] != b or nxt[i] != j:
                continue
            sym[i], sym[j] = m, -3
            nxt[i] = nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
            offer(i, nxt[i])
            offer(prv[i], i)
        left = [(s, c) for s, c in zip(sym, chunk) if s != -3]
        return self._with_bytes([s for s, _ in left], [c for _, c in left])

    def decode(self, ids: list[int]) -> str:
        """Text of ``ids`` with the spaces that pieces hold, the leading one included."""
        out, run = [], bytearray()
        for i in ids:
            b = self.byte_of.get(i)
            if b is not None:
                run.append(b)
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run = bytearray()
            out.append(self.plain[i])
        out.append(run.decode("utf-8", "replace"))
        return "".join(out)

    def _differing(self, chunks: list[str], flat: np.ndarray, ends: np.ndarray) -> list[int]:
        """Chunks of the groups whose ids, a line for each chunk, are not the library's."""
        group, n = 64, len(chunks)
        texts = ["\n " + "\n ".join(chunks[i : i + group]) for i in range(0, n, group)]
        theirs = self.sp.encode(texts, num_threads=1)
        starts = np.append(0, ends[:-1])
        ours = np.insert(flat, starts, self.byte_ids[10]).tolist()
        lead, differing = [self.ids[_MARK]], []
        for k, ids in enumerate(theirs):
            a, b = k * group, min((k + 1) * group, n)
            if ids != lead + ours[int(starts[a]) + a : int(ends[b - 1]) + b]:
                differing += range(a, b)
        return differing

    def learn(self, chunks: list[str]) -> None:
        """Encode and decode ``chunks`` (each without its first space) into the cache."""
        chunks.sort(key=len)
        flats, counts, at = [], [], 0
        for width in (5, 8, 11, 14, 18, 24, 32, SHORT):
            end = at
            while end < len(chunks) and len(chunks[end]) < width:
                end += 1
            for a in range(at, end, 10_000):
                flat, count = self._agendas([" " + c for c in chunks[a : min(end, a + 10_000)]], width)
                flats.append(flat)
                counts.append(count)
            at = end
        for c in chunks[at:]:
            flats.append(self.agenda(" " + c))
            counts.append(np.array([len(flats[-1])]))
        flat, ends = np.concatenate(flats).astype("<i4"), np.cumsum(np.concatenate(counts))
        raw, pieces = flat.tobytes(), [self.plain[i] for i in flat.tolist()]
        bytes_so_far = np.append(0, np.cumsum(self.is_byte[flat]))
        a = 0
        for c, b, has in zip(chunks, ends.tolist(), np.diff(bytes_so_far[np.append(0, ends)]).tolist()):
            self.cache[c] = raw[4 * a : 4 * b]
            self._decodes(c, self.decode(flat[a:b].tolist()) if has else "".join(pieces[a:b]))
            a = b
        for i in self._differing(chunks, flat, ends):
            ids = self.sp.encode("\n " + chunks[i])[2:]
            self.cache[chunks[i]] = np.array(ids, "<i4").tobytes()
            self._decodes(chunks[i], self.decode(ids))

    def _decodes(self, chunk: str, decoded: str) -> None:
        """Chunks whose ids decode to another text are noted (with a byte-complete vocabulary there are none)."""
        if decoded[1:] != chunk or decoded[:1] != " ":
            self.other[chunk] = decoded
        elif self.other:
            self.other.pop(chunk, None)

    def _split(self, text: str | None) -> list[str]:
        if not text:
            return []
        text = text.replace(_MARK, " ")
        if not self.cuts:
            return [text]
        return _CHUNK.findall(" " + text) if "  " in text or text[0] == " " else text.split(" ")

    def batch(self, texts: list[str | None]) -> tuple[list[bytes], list[str]]:
        """Ids (little-endian 32-bit, the end id last) and decoded text of each text."""
        if len(self.cache) > self.cache_chunks or self.cached_chars > CACHE_CHARS:
            self.before, self.cache, self.cached_chars = self.cache, {}, 0
        rows = [self._split(t) for t in texts]
        new: set[str] = set()
        get, ids = self.cache.__getitem__, []
        for chunks in rows:
            try:
                ids.append(b"".join(map(get, chunks)))
            except KeyError:
                new.update(chunks)
                ids.append(None)
        new -= self.cache.keys()
        again = new & self.before.keys()
        for c in again:
            self.cache[c] = self.before[c]
        self.cached_chars += sum(map(len, new))
        if new := list(new - again):
            self.learn(new)
        end = np.array([self.eos], "<i4").tobytes()
        ids = [(b"".join(map(get, chunks)) if x is None else x) + end for x, chunks in zip(ids, rows)]
        if not self.other:  # each chunk decodes to itself after a space
            return ids, [" ".join(chunks) for chunks in rows]
        return ids, ["".join([self.other.get(c, " " + c) for c in chunks])[1:] for chunks in rows]


_CODECS: dict[int, Codec] = {}


def _codec(model: bytes) -> Codec:
    key = hash(model)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(model)
    return _CODECS[key]


def encode_decode(docs: DataFrame, model_path: str | None = None, text_column: str = "text", keep: list[str] | None = None, slice_bytes: int = 2 << 20) -> DataFrame:
    """``keep`` columns of ``docs`` (all but the text by default) plus ``ids`` and ``decoded``.

    ``ids`` are the library's ids of the whole text with the end id last, and
    ``decoded`` the library's decoding of them. Null or empty text has the end
    id alone and decodes to the empty string. Columns of ``docs`` named ``ids``
    or ``decoded`` are replaced. Each row stands for itself, so repeated rows
    and an empty table need no rule. ``model_path`` is read by the driver.
    """
    if model_path is None:
        import public_tokenizers

        model_path = public_tokenizers.path("piece_bpe_32k.model")
    spark = docs.sparkSession
    ship(spark)
    with open(model_path, "rb") as f:
        model = spark.sparkContext.broadcast(f.read())  # a vocabulary file: fixed size
    keep = [c for c in docs.columns if c != text_column] if keep is None else keep
    keep = [c for c in keep if c not in ("ids", "decoded")]
    fields = [docs.schema[c] for c in keep]
    schema = T.StructType([*fields, T.StructField("ids", T.ArrayType(T.IntegerType(), False)), T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model.value)
        for whole in batches:
            for b in slices(whole, "_text", slice_bytes):
                ids, decoded = codec.batch(b.column("_text").to_pylist())
                offsets = np.zeros(len(ids) + 1, np.int32)
                np.cumsum([len(x) // 4 for x in ids], out=offsets[1:])
                values = pa.array(np.frombuffer(b"".join(ids), "<i4"), pa.int32())
                columns = [*b.columns[1:], pa.ListArray.from_arrays(pa.array(offsets), values), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "ids", "decoded"])
        codec.before = {}  # a worker keeps one generation between tasks

    return docs.select(docs[text_column].alias("_text"), *[docs[c] for c in keep]).mapInArrow(run, schema)
