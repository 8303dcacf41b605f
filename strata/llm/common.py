"""What several operators share: scratch tables, Arrow text buffers, word hashes.

Word and shingle hashes are 64 bits wide. Two different word sequences of a
corpus collide with probability about ``n**2 / 2**65``; the operators that
verify do so on these hashes.
"""

from __future__ import annotations

import atexit
import io
import os
import shutil
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path

SLICE_BYTES = 1 << 20
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for name in ("__init__.py", "session.py"):
            z.write(os.path.join(root, name), f"strata/{name}")
        for name in sorted(os.listdir(os.path.join(root, "llm"))):
            if name.endswith(".py"):
                z.write(os.path.join(root, "llm", name), f"strata/llm/{name}")
    # The driver's own copy, which Spark's file server hands to every worker.
    d = tempfile.mkdtemp(prefix="strata-py-")
    atexit.register(shutil.rmtree, d, True)
    path = os.path.join(d, "strata_llm.zip")
    with open(path, "wb") as f:
        f.write(data.getvalue())
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back.

    Cuts the lineage: what is read later does not depend on the executors that
    computed it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of ``batch`` of about ``limit`` text bytes (one row at least)."""
    _, offsets = text_buffer(batch.column(column))
    at, n = 0, batch.num_rows
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        end = min(n, max(end, at + 1))
        yield batch.slice(at, end - at)
        at = end


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and row offsets into them; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, where, data = column.buffers()
    if n == 0 or where is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(where, kind, n + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8, offsets[-1] - offsets[0], offsets[0]), offsets - offsets[0]


# White space is space and tab to carriage return; A-Z become lower case.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_LOWER = _BYTE[_LOWER]
_BYTE[_SPACE] = 0
_BYTE_LOWER[_SPACE] = 0
_BASE = np.uint64(0x9E3779B97F4A7C13)
_STEPS = np.random.default_rng(21).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def _powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


WHITE = (~_SPACE).astype(np.uint8)  # words: what white space separates


class Words:
    """Words of a slice of texts: ``start``, ``end`` (bytes), ``hash``; ``first[i]`` is row i's first word.

    ``kinds`` gives each byte's kind; a word is a longest run of one kind other than 0.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = True, kinds: np.ndarray = WHITE):
        n = len(data)
        kind = kinds[data]
        other = np.zeros(n + 1, np.uint8)
        other[1:] = kind
        other[offsets[:-1]] = 0
        self.start = np.flatnonzero((kind != 0) & (kind != other[:n]))
        other[:n] = kind
        other[offsets[1:]] = 0
        self.end = np.flatnonzero((kind != 0) & (kind != other[1:])) + 1
        self.first = np.searchsorted(self.start, offsets)
        if len(self.start) == 0:
            self.hash = np.zeros(0, np.uint64)
            return
        gaps = np.diff(np.append(self.start, n))
        lead = self.start[0]
        place = np.arange(lead, n) - np.repeat(self.start, gaps)
        longest = int((self.end - self.start).max())
        place = np.minimum(place, longest)
        values = (_BYTE_LOWER if lower else _BYTE)[data[lead:]] * _powers(longest + 1)[place]
        if kinds is not WHITE:  # whose separators count 0 anyway
            values *= kind[lead:] != 0
        self.hash = mix(np.add.reduceat(values, self.start - lead))


def shingles(words: Words, size: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each row's ``size``-word shingles.

    A row with fewer words (but one at least) has one: its whole sequence.
    """
    w, first = words.hash, words.first
    run = np.zeros(max(len(w) - size + 1, 0), np.uint64)
    for k in range(size if len(run) else 0):
        run += w[k : k + len(run)] * _STEPS[k]
    run = mix(run)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(run[a : b - size + 1]))
        elif b > a:
            out.append(mix((w[a:b] * _STEPS[: b - a]).sum(keepdims=True) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def summed(df: DataFrame, count: Callable[[pa.RecordBatch, np.ndarray], None], size: int, blocks: int = 16) -> np.ndarray:
    """A vector of ``size`` counts over all rows: ``count`` adds a batch to a task's vector.

    Vectors are summed in blocks, first those of up to 256 neighbouring tasks,
    then the sums; the driver gets one vector of fixed size.
    """
    ship(df.sparkSession)
    step = -(-size // blocks)

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_row = np.zeros(size, np.int64), False
        for b in batches:
            any_row = any_row or b.num_rows > 0
            count(b, total)
        if any_row:
            group = TaskContext.get().partitionId() // 256
            for k in range(blocks):
                yield pa.RecordBatch.from_pydict({"block": pa.array([k], pa.int32()), "grp": pa.array([group], pa.int32()), "data": pa.array([total[k * step : (k + 1) * step].tobytes()], pa.binary())})

    def add(group: pa.Table) -> pa.Table:
        total = np.zeros(step, np.int64)
        for x in group.column("data"):
            part = np.frombuffer(x.as_buffer(), np.int64)
            total[: len(part)] += part
        return pa.table({"block": group.column("block")[:1], "grp": group.column("grp")[:1], "data": pa.array([total.tobytes()], pa.binary())})

    schema = "block int, grp int, data binary"
    parts = df.mapInArrow(tasks, schema).groupBy("block", "grp").applyInArrow(add, schema)
    out = np.zeros(blocks * step, np.int64)
    for r in parts.groupBy("block").applyInArrow(add, schema).collect():
        out[r.block * step : (r.block + 1) * step] = np.frombuffer(r.data, np.int64)
    return out[:size]


MAX_BITS = 1 << 26  # 8 MB


def bitmap(df: DataFrame, column: str) -> np.ndarray:
    """Bits of the low-order part of a column of hashes (longs), 16 a row and ``MAX_BITS`` at most.

    A filter ahead of an exact join: it lets all rows of ``df`` through, and
    some others.
    """
    bits, n = 1 << 15, df.count()
    while bits < min(MAX_BITS, 16 * n):
        bits *= 2
    place = F.pmod(F.col(column), F.lit(bits)) + 1
    rows = df.select(place.alias("_b")).groupBy(F.bitmap_bucket_number("_b").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_b")).alias("m")).collect()
    out = np.zeros(bits // 8, np.uint8)
    for r in rows:
        out[(r.k - 1) * 4096 : r.k * 4096] = np.frombuffer(bytes(r.m), np.uint8)
    return out


def in_bitmap(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys & np.int64(len(bits) * 8 - 1)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def flagged(df: DataFrame, column: str, found: DataFrame, flag: str) -> DataFrame:
    """``df`` with ``flag``: whether its hash ``column`` may be among that of ``found``.

    The same bitmap (``MAX_BITS`` at most) joined natively, so that rows which
    need no join are told apart before they would be shuffled.
    """
    bits, n = 1 << 15, found.count()
    while bits < min(MAX_BITS, 16 * n):
        bits *= 2
    place = F.pmod(F.col(column), F.lit(bits)) + 1
    maps = found.select(place.alias("_b")).groupBy(F.bitmap_bucket_number("_b").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_b")).alias("_map"))
    rows = df.withColumns({"_bucket": F.bitmap_bucket_number(place), "_at": F.bitmap_bit_position(place)}).join(F.broadcast(maps), "_bucket", "left")
    byte = F.conv(F.hex(F.expr("substring(_map, cast(_at div 8 as int) + 1, 1)")), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, (F.col("_at") % 8).cast("int")) == 1, F.lit(False))
    return rows.withColumn(flag, hit).drop("_bucket", "_map", "_at")
