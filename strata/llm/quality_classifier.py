"""Quality classifier: hashed word n-grams, logistic regression, FTRL updates.

Words are runs of letters and digits or runs of symbols. A text's features are
its hashed words, pairs of neighbouring words and the event that a word repeats
the one before it, each weighted by its share of the text's words; a score is
the logistic function of a sparse dot product.

Weights are learnt with follow-the-regularised-leader updates (per-coordinate
rates, L1 and L2) over a bounded sample of labelled rows: ``max_rows`` of them
(expected), picked by a hash of the id. The sample is dealt to ``shards``
groups, each learns alone, and the weights are averaged; a group holds
``max_rows / shards`` rows and a model is ``2**bits`` weights, whatever the
size of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Words, mix, ship, slices, text_buffer

MAX_ROWS = 16_000
SHARDS = 4
BITS = 18
_KINDS = np.full(256, 2, np.uint8)  # symbols
_KINDS[[0x20, *range(0x09, 0x0E)]] = 0
_KINDS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_PAIR = np.uint64(0xD6E8FEB86659FD93)
_REPEAT = np.uint64(0x2545F4914F6CDD1D)


@dataclass(frozen=True)
class Ftrl:
    """Parameters of the learner; ``scale`` multiplies the features' shares."""

    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1
    epochs: int = 3
    scale: float = 4.0


def hashed(batch: pa.RecordBatch, column: str, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all rows and where each row's begin (and the last's end)."""
    words = Words(*text_buffer(batch.column(column)), kinds=_KINDS)
    w, first = words.hash, words.first
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    pairs = np.flatnonzero(row[1:] == row[:-1])
    a, b = w[pairs], w[pairs + 1]
    equal = a == b
    pair = mix(a * _PAIR + b)
    pair[equal] = _REPEAT  # any word twice is one feature
    keys = np.concatenate([w, pair])
    order = np.argsort(np.concatenate([row, row[pairs]]), kind="stable")
    counts = np.bincount(np.concatenate([row, row[pairs]]), minlength=len(first) - 1)
    return (keys[order] >> np.uint64(64 - bits)).astype(np.int64), np.append(0, np.cumsum(counts))


def learn(rows: list[tuple[np.ndarray, np.ndarray | float]], labels: np.ndarray, size: int, p: Ftrl) -> np.ndarray:
    """Weights (the intercept last) after ``p.epochs`` passes over the rows in their order.

    A row is its features' numbers (below ``size``, each once, then ``size``
    itself for the intercept) and their values.
    """
    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def weight(i: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z[i]) <= p.l1, 0.0, (np.sign(z[i]) * p.l1 - z[i]) / ((p.beta + np.sqrt(n[i])) / p.alpha + p.l2))

    for _ in range(p.epochs):
        for (i, x), y in zip(rows, labels.tolist()):
            w = weight(i)
            g = (1 / (1 + np.exp(-np.clip(np.sum(w * x), -30, 30))) - y) * x
            s = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / p.alpha
            z[i] += g - s * w
            n[i] += g * g
    return weight(np.arange(size + 1))


def labelled_sample(labels: DataFrame, label: Column, max_rows: int, id_column: str = "doc_id") -> DataFrame:
    """About ``max_rows`` ids with their label (0 or 1), picked by a hash of the id.

    Rows without id or label are left out; an id with both labels is too.
    """
    rows = labels.select(F.col(id_column).alias("_id"), label.cast("int").alias("_y")).where("_id is not null and _y in (0, 1)")
    rows = rows.groupBy("_id").agg(F.min("_y").alias("_y"), F.max("_y").alias("_z")).where("_y = _z").select("_id", "_y")
    total = rows.count()
    share = min(1.0, max_rows / max(total, 1))
    return rows.where(F.pmod(F.xxhash64("_id", F.lit(9)), F.lit(1 << 30)) < int(share * (1 << 30)))


def train(docs: DataFrame, sample: DataFrame, id_column: str = "doc_id", text_column: str = "text", bits: int = BITS, shards: int = SHARDS, params: Ftrl = Ftrl()) -> np.ndarray:
    """Averaged weights of the shards' learners; without any labelled row, zeros.

    ``sample`` comes from ``labelled_sample``, whose bound allows the broadcast.
    """
    ship(docs.sparkSession)
    rows = docs.select(docs[id_column].alias("_id"), docs[text_column].alias("_text")).join(F.broadcast(sample), "_id")
    rows = rows.withColumns({"_at": F.xxhash64("_id", F.lit(11)), "_shard": F.pmod(F.xxhash64("_id", F.lit(10)), F.lit(shards))})

    def fit(group: pa.Table) -> pa.Table:
        group = group.sort_by([("_at", "ascending"), ("_id", "ascending"), ("_text", "ascending")])
        features = []
        for whole in group.select(["_text"]).to_batches():
            for b in slices(whole, "_text"):
                f, ends = hashed(b, "_text", bits)
                for x, y in zip(ends[:-1].tolist(), ends[1:].tolist()):
                    index, times = np.unique(f[x:y], return_counts=True)
                    values = np.append(params.scale * times / max(y - x, 1), 1.0)
                    features.append((np.append(index, 1 << bits).astype(np.int32), values.astype(np.float32)))
        w = learn(features, group.column("_y").to_numpy(), 1 << bits, params)
        return pa.table({"w": pa.array([w.tobytes()], pa.binary()), "n": pa.array([len(features)], pa.int64())})

    found = rows.groupBy("_shard").applyInArrow(fit, "w binary, n bigint").collect()  # a model a shard: fixed size
    found.sort(key=lambda r: bytes(r.w))
    if not found:
        return np.zeros((1 << bits) + 1)
    return np.average([np.frombuffer(r.w) for r in found], axis=0, weights=[r.n for r in found])


def score(docs: DataFrame, weights: np.ndarray, text_column: str = "text", keep: list[str] | None = None, output: str = "score", params: Ftrl = Ftrl()) -> DataFrame:
    """``keep`` columns of ``docs`` (all by default) plus ``output``, the probability of label 1.

    Null or empty text, or one of white space only, gets the intercept's
    probability. A column of ``docs`` named like the output is replaced.
    """
    spark = docs.sparkSession
    ship(spark)
    keep = [c for c in (docs.columns if keep is None else keep) if c != output]
    bits = (len(weights) - 1).bit_length() - 1
    model = spark.sparkContext.broadcast(weights)  # 2**bits weights
    schema = docs.select(*[docs[c] for c in keep], F.lit(0.0).alias(output)).schema
    names = [f"_k{i}" for i in range(len(keep))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = model.value
        for whole in batches:
            parts = []
            for b in slices(whole, "_text"):
                f, ends = hashed(b, "_text", bits)
                sums = np.append(0.0, np.cumsum(w[f]))
                n = np.diff(ends)
                dot = params.scale * (sums[ends[1:]] - sums[ends[:-1]]) / np.maximum(n, 1) + w[-1]
                parts.append(1 / (1 + np.exp(-np.clip(dot, -30, 30))))
            if parts:
                yield pa.RecordBatch.from_arrays([*whole.columns[1:], pa.array(np.concatenate(parts))], names=[*keep, output])

    frame = docs.select(docs[text_column].alias("_text"), *[docs[c].alias(n) for c, n in zip(keep, names)])
    return frame.mapInArrow(run, schema)


def quality(docs: DataFrame, labels: DataFrame, label_column: str = "quality", id_column: str = "doc_id", text_column: str = "text", keep: list[str] | None = None, max_rows: int = MAX_ROWS, output: str = "score") -> DataFrame:
    """Train on ``labels`` (all rows given; hold out before) and score every row of ``docs``.

    Returns ``keep`` columns (all by default) and ``output``. Repeated rows score
    alike; an empty table gives an empty result; without labels every score is
    0.5.
    """
    sample = labelled_sample(labels, F.col(label_column), max_rows, id_column)
    return score(docs, train(docs, sample, id_column, text_column), text_column, keep, output)
