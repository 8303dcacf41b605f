"""Hard negatives by score bounds along a spanning tree of the anchors.

Scores are integer inner products. For two anchors joined by an edge, the score
of a row differs by at most the edge's length times the row's norm. So a row's
scores at the anchors of a minimum spanning tree follow from its score at the
root within bounds that widen along the edges; only where the bounds overlap a
window that counts is the row scored again, which makes the bound exact for the
anchors below.

Two passes over all rows: the first finds each anchor's positives (the window is
what is above its least positive so far), the second the negatives within the
share of a positive's score (the windows also shrink from below as negatives are
found). Anchors are worked on in blocks of about ``BLOCK`` by a hash of their id;
a block with its tree is broadcast and the rows are scanned once a pass. A task
sends the few best rows of each anchor or positive on.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import ship, stored
from strata.llm.vectors import dimension, matrix

BLOCK = 1024
TILE = 2048
EXACT = 2**53  # integers that a double holds
_LAST = np.iinfo(np.int64).max


class Tree:
    """A minimum spanning tree of anchors: ``order`` with parents first, ``parent`` and ``length`` of the edge to it."""

    def __init__(self, x: np.ndarray):
        n = len(x)
        x = x.astype(float)
        centre = x.mean(axis=0)
        root = int(((x - centre) ** 2).sum(axis=1).argmin())
        self.order, self.parent, self.length = [root], np.full(n, -1), np.zeros(n)
        near, by = ((x - x[root]) ** 2).sum(axis=1), np.full(n, root)
        near[root] = np.inf
        for _ in range(n - 1):  # Prim's algorithm
            k = int(near.argmin())
            self.order.append(k)
            self.parent[k], self.length[k] = by[k], np.sqrt(near[k])
            near[k] = np.inf
            d = ((x - x[k]) ** 2).sum(axis=1)
            closer = (d < near) & np.isfinite(near)
            near[closer], by[closer] = d[closer], k


class Block:
    """Anchors of a block: ids, labels, integer vectors, tree; with windows, their positives."""

    def __init__(self, ids: list, labels: list, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.tree = Tree(vectors)
        self.positives: list[list[tuple]] = [[] for _ in ids]  # (row number, score, low, high) each


def scaled(x: np.ndarray, scale: float) -> np.ndarray:
    """Integers ``floor(scale * x)``, as doubles."""
    return np.floor(scale * x)


class Scores:
    """Exact scores of a tile's rows, and bounds of them along the tree."""

    def __init__(self, block: Block, x: np.ndarray):
        self.block, self.x = block, x
        with np.errstate(over="ignore"):
            most = np.abs(x).max(initial=0) * np.abs(block.vectors).max(initial=0) * max(x.shape[1], 1)
            self.norm = np.sqrt((x * x).sum(axis=1))
        self.small = bool(most < EXACT)
        self.low = np.zeros((len(block.ids), len(x)))
        self.high = np.zeros((len(block.ids), len(x)))

    def exact(self, anchor: int, at: np.ndarray) -> np.ndarray:
        a = self.block.vectors[anchor]
        if self.small:
            s = self.x @ a if 2 * len(at) > len(self.x) else self.x[at] @ a
            return (s[at] if 2 * len(at) > len(self.x) else s).astype(np.int64)
        big = [sum(int(u) * int(v) for u, v in zip(row, a)) for row in self.x[at].tolist()]
        return np.array([min(max(s, -(2**63)), 2**63 - 1) for s in big], np.int64)

    def bounds(self, anchor: int) -> None:
        """What the parent's scores say of this anchor's."""
        p = self.block.tree.parent[anchor]
        if p < 0 or not self.small:
            self.low[anchor], self.high[anchor] = -np.inf, np.inf
            return
        width = self.block.tree.length[anchor] * self.norm * (1 + 1e-9) + 2  # 2: of rounding, of integers below 2**53
        self.low[anchor], self.high[anchor] = self.low[p] - width, self.high[p] + width

    def settle(self, anchor: int, at: np.ndarray) -> np.ndarray:
        """Score rows ``at`` and make their bounds exact."""
        s = self.exact(anchor, at)
        self.low[anchor, at] = self.high[anchor, at] = s
        return s


def _merge(best: list[tuple], scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray, k: int, extra: np.ndarray) -> list[tuple]:
    """The first ``k`` by descending score, ascending id, null ids last, of ``best`` and more rows."""
    if len(scores) > k:
        on = scores >= np.partition(scores, len(scores) - k)[-k]
        scores, ids, nulls, extra = scores[on], ids[on], nulls[on], extra[on]
    if len(scores) > k:
        on = np.lexsort((ids, nulls, -scores))[:k]
        scores, ids, nulls, extra = scores[on], ids[on], nulls[on], extra[on]
    best = [*best, *zip((-scores).tolist(), nulls.tolist(), ids.tolist(), extra.tolist())]
    return sorted(best)[:k]


def _tiles(batches: Iterator[pa.RecordBatch], dim: int, scale: float) -> Iterator[tuple]:
    """(ids, null ids, labels, integers) of tiles of the rows that take part."""
    for whole in batches:
        for b in (whole.slice(i, TILE) for i in range(0, whole.num_rows, TILE)):
            x, on = matrix(b.column("_v"), dim)
            at = np.flatnonzero(on & b.column("_label").is_valid().to_numpy(zero_copy_only=False))
            ids = b.column("_id")
            nulls = ids.is_null().to_numpy(zero_copy_only=False)[at]
            yield ids.fill_null(0).to_numpy(zero_copy_only=False)[at], nulls, b.column("_label").to_numpy(zero_copy_only=False)[at].astype(np.int64), scaled(x[at], scale)


def positives(rows: DataFrame, shared, k: int, dim: int, scale: float) -> DataFrame:  # noqa: ANN001
    """(anchor, score, none, id) of each task's ``k`` best rows of an anchor's label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Block = shared.value
        best: list[list[tuple]] = [[] for _ in block.ids]
        for ids, nulls, labels, x in _tiles(batches, dim, scale):
            scores = Scores(block, x)
            same = {label: labels == label for label in set(block.labels)}
            for a in block.tree.order:
                scores.bounds(a)
                least = -best[a][-1][0] if len(best[a]) == k else -np.inf
                own = ~nulls & (ids == block.ids[a])
                at = np.flatnonzero(same[block.labels[a]] & ~own & (scores.high[a] >= least)) if block.tree.parent[a] >= 0 else np.arange(len(ids))
                if not len(at):
                    continue
                s = scores.settle(a, at)
                on = same[block.labels[a]][at] & ~own[at] & (s >= least)
                best[a] = _merge(best[a], s[on], ids[at[on]], nulls[at[on]], k, np.zeros(on.sum(), np.int64))
        flat = [(a, -s, none, None if none else i) for a, rows in enumerate(best) for s, none, i, _ in rows]
        yield _batch(flat, (pa.int64(), pa.int64(), pa.bool_(), pa.int64()), ["anchor", "score", "none", "id"])

    return rows.mapInArrow(run, "anchor bigint, score bigint, none boolean, id bigint")


def negatives(rows: DataFrame, shared, k: int, dim: int, scale: float) -> DataFrame:  # noqa: ANN001
    """(anchor, place, score, none, id) of each task's ``k`` best rows in the window of each positive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Block = shared.value
        best: dict[tuple[int, int], list[tuple]] = {(a, place): [] for a, found in enumerate(block.positives) for place, *_ in found}
        for ids, nulls, labels, x in _tiles(batches, dim, scale):
            scores = Scores(block, x)
            other = {label: labels != label for label in set(block.labels)}
            for a in block.tree.order:
                scores.bounds(a)
                windows = []
                for place, _, low, high in block.positives[a]:
                    held = best[a, place]
                    windows.append((place, max(low, -held[-1][0]) if len(held) == k else low, high))
                if block.tree.parent[a] < 0:
                    at = np.arange(len(ids))
                else:
                    may = np.zeros(len(ids), bool)
                    for _, low, high in windows:
                        if low <= high:
                            may |= (scores.high[a] >= low) & (scores.low[a] <= high)
                    at = np.flatnonzero(may & other[block.labels[a]])
                if not len(at):
                    continue
                s = scores.settle(a, at)
                for place, low, high in windows:
                    on = np.flatnonzero((s >= low) & (s <= high) & other[block.labels[a]][at] & (nulls[at] | (ids[at] != block.ids[a])))
                    if len(on):
                        best[a, place] = _merge(best[a, place], s[on], ids[at[on]], nulls[at[on]], k, np.zeros(len(on), np.int64))
        flat = [(a, place, -s, none, None if none else i) for (a, place), rows in best.items() for s, none, i, _ in rows]
        yield _batch(flat, (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64()), ["anchor", "place", "score", "none", "id"])

    return rows.mapInArrow(run, "anchor bigint, place bigint, score bigint, none boolean, id bigint")


def _batch(rows: list[tuple], kinds: tuple, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * len(kinds), kinds)], names=names)


def _first(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "none", "id")
    return rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k)


def hard_negatives(
    rows: DataFrame, asks: Column, n_positives: int = 5, n_negatives: int = 3, low: int = 50, high: int = 95, scale: float = 256.0,
    id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", block_rows: int = BLOCK,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows where ``asks``.

    A component counts as ``floor(scale * x)``, and a score is the inner product
    of these. An anchor's positives are its ``n_positives`` best rows of its own
    label and another id; for each, the ``n_negatives`` best rows of another label and id
    with ``low`` to ``high`` percent of its score. Higher scores come first, ties
    by ascending id, null ids last. Rows with a null label, or with a vector that
    is null or holds a null or non-finite component, take no part; shorter vectors
    count as padded with zeros. A row without an id is no anchor. A repeated row
    is a row of its own; of rows that repeat an anchor's id the one with the least
    label and vector asks. Scores beyond 64 bits count as the greatest such
    number. Extra columns are ignored; an empty table gives an empty result.
    """
    spark = rows.sparkSession
    ship(spark)
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    dim = dimension(rows, vector_column)
    rows = rows.select(F.col(id_column).cast("bigint").alias("_id"), F.col(label_column).cast("bigint").alias("_label"), F.col(vector_column).alias("_v"), asks.alias("_asks"))
    rows = rows.where("_label is not null and _v is not null")
    finite = F.forall("_v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    anchors = rows.where(F.col("_asks") & F.col("_id").isNotNull() & finite).groupBy("_id").agg(F.min(F.struct("_label", "_v")).alias("m"))
    anchors = stored(anchors.select("_id", "m.*"), "anchors")
    blocks = -(-anchors.count() // block_rows)
    rows = rows.drop("_asks")
    out = []
    for b in range(blocks):
        part = anchors.where(F.pmod(F.xxhash64("_id"), F.lit(blocks)) == b).orderBy("_id").collect()  # about block_rows
        if not part:
            continue
        vectors = np.zeros((len(part), dim))
        for i, r in enumerate(part):
            vectors[i, : len(r._v)] = r._v
        block = Block([r._id for r in part], [r._label for r in part], scaled(vectors, scale))
        first = _first(positives(rows, spark.sparkContext.broadcast(block), n_positives, dim, scale), ["anchor"], n_positives).collect()  # block_rows times n_positives
        for r in sorted(first, key=lambda r: (r.anchor, r.n)):
            block.positives[r.anchor].append((r.n, r.score, -(-low * r.score // 100), high * r.score // 100))
        found = _first(negatives(rows, spark.sparkContext.broadcast(block), n_negatives, dim, scale), ["anchor", "place"], n_negatives)
        who = spark.createDataFrame([(r.anchor, r.n, block.ids[r.anchor], r.id, r.score) for r in first], "anchor bigint, place bigint, anchor_id bigint, positive_id bigint, positive_score bigint")
        found = found.join(F.broadcast(who), ["anchor", "place"])
        out.append(found.select("anchor_id", "positive_id", F.col("n").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
    return reduce(DataFrame.unionByName, out) if out else spark.createDataFrame([], schema)
