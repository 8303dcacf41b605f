"""N-gram Jaccard self-join with a count-vector R-tree.

A document is the set of its distinct word shingles. Shingles are hashed into
groups; how many a document has in each is a point. For two documents the sum
over the groups of the lesser count bounds their overlap from above, and for a
node of an R-tree so does the sum of the lesser of a query's counts and the
node's greatest ones: what stays below the overlap that the threshold asks for
is pruned, the rest is verified on the full sets. Trees use ``GROUPS`` groups;
pairs that they leave are bounded once more by finer ones, whose number grows
with a document's shingles (``PER_GROUP`` of them a group), as the bound of few
groups would not part long documents.

Points are dealt to tasks by an exact rule. In one order of all shingles, two
documents that link share a shingle among the first ``n - ceil(0.8 n) + 1`` of
each. Documents with such a shingle in common form a block. The order puts
shingles last that a sketch of all shingles shows to be frequent, so common
passages form no blocks unless a document is made of them; any order is exact.

1. Documents with equal sets are one node (the copies of a text count once).
2. Blocks of nearly the same nodes are made one, so that a pair meets about once:
   the count vectors of each node are compared with those of two members of each
   of its blocks, picked by a hash, and blocks with the same most frequent
   component of the pairs that may link are searched as one. This decides which
   blocks are searched together, and nothing else.
3. Every block is searched through an R-tree of its points, each against all
   others; large blocks are cut into tiles, and a tree is searched for each pair
   of tiles. Points that no other reaches drop out.
4. For the rest, the search is made again with their full sets beside them, and
   the pairs it leaves are verified. A pair that meets in several blocks counts
   in the first of them. A task sends on the number of links of each node and
   the node's least one in its part, not the links: they may be as many as the
   square of a group of near copies.
5. Components of these.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Words, bitmap, in_bitmap, mix, shingles, ship, slices, stored, summed, text_buffer
from strata.llm.components import components

WORDS = 5
PERCENT = 80
GROUPS = 32
PER_GROUP = 2
SKETCH = 1 << 20  # counters of the sketch that orders shingles
TILE = 2048  # rows of one side of a search task
TILE_SHINGLES = 1 << 22  # of all rows of a side, where their sets are there
BUCKET_ROWS = 20_000  # rows of small blocks that one group of a search holds
FANOUT = 8


def _sets(b: pa.RecordBatch, words: int) -> list[np.ndarray]:
    return shingles(Words(*text_buffer(b.column("_text"))), words)


def _node(s: np.ndarray) -> int:
    """A 64-bit name of a set (sorted hashes)."""
    h = mix(s * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    both = np.array([h.sum(), np.bitwise_xor.reduce(s) + np.uint64(len(s))], np.uint64)
    return int(mix(both[:1] ^ mix(both[1:])).view(np.int64)[0])


def group_counts(s: np.ndarray) -> bytes:
    """Shingles in each group, a byte a group; groups go by the hashes' first bits."""
    groups = GROUPS
    while groups < len(s) // PER_GROUP:
        groups *= 2
    while True:
        bits = groups.bit_length() - 1
        counts = np.bincount((s >> np.uint64(64 - bits)).astype(np.int64), minlength=groups)
        if counts.max() < 256:
            return counts.astype(np.uint8).tobytes()
        groups *= 2


def _folded(counts: np.ndarray, groups: int) -> np.ndarray:
    """Counts of one document, summed to fewer groups."""
    return counts if len(counts) == groups else counts.reshape(groups, -1).sum(axis=1, dtype=np.int32)


def _vectors(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), np.uint8) for x in column]


def _overlaps(one: list[np.ndarray], two: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The bound of the overlap of documents ``one[x[i]]`` and ``two[y[i]]``, for all i."""
    out = np.zeros(len(x), np.int64)
    groups = np.minimum(np.array([len(v) for v in one], np.int64)[x], np.array([len(v) for v in two], np.int64)[y])
    for g in np.unique(groups).tolist():
        at = np.flatnonzero(groups == g)
        for part in np.array_split(at, -(-len(at) * g // (4 << 20))):
            u, left = np.unique(x[part], return_inverse=True)
            v, right = np.unique(y[part], return_inverse=True)
            a = np.stack([_folded(one[k], g) for k in u.tolist()])
            b = np.stack([_folded(two[k], g) for k in v.tolist()])
            out[part] = np.minimum(a[left], b[right]).sum(axis=1, dtype=np.int64)
    return out


def _prefix(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def shingle_levels(docs: DataFrame, words: int = WORDS, size: int = SKETCH) -> np.ndarray:
    """Per counter of a sketch of all shingles, how far above the usual it is (0: usual; a power of two each)."""

    def count(batch: pa.RecordBatch, total: np.ndarray) -> None:
        for b in slices(batch, "_text"):
            sets = _sets(b, words)
            keys = np.concatenate(sets) & np.uint64(size - 1)
            total += np.bincount(keys.astype(np.int64), minlength=size)

    counts = summed(docs.select("_text"), count, size)
    usual = np.median(counts)
    above = np.maximum(counts - usual - 6 * np.sqrt(usual) - 2, 0)
    return np.ceil(np.log2(1 + above)).astype(np.uint8)


def points(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(_id, n, node, counts, prefix) of every document; the last two once per node and task, else null."""
    spark = docs.sparkSession
    levels = spark.sparkContext.broadcast(shingle_levels(docs, words))  # one byte a counter: fixed size
    size = SKETCH

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        level = levels.value
        for whole in batches:
            for b in slices(whole, "_text"):
                n, nodes, counts, prefixes = [], [], [], []
                for s in _sets(b, words):
                    n.append(len(s))
                    node = _node(s) if len(s) else None
                    nodes.append(node)
                    if node is None or node in seen:
                        counts.append(None)
                        prefixes.append(None)
                        continue
                    if len(seen) < 1_000_000:
                        seen.add(node)
                    counts.append(group_counts(s))
                    first = _prefix(len(s), percent)
                    lv = level[(s & np.uint64(size - 1)).astype(np.int64)]
                    # s is sorted, so a stable sort by level orders by (level, hash)
                    prefixes.append(s[np.argsort(lv, kind="stable")[:first]] if lv.any() else s[:first])
                offsets = np.append(0, np.cumsum([0 if p is None else len(p) for p in prefixes])).astype(np.int32)
                values = np.concatenate([np.zeros(0, np.uint64), *[p for p in prefixes if p is not None]]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column("_id"), pa.array(n, pa.int64()), pa.array(nodes, pa.int64()), pa.array(counts, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))],
                    names=["_id", "n", "node", "counts", "prefix"],
                )

    kind = docs.schema["_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"_id {kind}, n bigint, node bigint, counts binary, prefix array<bigint>")


def _enough(overlap: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Whether an overlap reaches ``percent`` of the union, for the sum of both sizes."""
    return (100 + percent) * overlap >= percent * sizes


def bounded(pairs: DataFrame, table: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes whose count vectors allow the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                each = np.arange(b.num_rows)
                least = _overlaps(_vectors(b.column("ca")), _vectors(b.column("cb")), each, each)
                on = _enough(least, b.column("na").to_numpy() + b.column("nb").to_numpy(), percent)
                yield b.select(["a", "b"]).filter(pa.array(on))

    one = table.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("counts").alias("ca"))
    two = table.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("counts").alias("cb"))
    fits = "na * 100 >= nb * {0} and nb * 100 >= na * {0}".format(percent)
    return pairs.join(one, "a").join(two, "b").where(fits).select("a", "b", "na", "nb", "ca", "cb").mapInArrow(run, "a bigint, b bigint")


def full_sets(docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """(node, shingles) of ``nodes`` (and a few others), from a scan of the texts; a node once."""
    wanted = docs.sparkSession.sparkContext.broadcast(bitmap(nodes, "node"))  # at most MAX_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for whole in batches:
            for b in slices(whole, "_text"):
                rows = [(k, s) for s in _sets(b, words) if len(s) and (k := _node(s)) not in seen]
                on = in_bitmap(wanted.value, np.array([k for k, _ in rows], np.int64))
                rows = [r for r, use in zip(rows, on.tolist()) if use]
                if len(seen) < 1_000_000:
                    seen.update(k for k, _ in rows)
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int64()), pa.array([s.tobytes() for _, s in rows], pa.binary())], names=["node", "shingles"])

    return docs.select("_text").mapInArrow(run, "node bigint, shingles binary").dropDuplicates(["node"])


def _packed(counts: np.ndarray) -> np.ndarray:
    """An order of points in which neighbours are close: halves along the coordinate of the greatest spread, again and again."""
    order = np.arange(len(counts))
    todo = [(0, len(counts))]
    while todo:
        a, b = todo.pop()
        if b - a <= FANOUT:
            continue
        part = order[a:b]
        by = counts[part].var(axis=0).argmax()
        order[a:b] = part[np.argsort(counts[part, by], kind="stable")]
        half = a + FANOUT * max(1, (b - a) // (2 * FANOUT))  # leaves are full
        todo += [(a, half), (half, b)]
    return order


class CountTree:
    """R-tree of count vectors, packed by their coordinates: ``FANOUT`` entries a node, as many levels as that takes.

    A node has the greatest count of each group below it, and the least and the
    greatest size.
    """

    def __init__(self, counts: np.ndarray, sizes: np.ndarray):
        self.order = _packed(counts)
        self.levels = [(counts[self.order], sizes[self.order], sizes[self.order])]
        while len(self.levels[-1][1]) > FANOUT:
            top, low, high = self.levels[-1]
            starts = np.arange(0, len(low), FANOUT)
            self.levels.append((np.maximum.reduceat(top, starts), np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)))

    def search(self, counts: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, point) numbers whose bound allows the threshold."""
        n = len(self.levels[-1][1])
        q, p = np.repeat(np.arange(len(sizes)), n), np.tile(np.arange(n), len(sizes))
        for k in range(len(self.levels) - 1, -1, -1):
            top, low, high = self.levels[k]
            on = np.zeros(len(q), bool)
            for part in (slice(a, a + (1 << 16)) for a in range(0, len(q), 1 << 16)):
                x, y = q[part], p[part]
                most = np.minimum(np.minimum(counts[x], top[y]).sum(axis=1), high[y])
                on[part] = _enough(most, sizes[x] + low[y], percent)
            q, p = q[on], p[on]
            if k:
                first, below = p * FANOUT, len(self.levels[k - 1][1])
                many = np.minimum(FANOUT, below - first)
                p = np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())
                q = np.repeat(q, many)
        return q, self.order[p]


def merged(blocks: DataFrame) -> DataFrame:
    """Blocks (key, node, label), those of one most frequent label made one: (key, node).

    A passage's shingles form blocks of nearly the same nodes; merged, a pair
    meets once. Pairs of a block stay together, so none is lost.
    """
    per_label = blocks.groupBy("key", "label").agg(F.count("*").alias("c"))
    most = per_label.groupBy("key").agg(F.max(F.struct("c", F.bitwise_not("label").alias("l"))).alias("m"))
    return blocks.join(most.select("key", F.bitwise_not("m.l").alias("main")), "key").select(F.col("main").alias("key"), "node").distinct()


def dealt(rows: DataFrame, shingles: bool) -> DataFrame:
    """``rows`` (key, node, n) with ``grp`` and tiles ``i`` and ``j`` in which a row of a block meets the others.

    A row of a block of several tiles is in a group with each of them, its own
    included; ``side`` is the tile it is of. Blocks of one tile share groups of
    about ``BUCKET_ROWS`` rows (or ``TILE_SHINGLES``).
    """
    sizes = rows.groupBy("key").agg(F.count("*").alias("rows"), F.sum("n").alias("of"))
    tiles = F.ceil(F.col("rows") / TILE)
    tiles = F.greatest(tiles, F.ceil(F.col("of") / TILE_SHINGLES)) if shingles else tiles
    sizes = stored(sizes.where("rows > 1").withColumn("tiles", tiles), "block-sizes")
    total = sizes.where("tiles = 1").agg(F.sum("rows"), F.sum("of")).first()
    buckets = max(1, (total[0] or 0) // BUCKET_ROWS, (total[1] or 0) // TILE_SHINGLES if shingles else 0, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.join(sizes.select("key", "tiles"), "key").withColumn("side", F.pmod(F.xxhash64("node", F.lit(3)), F.col("tiles")))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1))
    rows = rows.withColumn("other", other).withColumns({"i": F.least("side", "other"), "j": F.greatest("side", "other")}).drop("other")
    alone = F.pmod(F.xxhash64("key", F.lit(5)), F.lit(buckets))
    return rows.withColumn("grp", F.when(F.col("tiles") == 1, alone).otherwise(F.xxhash64("key", "i", "j"))).drop("tiles")


def _parts(group: pa.Table) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """Rows of each block and pair of tiles of a group, and the numbers of either side's rows among them."""
    group = group.combine_chunks().sort_by([("key", "ascending"), ("i", "ascending"), ("j", "ascending"), ("node", "ascending")])
    key, i, j, side = (group.column(c).to_numpy() for c in ("key", "i", "j", "side"))
    new = np.append(True, (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]))
    starts = np.append(np.flatnonzero(new), len(key))
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
        yield group.slice(a, b - a), np.flatnonzero(side[a:b] == i[a]), np.flatnonzero(side[a:b] == j[a])


def _candidates(part: pa.Table, one: np.ndarray, two: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows, of one side each, that the tree and then the finer counts leave; each pair once."""
    n = part.column("n").to_numpy()
    fine = _vectors(part.column("counts"))
    coarse = np.array([_folded(x, GROUPS) for x in fine], np.int32).reshape(-1, GROUPS)
    x, y = CountTree(coarse[two], n[two]).search(coarse[one], n[one], percent)
    x, y = one[x], two[y]
    on = x != y if len(one) != len(two) or (one != two).any() else x < y
    x, y = x[on], y[on]
    on = _enough(_overlaps(fine, fine, x, y), n[x] + n[y], percent)
    return x[on], y[on]


def reached(blocks: DataFrame, table: DataFrame, percent: int) -> DataFrame:
    """Rows (key, node) of blocks that some other row of the block may link with."""
    rows = dealt(blocks.join(table.select("node", "n"), "node"), False).join(table.select("node", "counts"), "node")

    def search(group: pa.Table) -> pa.Table:
        keys, nodes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for part, one, two in _parts(group):
            at = np.unique(np.concatenate(_candidates(part, one, two, percent)))
            keys.append(part.column("key").to_numpy()[at])
            nodes.append(part.column("node").to_numpy()[at])
        return pa.table({"key": pa.array(np.concatenate(keys), pa.int64()), "node": pa.array(np.concatenate(nodes), pa.int64())})

    return rows.select("grp", "key", "i", "j", "side", "node", "n", "counts").groupBy("grp").applyInArrow(search, "key bigint, node bigint").distinct()


def exact_overlaps(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Common elements of ``sets[x[i]]`` and ``sets[y[i]]`` (sorted, distinct), for all i.

    Few pairs are merged one by one; where many pairs are of few sets, products
    of their membership matrices give all at once.
    """
    used, at = np.unique(np.concatenate([x, y]), return_inverse=True)
    x, y = at[: len(x)], at[len(x) :]
    sets = [sets[k] for k in used.tolist()]
    out = np.zeros(len(x), np.int64)
    if len(x) < 16 * len(sets):
        for k, (i, j) in enumerate(zip(x.tolist(), y.tolist())):
            a, b = (sets[i], sets[j]) if len(sets[i]) < len(sets[j]) else (sets[j], sets[i])
            out[k] = np.count_nonzero(b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a)
        return out
    row = np.repeat(np.arange(len(sets)), [len(v) for v in sets])
    _, column, many = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    on = many[column] > 1  # elements of one set count for no pair
    row, column = row[on], column[on]
    new = np.unique(column)
    column = np.searchsorted(new, column)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = np.zeros((len(sets), len(sets)), np.float32)
    for a in range(0, len(new), 2048):
        low, high = np.searchsorted(column, [a, a + 2048])
        member = np.zeros((len(sets), 2048), np.float32)
        member[row[low:high], column[low:high] - a] = 1
        total += member @ member.T
    return total[x, y].astype(np.int64)


def _least(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The least member of each of ``n`` nodes' components over links (x, y)."""
    label = np.arange(n)
    while len(x):
        low = np.minimum(label[x], label[y])
        old = label.copy()
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        label = label[label]
        if (label == old).all():
            break
    return label


def linked(rows: DataFrame, table: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(node, links, root): a part of a node's number of linked documents, and the least node it is linked with there.

    ``rows`` (key, node) come from ``reached``.
    """
    homes = rows.groupBy("node").agg(F.sort_array(F.collect_set("key")).alias("homes"))
    nodes = stored(homes, "candidate-nodes")  # a node has as many keys as its prefix has shingles at most
    sets = stored(full_sets(docs, nodes, words), "sets")
    tasks = dealt(rows.join(table.select("node", "n"), "node"), True)
    full = tasks.join(nodes, "node").join(table.select("node", "counts", "weight"), "node").join(sets, "node")
    full = full.select("grp", "key", "i", "j", "side", "node", "n", "counts", "weight", "homes", "shingles")

    def verify(group: pa.Table) -> pa.Table:
        out = []
        for part, one, two in _parts(group):
            x, y = _candidates(part, one, two, percent)
            if not len(x):
                continue
            n, node, weight = (part.column(c).to_numpy() for c in ("n", "node", "weight"))
            sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in part.column("shingles")]
            on = _enough(exact_overlaps(sets, x, y), n[x] + n[y], percent)
            x, y = x[on], y[on]
            root = node[_least(len(node), x, y)]  # rows are in the order of their nodes
            first = _first_home(part.column("homes").to_pylist(), part.column("key")[0].as_py(), x, y)
            links = np.bincount(x[first], weight[y[first]], len(node)) + np.bincount(y[first], weight[x[first]], len(node))
            at = np.unique(np.concatenate([x, y]))
            out.append((node[at], links[at].astype(np.int64), root[at]))
        columns = [np.concatenate([np.zeros(0, np.int64), *c]) for c in (zip(*out) if out else ([], [], []))]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["node", "links", "root"])

    return full.groupBy("grp").applyInArrow(verify, "node bigint, links bigint, root bigint")


def _first_home(homes: list[list[int]], key: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which pairs have no block before ``key`` in common."""
    before = [[k for k in h if k < key] for h in homes]
    number = {k: i for i, k in enumerate(sorted({k for h in before for k in h}))}
    out = np.ones(len(x), bool)
    if number:
        at = np.full((len(homes), max(len(h) for h in before)), -1)
        for i, h in enumerate(before):
            at[i, : len(h)] = [number[k] for k in h]
        both = np.flatnonzero((at[x, 0] >= 0) & (at[y, 0] >= 0))
        for part in np.array_split(both, 1 + len(both) * at.shape[1] ** 2 // (1 << 22)):
            a, b = at[x[part]], at[y[part]]
            out[part] = ~((a[:, :, None] == b[:, None, :]) & (a[:, :, None] >= 0)).any(axis=(1, 2))
    return out


def ngram_join(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(id, ``n_shingles``, ``component_id``, ``n_links``), one row per row of ``docs``.

    ``component_id`` is the least id reachable over links, the row's own
    included, and ``n_links`` the number of other rows that the row links with.
    Null, empty or white-space text has no shingles and links with
    nothing; rows of equal sets link, whatever their ids; rows with a null id
    link too, and their component is null if all its ids are. An empty table
    gives an empty result.
    """
    ship(docs.sparkSession)
    docs = docs.select(docs[id_column].alias("_id"), docs[text_column].alias("_text"))
    found = stored(points(docs, words, percent), "points")
    weights = found.where("node is not null").groupBy("node").agg(F.count("*").alias("weight"))
    table = found.where("counts is not null").select("node", "n", "counts").dropDuplicates(["node"])
    table = stored(table.join(weights, "node"), "nodes")

    # shingles that the prefixes of two nodes share, with two pivots each
    other = F.col("node").bitwiseXOR(F.col("key"))
    keys = found.where("counts is not null").select("node", F.explode("prefix").alias("key"))
    shared = keys.groupBy("key").agg(F.min(other).alias("lo"), F.max(other).alias("hi")).where("lo <> hi")
    shared = stored(shared, "shared")
    bits = bitmap(shared, "key")
    keep = docs.sparkSession.sparkContext.broadcast(bits)  # at most MAX_BITS

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("prefix")
            flat = lists.flatten().to_numpy()
            row = np.repeat(np.arange(b.num_rows), np.diff(lists.offsets.to_numpy()))
            on = in_bitmap(keep.value, flat)
            yield pa.RecordBatch.from_arrays([pa.array(b.column("node").to_numpy()[row[on]]), pa.array(flat[on])], names=["node", "key"])

    members = found.where("counts is not null").select("node", "prefix").mapInArrow(hits, "node bigint, key bigint").join(shared, "key").distinct()
    members = stored(members, "members")

    # which blocks are searched together
    pivots = F.explode(F.array(F.col("lo").bitwiseXOR(F.col("key")), F.col("hi").bitwiseXOR(F.col("key"))))
    stars = members.select(F.col("node").alias("a"), pivots.alias("b")).where("a <> b")
    stars = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    near = stored(bounded(stars, table, percent), "star-links")
    labels = stored(components(near), "star-components")
    blocks = members.select("key", "node").join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
    blocks = stored(merged(blocks), "blocks")

    # the search
    rows = stored(reached(blocks, table, percent), "reached")
    links = stored(linked(rows, table, docs, words, percent), "links")
    labels = stored(components(links.select(F.col("node").alias("a"), F.col("root").alias("b"))), "components")
    number = links.groupBy("node").agg(F.sum("links").alias("links"))
    nodes = table.select("node", "weight").join(labels, "node", "left").join(number, "node", "left")
    nodes = nodes.select("node", F.coalesce("label", "node").alias("label"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))

    rows = found.select("_id", "n", "node").join(nodes, "node", "left")
    least = rows.where("n > 0").groupBy("label").agg(F.min("_id").alias("least"))
    rows = rows.withColumn("label", F.coalesce("label", F.xxhash64("_id")))
    out = rows.join(least, "label", "left")
    component = F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("_id"))
    return out.select(F.col("_id").alias(id_column), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))
