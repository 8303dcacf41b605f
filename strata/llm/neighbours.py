"""Approximate nearest neighbours by cross-polytope hashing.

A pseudo-rotation is three rounds of random signs and a fast Hadamard transform.
It takes a unit vector to a point whose largest coordinate names the nearest of
the ``2 d`` signed axes: that axis is the vector's bucket in a table (``depth``
axes of as many rotations together, so that a bucket has about ``BUCKET`` rows
whatever the table's size). A query looks into its ``probes`` likeliest buckets
over all tables, those along whose axes its rotated coordinates are greatest.
Candidates of a bucket are reranked by their exact inner product where they meet
the query, and only the best of a bucket travel on.

``probes`` is fitted: for ``SAMPLE`` queries the true neighbours are found by a
scan of all rows, and the least number of buckets that holds ``recall`` of them
is taken. All rows are indexed. Queries that find fewer than ``k`` candidates are
compared with all rows.

Equal vectors are one node with its ``k + 1`` smallest ids, so a bucket of copies
is one row. A bucket of many different vectors is cut into tiles of about
``TILE`` by ``QUERY_TILE``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import ship, stored
from strata.llm.vectors import dimension, matrix

TABLES = 8
ROUNDS = 3
BUCKET = 256
RECALL = 0.95
SAMPLE = 128
TILE = 4096
QUERY_TILE = 1024
REACH = 32  # axes of a rotation that the probes of a table of several rotations combine


def hadamard(x: np.ndarray) -> np.ndarray:
    """The orthonormal Walsh-Hadamard transform of each row (a power of two long)."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
        h *= 2
    return x.reshape(n, d) / np.sqrt(d)


class CrossPolytope:
    """``tables`` hash functions of ``depth`` pseudo-rotations each, for vectors of ``dim`` components."""

    def __init__(self, dim: int, tables: int, depth: int, seed: int = 12):
        self.dim, self.tables, self.depth = dim, tables, depth
        self.size = 1 << max(dim - 1, 0).bit_length()
        self.signs = np.random.default_rng(seed).choice(np.array([-1.0, 1.0]), (tables, depth, ROUNDS, self.size))

    def rotated(self, x: np.ndarray, table: int, level: int) -> np.ndarray:
        y = np.zeros((len(x), self.size))
        y[:, : self.dim] = x
        for signs in self.signs[table, level]:
            y = hadamard(y * signs)
        return y

    def buckets(self, x: np.ndarray) -> np.ndarray:
        """The bucket of each row in each table."""
        out = np.zeros((len(x), self.tables), np.int64)
        for t in range(self.tables):
            for level in range(self.depth):
                y = self.rotated(x, t, level)
                axis = np.abs(y).argmax(axis=1)
                out[:, t] = out[:, t] * (2 * self.size) + 2 * axis + (y[np.arange(len(y)), axis] < 0)
        return out

    def ranked(self, x: np.ndarray, probes: int) -> tuple[np.ndarray, np.ndarray]:
        """(table, bucket) of each row's ``probes`` likeliest buckets, best first."""
        gains, names = [], []
        for t in range(self.tables):
            gain, name = np.zeros((len(x), 1)), np.zeros((len(x), 1), np.int64)
            for level in range(self.depth):
                y = self.rotated(x, t, level)
                y = np.stack([y, -y], axis=2).reshape(len(x), -1)
                axes = np.argsort(-y, axis=1, kind="stable")[:, : y.shape[1] if self.depth == 1 else REACH]
                gain = (gain[:, :, None] + np.take_along_axis(y, axes, axis=1)[:, None, :]).reshape(len(x), -1)
                name = (name[:, :, None] * (2 * self.size) + axes[:, None, :]).reshape(len(x), -1)
            gains.append(gain)
            names.append(name)
        table = np.repeat(np.arange(self.tables), gains[0].shape[1])
        gain, name = np.concatenate(gains, axis=1), np.concatenate(names, axis=1)
        order = np.argsort(-gain, axis=1, kind="stable")[:, :probes]
        return table[order], np.take_along_axis(name, order, axis=1)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length 1; scaled first, so that squares neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def depth(rows: int, dim: int) -> int:
    """Rotations of a table: one more whenever a bucket would have over ``BUCKET`` rows times the axes of one."""
    axes = 2 << max(dim - 1, 0).bit_length()
    n, rows = 1, rows / (axes * BUCKET)
    while rows >= axes:
        n, rows = n + 1, rows / axes
    return n


def _floats(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors of a binary column."""
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, dim) if len(column) else np.zeros((0, dim))


def nodes_of(rows: DataFrame, vector_column: str, id_column: str, asks: Column, dim: int, k: int) -> DataFrame:
    """(node, vector, ids, asks): each different vector, its ``k + 1`` smallest ids, and whether a query has it.

    A batch's copies are made one row before the shuffle.
    """
    kind = rows.schema[id_column].dataType.simpleString()
    member = f"struct<none:boolean,id:{kind}>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, whole = matrix(b.column("_v"), dim)
            at = np.flatnonzero(whole & x.any(axis=1))
            x = np.ascontiguousarray(x[at] + 0.0)  # no negative zeros
            held: dict[bytes, list] = {}
            for i, v in zip(at.tolist(), x):
                held.setdefault(v.tobytes(), []).append(i)
            ids, ask = b.column("_id").to_pylist(), b.column("_asks").to_pylist()
            members = [sorted(((ids[i] is None, ids[i]) for i in g), key=lambda m: (m[0], m[1] if m[1] is not None else 0))[: k + 1] for g in held.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.binary()), pa.array([[{"none": a, "id": i} for a, i in m] for m in members], pa.list_(pa.struct([("none", pa.bool_()), ("id", b.schema.field("_id").type)]))), pa.array([any(ask[i] for i in g) for g in held.values()], pa.bool_())],
                names=["vector", "ids", "asks"],
            )

    rows = rows.select(F.col(vector_column).alias("_v"), F.col(id_column).alias("_id"), F.coalesce(asks, F.lit(False)).alias("_asks"))
    found = rows.mapInArrow(run, f"vector binary, ids array<{member}>, asks boolean").groupBy("vector")
    found = found.agg(F.slice(F.sort_array(F.flatten(F.collect_list("ids"))), 1, k + 1).alias("ids"), F.max("asks").alias("asks"))
    return stored(found.withColumn("node", F.monotonically_increasing_id()), "ann-nodes")


def _pairs(q: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, inner product) of each query's ``k`` best rows, and ties of the last up to rounding.

    The products given are summed a pair at a time, alike wherever a pair meets.
    """
    s = q @ x.T
    if s.shape[1] > k:
        low = np.partition(s, s.shape[1] - k, axis=1)[:, -k]
        # as much as two ways of summing may differ
        off = 1e-14 * q.shape[1] * np.sqrt((q * q).sum(axis=1)) * np.sqrt((x * x).sum(axis=1).max())
        i, j = np.nonzero(s >= (low - off)[:, None])
    else:
        i, j = np.nonzero(np.ones(s.shape, bool))
    return i, j, np.concatenate([np.zeros(0), *((q[a] * x[b]).sum(axis=1) for a, b in zip(np.array_split(i, 1 + len(i) // 65536), np.array_split(j, 1 + len(j) // 65536)))])


_FOUND = "q bigint, node bigint, score double, ids {}"


def scanned(nodes: DataFrame, queries: list, dim: int, k: int) -> DataFrame:
    """(q, node, score, ids): the ``k`` best nodes of each task for given query nodes, which are broadcast."""
    spark = nodes.sparkSession
    shared = spark.sparkContext.broadcast(([r.node for r in queries], np.array([np.frombuffer(bytes(r.vector), "<f8") for r in queries])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, q = shared.value
        for b in batches:
            if b.num_rows:
                i, j, s = _pairs(q, _floats(b.column("vector"), dim), k)
                yield pa.RecordBatch.from_arrays([pa.array(np.array(names)[i]), b.column("node").take(pa.array(j)), pa.array(s), b.column("ids").take(pa.array(j))], names=["q", "node", "score", "ids"])

    return nodes.select("node", "vector", "ids").mapInArrow(run, _FOUND.format(nodes.schema["ids"].dataType.simpleString()))


def fitted(nodes: DataFrame, hashing: CrossPolytope, k: int, recall: float, sample: int) -> int:
    """Buckets that a query must look into for ``recall`` of the true neighbours of a sample of queries."""
    asks = nodes.where("asks").select("node", "vector").orderBy(F.xxhash64("vector"), "node").limit(sample).collect()
    if not asks:
        return hashing.tables
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), "node")
    best = scanned(nodes, asks, hashing.dim, k + 1).where("q <> node").withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k)
    rows = best.select("q", "node").join(nodes.select("node", "vector"), "node").select("q", "vector").collect()  # sample times k
    if not rows:
        return hashing.tables
    at = {r.node: i for i, r in enumerate(asks)}
    own = hashing.buckets(unit(np.array([np.frombuffer(bytes(r.vector), "<f8") for r in rows])))
    limit = hashing.tables * ((2 * hashing.size) if hashing.depth == 1 else REACH**hashing.depth)
    table, bucket = hashing.ranked(unit(np.array([np.frombuffer(bytes(r.vector), "<f8") for r in asks])), limit)
    first = []
    for r, buckets in zip(rows, own):
        i = at[r.q]
        hit = np.flatnonzero(buckets[table[i]] == bucket[i])
        first.append(int(hit[0]) + 1 if len(hit) else limit)
    first.sort()
    return max(hashing.tables, first[min(len(first) - 1, int(np.ceil(recall * len(first))) - 1)])


def probed(nodes: DataFrame, hashing: CrossPolytope, probes: int, k: int) -> DataFrame:
    """(q, node, score, ids): the ``k`` best nodes of each tile of each bucket that a query looks into."""
    kind = nodes.schema["ids"].dataType.simpleString()

    def hashed(probes: int):  # noqa: ANN202
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for b in (whole.slice(i, 1024) for i in range(0, whole.num_rows, 1024)):
                    x = unit(_floats(b.column("vector"), hashing.dim))
                    if probes:
                        table, bucket = hashing.ranked(x, probes)
                    else:
                        bucket = hashing.buckets(x)
                        table = np.broadcast_to(np.arange(hashing.tables), bucket.shape)
                    rows = b.take(pa.array(np.repeat(np.arange(b.num_rows), bucket.shape[1])))
                    yield pa.RecordBatch.from_arrays([pa.array(table.ravel().astype(np.int32)), pa.array(bucket.ravel()), *rows.columns], names=["tbl", "bucket", *rows.schema.names])

        return run

    index = nodes.select("node", "vector", "ids").mapInArrow(hashed(0), f"tbl int, bucket bigint, node bigint, vector binary, ids {kind}")
    looks = nodes.where("asks").select("node", "vector").mapInArrow(hashed(probes), "tbl int, bucket bigint, node bigint, vector binary")
    sizes = index.groupBy("tbl", "bucket").agg(F.count("*").alias("nx"))
    sizes = sizes.join(looks.groupBy("tbl", "bucket").agg(F.count("*").alias("nq")), ["tbl", "bucket"])  # buckets that someone looks into
    sizes = stored(sizes.select("tbl", "bucket", F.ceil(F.col("nx") / TILE).alias("tx"), F.ceil(F.col("nq") / QUERY_TILE).alias("tq")), "ann-buckets")
    spread = lambda tiles, salt: F.pmod(F.xxhash64("node", F.lit(salt)), F.col(tiles))
    every = lambda tiles: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(tiles) - 1))
    index = index.join(sizes, ["tbl", "bucket"]).withColumn("x", spread("tx", 1)).withColumn("y", every("tq"))
    looks = looks.join(sizes, ["tbl", "bucket"]).withColumn("y", spread("tq", 2)).withColumn("x", every("tx"))
    columns = ["tbl", "bucket", "x", "y", "node", "vector"]
    both = index.select(*columns, "ids").unionByName(looks.select(*columns, F.lit(None).cast(kind).alias("ids")))

    def meet(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        query = group.column("ids").is_null()
        one, two = group.filter(query).combine_chunks(), group.filter(pc.invert(query)).combine_chunks()
        i, j, s = _pairs(_floats(one.column("vector"), hashing.dim), _floats(two.column("vector"), hashing.dim), k)
        return pa.table([one.column("node").take(pa.array(i)), two.column("node").take(pa.array(j)), pa.array(s), two.column("ids").take(pa.array(j))], names=["q", "node", "score", "ids"])

    return both.groupBy("tbl", "bucket", "x", "y").applyInArrow(meet, _FOUND.format(kind))


def _lists(found: DataFrame, k: int) -> DataFrame:
    """(q, best): the first ``k + 1`` rows (score, node, none, id) of each query node, its own among them."""
    rows = found.repartition("q").dropDuplicates(["q", "node"]).select("q", "node", "score", F.explode("ids").alias("m")).select("q", "node", "score", "m.none", "m.id")
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), "none", "id", "node")
    rows = rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    return rows.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("n", "score", "node", "none", "id"))).alias("best"))


def nearest(
    rows: DataFrame, asks: Column, k: int, id_column: str = "vec_id", vector_column: str = "embedding",
    tables: int = TABLES, recall: float = RECALL, sample: int = SAMPLE, probes: int | None = None, levels: int | None = None,
) -> DataFrame:
    """(query id, ``rank``, ``id``, ``score``): the ``k`` rows of greatest inner product found for each row where ``asks``.

    The query's own row is no candidate. Equal scores rank by ascending id, null
    ids last. Vectors that are null, zero, or hold a null or non-finite component
    take no part; shorter ones count as padded with zeros. A row without an id is
    a candidate and no query. A repeated row is a row of its own; an id that
    repeats with other vectors asks for each. Extra columns are ignored; an empty
    table gives an empty result. ``probes`` and ``levels`` are fitted if not given.
    """
    spark = rows.sparkSession
    ship(spark)
    kind = rows.schema[id_column].dataType.simpleString()
    empty = spark.createDataFrame([], f"query_id {kind}, rank int, id {kind}, score double")
    dim = dimension(rows, vector_column)
    if not dim:
        return empty
    asks = asks & F.col(id_column).isNotNull()
    nodes = nodes_of(rows, vector_column, id_column, asks, dim, k)
    n = nodes.count()
    hashing = CrossPolytope(dim, tables, levels or depth(n, dim))
    probes = probes or fitted(nodes, hashing, k, recall, sample)
    lists = stored(_lists(probed(nodes, hashing, probes, k + 1), k), "ann-lists")
    # those that found too few are compared with all rows, some at a time
    few = nodes.where("asks").select("node", "vector").join(lists.where(F.size("best") > k).select(F.col("q").alias("node")), "node", "left_anti")
    few = stored(few, "ann-few")
    blocks = -(-few.count() // QUERY_TILE)
    for b in range(blocks if n > 1 else 0):
        part = few.where(F.pmod(F.xxhash64("node"), F.lit(blocks)) == b).collect()  # about QUERY_TILE
        if part:
            more = _lists(scanned(nodes, part, dim, k + 1), k)
            lists = lists.join(more.select("q"), "q", "left_anti").unionByName(more)
    return _ranked(rows, nodes, lists, asks, id_column, vector_column, dim, k)


def _ranked(rows: DataFrame, nodes: DataFrame, lists: DataFrame, asks: Column, id_column: str, vector_column: str, dim: int, k: int) -> DataFrame:
    """Each query row with the list of its node, without itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, whole = matrix(b.column("_v"), dim)
            at = np.flatnonzero(whole & x.any(axis=1))
            vectors = [v.tobytes() for v in np.ascontiguousarray(x[at] + 0.0)]
            yield pa.RecordBatch.from_arrays([b.column("query_id").take(pa.array(at)), pa.array(vectors, pa.binary())], names=["query_id", "vector"])

    kind = rows.schema[id_column].dataType.simpleString()
    queries = rows.where(asks).select(F.col(vector_column).alias("_v"), F.col(id_column).alias("query_id")).mapInArrow(run, f"query_id {kind}, vector binary")
    queries = queries.join(nodes.where("asks").select("vector", F.col("node").alias("q")), "vector").join(lists, "q")
    same = F.transform("best", lambda m: (m["node"] == F.col("q")) & (m["id"] == F.col("query_id")))
    own = F.array_position(same, F.lit(True))  # 0: not among them
    left = F.filter("best", lambda m, i: i + 1 != F.col("own"))
    out = queries.select("query_id", "best", own.alias("own")).select("query_id", F.posexplode(F.slice(left, 1, k)).alias("rank", "m"))
    return out.select("query_id", (F.col("rank") + 1).alias("rank"), F.col("m.id").alias("id"), F.col("m.score").alias("score"))
