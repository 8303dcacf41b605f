"""Ranked lexical search by pipelined term partitioning.

The index is partitioned by term: each owner holds the postings of its terms,
cut into shards of documents. A bundle of an item carries a sparse accumulator
of scores for a shard's documents through the owners, one stage after another;
a stage cogroups the bundles of a shard with the owner's postings of it and adds
integer contributions. The last stage selects.

Terms are owned by the share of documents that hold them, rare ones first
(``OWNERS``). That order allows an exact cut between stages: an item's ``k``-th
best score so far never exceeds its last one, so an accumulator that cannot
reach it with the most that the item's other terms give is dropped. What remains
to travel is little, whatever the number of documents.

Items are worked on in blocks of about ``BLOCK_TERMS`` terms, which are
broadcast; the texts are scanned once for each block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import Words, ship, slices, stored, text_buffer

BEST = 50
OWNERS = (0.01, 0.05, 0.15)  # shares of documents at which the terms of the next owner begin
SHARD_DOCS = 8192
SHARD_POSTINGS = 1 << 20
BLOCK_TERMS = 1 << 18  # of the items that one scan serves
GROUP_ITEMS = 256  # whose bundles meet a shard's postings in one group

# ASCII letters and digits, and all bytes of other characters
_KINDS = np.zeros(256, np.uint8)
_KINDS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1

_POSTINGS = "shard bigint, term bigint, df bigint, max_tf bigint, min_n bigint, place binary, tf binary, n binary, docs bigint, total bigint"
_BUNDLE = "shard bigint, grp bigint, item bigint, place binary, score binary"


def item_terms(items: DataFrame, item_column: str, text_column: str) -> DataFrame:
    """(item, term): the distinct terms, as 64-bit hashes, of each item id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "_text"):
                words = Words(*text_buffer(b.column("_text")), kinds=_KINDS)
                row = np.repeat(np.arange(b.num_rows), np.diff(words.first))
                yield pa.RecordBatch.from_arrays([b.column("item").take(pa.array(row)), pa.array(words.hash.view(np.int64))], names=["item", "term"])

    rows = items.select(items[text_column].alias("_text"), items[item_column].alias("item")).where("item is not null and _text is not null")
    return rows.mapInArrow(run, f"item {rows.schema['item'].dataType.simpleString()}, term bigint").distinct()


class Block:
    """Items of a block: their ids and terms, as numbers into the sorted ``terms``."""

    def __init__(self, rows: list) -> None:
        by_item: dict = {}
        for item, term in rows:
            by_item.setdefault(item, []).append(term)
        self.ids = sorted(by_item)
        self.terms = np.unique(np.array([t for _, t in rows], np.int64))
        self.of = [np.searchsorted(self.terms, np.unique(np.array(by_item[i], np.int64))) for i in self.ids]
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(self.terms.view(np.uint64) >> np.uint64(44)).astype(np.int64)] = True

    def found(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of ``hashes`` that are terms of the block, and which."""
        may = np.flatnonzero(self.filter[(hashes >> np.uint64(44)).astype(np.int64)])
        keys = hashes[may].view(np.int64)
        at = np.minimum(np.searchsorted(self.terms, keys), len(self.terms) - 1)
        on = self.terms[at] == keys
        return may[on], at[on]


def blocks(terms: DataFrame, block_terms: int) -> Iterator[Block]:
    """The items, a bounded share of them at a time."""
    n = 1 + terms.count() // block_terms
    for k in range(n):
        rows = terms.where(F.pmod(F.xxhash64("item"), F.lit(n)) == k).collect()  # about block_terms
        if rows:
            yield Block([tuple(r) for r in rows])


def postings(docs: DataFrame, shared, shard_docs: int, shard_postings: int) -> DataFrame:  # noqa: ANN001
    """Postings of the block's terms by shard, and a row for each shard (null ``term``) with its ids.

    A shard is a run of a task's documents. ``place`` is a document's number in
    it, ``tf`` how often it holds the term, ``n`` its terms with repeats.
    """
    kind = docs.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Block = shared.value
        task, number = TaskContext.get().partitionId(), 0
        ids: list[pa.Array] = []
        sizes: list[np.ndarray] = []
        held: list[tuple[np.ndarray, ...]] = []
        docs_held = posted = 0

        def shard() -> pa.RecordBatch:
            name = (task << 32) + number
            n = np.concatenate(sizes)
            place, term, tf = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*held) if held else ([], [], [])))
            order = np.argsort(term, kind="stable")
            place, term, tf = place[order], term[order], tf[order]
            begin = np.flatnonzero(np.append(True, term[1:] != term[:-1])[: len(term)])
            ends = np.append(begin[1:], len(term))[: len(begin)]
            each = list(zip(begin.tolist(), ends.tolist()))
            of = n[place]
            cut = lambda x, t: [x[a:z].astype(t).tobytes() for a, z in each] + [None]
            longs = lambda x: pa.array([*x, None], pa.int64())
            count = len(each)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * (count + 1), pa.int64()), longs(block.terms[term[begin]].tolist()), longs((ends - begin).tolist()),
                    longs(np.maximum.reduceat(tf, begin).tolist() if count else []), longs(np.minimum.reduceat(of, begin).tolist() if count else []),
                    pa.array(cut(place, np.uint16), pa.binary()), pa.array(cut(tf, np.uint32), pa.binary()), pa.array(cut(of, np.uint32), pa.binary()),
                    pa.array([None] * count + [int(np.count_nonzero(n))], pa.int64()), pa.array([None] * count + [int(n.sum())], pa.int64()),
                    pa.array([None] * count + [pa.concat_arrays(ids).to_pylist()], pa.list_(ids[0].type)),
                ],
                names=[*(c.split()[0] for c in _POSTINGS.split(", ")), "ids"],
            )

        for whole in batches:
            for b in slices(whole, "_text"):
                for part in (b.slice(i, shard_docs) for i in range(0, b.num_rows, shard_docs)):
                    if docs_held and (docs_held + part.num_rows > shard_docs or posted >= shard_postings):
                        yield shard()
                        number, docs_held, posted = number + 1, 0, 0
                        ids, sizes, held = [], [], []
                    words = Words(*text_buffer(part.column("_text")), kinds=_KINDS)
                    at, term = block.found(words.hash)
                    row = np.searchsorted(words.first, at, "right") - 1
                    key, tf = np.unique(row * len(block.terms) + term, return_counts=True)
                    held.append((key // len(block.terms) + docs_held, key % len(block.terms), tf))
                    ids.append(part.column("_id"))
                    sizes.append(np.diff(words.first))
                    docs_held, posted = docs_held + part.num_rows, posted + len(key)
        if docs_held:
            yield shard()

    return docs.mapInArrow(run, f"{_POSTINGS}, ids array<{kind}>")


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def length_factor(n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """``100 - 50 + 50 n N div L`` of each document, whatever the products' size."""
    if 50 * docs * int(n.max(initial=0)) < 2**63:
        return 50 + (50 * n.astype(np.int64) * docs) // total
    return np.array([50 + 50 * int(x) * docs // total for x in n.tolist()], np.int64)


def saturation(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    tf = tf.astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


class Plan:
    """What the stages of a block share: weights, owners, and what an item's terms can still give."""

    def __init__(self, block: Block, docs: int, total: int, stats: dict, owners: tuple[float, ...]):
        self.block, self.docs, self.total = block, docs, total
        self.weight = np.zeros(len(block.terms), np.int64)
        most = np.zeros(len(block.terms), np.int64)
        self.owner = np.full(len(block.terms), -1)  # -1: in no document
        for k, t in enumerate(block.terms.tolist()):
            if t in stats:
                df, tf, n = stats[t]
                self.weight[k] = weight(docs, df)
                most[k] = self.weight[k] * int(saturation(np.array([tf]), length_factor(np.array([n]), docs, total))[0])
                self.owner[k] = int(np.searchsorted(owners, df / docs, "right"))
        self.least = np.zeros(len(block.ids), np.int64)  # score that an item's document must reach
        self.rest = np.array([[int(most[of][self.owner[of] > s].sum()) for s in range(len(owners) + 1)] for of in block.of], np.int64).reshape(len(block.ids), -1)

    def cut(self, item: int, stage: int, place: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Accumulators that may still be among an item's best after ``stage``."""
        on = score + self.rest[item, stage] >= max(1, int(self.least[item]))
        return place[on], score[on]


def _bundles(rows: list[tuple[int, int, int, np.ndarray, np.ndarray]]) -> pa.Table:
    columns = list(zip(*((s, g, i, p.astype(np.uint16).tobytes(), v.astype(np.int64).tobytes()) for s, g, i, p, v in rows))) or [[]] * 5
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=["shard", "grp", "item", "place", "score"])


def advance(bundles: DataFrame, owned: DataFrame, shared, stage: int, k: int | None = None, kind: str | None = None) -> DataFrame:  # noqa: ANN001
    """A stage: bundles (``_BUNDLE``) meet the owner's postings of their shard.

    With ``k`` it is the last one, ``owned`` has the shards' ids too, and the
    ``k`` best of each item and shard come out as (item, shard, place, id, score).
    """

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        plan: Plan = shared.value
        shard = (left if left.num_rows else right).column("shard")[0].as_py()
        grp = (left if left.num_rows else right).column("grp")[0].as_py()
        have = dict(zip(left.column("item").to_pylist(), zip(left.column("place").to_pylist(), left.column("score").to_pylist())))
        given: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        ids = None
        for t, place, tf, n, names in zip(*(right.column(c).to_pylist() for c in ("term", "place", "tf", "n", "ids"))):
            if t is None:
                ids = names
                continue
            t = int(np.searchsorted(plan.block.terms, t))
            m = length_factor(np.frombuffer(n, np.uint32), plan.docs, plan.total)
            given[t] = np.frombuffer(place, np.uint16), plan.weight[t] * saturation(np.frombuffer(tf, np.uint32), m)
        out, best = [], []
        total = np.zeros(1 << 16, np.int64)
        for item in range(grp * GROUP_ITEMS, min((grp + 1) * GROUP_ITEMS, len(plan.block.ids))):
            terms = [given[t] for t in plan.block.of[item].tolist() if t in given]
            if not terms and item not in have:
                continue
            total[:] = 0
            if item in have:
                place, score = have[item]
                total[np.frombuffer(place, np.uint16)] = np.frombuffer(score, np.int64)
            for place, score in terms:
                total[place] += score  # a document once a term
            place = np.flatnonzero(total)
            place, score = plan.cut(item, stage, place, total[place])
            if not len(place):
                continue
            if k is None:
                out.append((shard, grp, item, place, score))
                continue
            if len(place) > k:
                low = np.partition(score, len(score) - k)[-k]
                place, score = place[score >= low], score[score >= low]
            rows = sorted(zip((-score).tolist(), ((ids[p] is None, ids[p], p) for p in place.tolist())), key=lambda r: (r[0], r[1][0], r[1][1] if r[1][1] is not None else 0, r[1][2]))
            best += [(item, shard, p, name, -s) for s, (_, name, p) in rows[:k]]
        if k is None:
            return _bundles(out)
        columns = list(zip(*best)) or [[]] * 5
        ids_type = right.schema.field("ids").type.value_type
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), ids_type, pa.int64()))], names=["item", "shard", "place", "id", "score"])

    schema = _BUNDLE if k is None else f"item bigint, shard bigint, place bigint, id {kind}, score bigint"
    return bundles.groupBy("shard", "grp").cogroup(owned.groupBy("shard", "grp")).applyInArrow(meet, schema)


def kept(bundles: DataFrame, shared, stage: int) -> DataFrame:  # noqa: ANN001
    """Bundles without the accumulators that the present bounds rule out, before they travel."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan: Plan = shared.value
        for b in batches:
            rows = []
            for shard, grp, item, place, score in zip(*(b.column(c).to_pylist() for c in ("shard", "grp", "item", "place", "score"))):
                p, s = plan.cut(item, stage, np.frombuffer(place, np.uint16), np.frombuffer(score, np.int64))
                if len(p):
                    rows.append((shard, grp, item, p, s))
            yield from _bundles(rows).to_batches()

    return bundles.mapInArrow(run, _BUNDLE)


def bounds(bundles: DataFrame, k: int) -> DataFrame:
    """(item, score): the ``k``-th best score that an item has so far; items with fewer have no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, np.ndarray] = {}
        for b in batches:
            for item, score in zip(b.column("item").to_pylist(), b.column("score")):
                s = np.append(best.get(item, np.zeros(0, np.int64)), np.frombuffer(score.as_buffer(), np.int64))
                best[item] = np.partition(s, len(s) - k)[-k:] if len(s) > k else s
        for item, s in best.items():  # k scores a task and item
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), item)), pa.array(s)], names=["item", "score"])

    order = Window.partitionBy("item").orderBy(F.col("score").desc())
    found = bundles.select("item", "score").mapInArrow(run, "item bigint, score bigint")
    return found.withColumn("_n", F.row_number().over(order)).where(F.col("_n") == k).select("item", "score")


def lexical_search(
    docs: DataFrame, items: DataFrame, k: int = BEST, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text",
    owners: tuple[float, ...] = OWNERS, shard_docs: int = SHARD_DOCS, shard_postings: int = SHARD_POSTINGS, block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """(item, ``rank``, id, ``score``): each item's ``k`` best documents of those with a score above 0.

    Equal scores rank by ascending id, null ids last. Rows of one item id are one
    item with the terms of all; items without an id or a term, and documents that
    are null or without a term, are in no result (the latter do not count as
    documents). Repeated documents count and rank as rows of their own. Extra
    columns are ignored; an empty table gives an empty result.
    """
    if shard_docs > 1 << 16:
        raise ValueError("a shard has 65,536 documents at most")
    spark = docs.sparkSession
    ship(spark)
    kinds = items.schema[item_column].dataType, docs.schema[id_column].dataType.simpleString()
    rows = docs.select(docs[text_column].alias("_text"), docs[id_column].alias("_id"))
    terms = stored(item_terms(items, item_column, item_text), "search-terms")
    found = []
    for block in blocks(terms, block_terms):
        index = stored(postings(rows, spark.sparkContext.broadcast(block), shard_docs, shard_postings), "search-postings")
        docs_n, total = index.where("term is null").agg(F.sum("docs"), F.sum("total")).first()
        if not docs_n:
            continue
        stats = index.where("term is not null").groupBy("term").agg(F.sum("df"), F.max("max_tf"), F.min("min_n")).collect()  # block_terms rows at most
        plan = Plan(block, docs_n, total, {r[0]: tuple(r)[1:] for r in stats}, owners)
        groups = -(-len(block.ids) // GROUP_ITEMS)
        uses = sorted({(int(block.terms[t]), i // GROUP_ITEMS, int(plan.owner[t])) for i, of in enumerate(block.of) for t in of.tolist()})
        who = spark.createDataFrame(uses, "term bigint, grp bigint, owner int")
        columns = ["shard", "grp", "term", "place", "tf", "n"]
        bundles = spark.createDataFrame([], _BUNDLE)
        for stage in range(len(owners) + 1):
            shared = spark.sparkContext.broadcast(plan)
            owned = index.join(F.broadcast(who.where(F.col("owner") == stage)), "term").select(*columns, F.lit(None).cast(index.schema["ids"].dataType).alias("ids"))
            if stage < len(owners):
                bundles = stored(advance(kept(bundles, shared, stage - 1) if stage else bundles, owned, shared, stage), f"search-bundles-{stage}")
                for r in bounds(bundles, k).collect():  # a row an item of the block
                    plan.least[r.item] = r.score
            else:
                shards = index.where("term is null").withColumn("grp", F.explode(F.array(*[F.lit(g).cast("bigint") for g in range(groups)])))
                best = advance(kept(bundles, shared, stage - 1), owned.unionByName(shards.select(*columns, "ids")), shared, stage, k, kinds[1])
                names = spark.createDataFrame(list(enumerate(block.ids)), f"item bigint, item_name {kinds[0].simpleString()}")
                found.append(best.join(F.broadcast(names), "item").drop("item"))
    if not found:
        return spark.createDataFrame([], f"`{item_column}` {kinds[0].simpleString()}, rank int, `{id_column}` {kinds[1]}, score bigint")
    every = reduce(DataFrame.unionByName, found)
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("shard"), F.col("place")]
    # the best of 256 shares of the shards, then of these
    some = Window.partitionBy("item_name", F.pmod(F.xxhash64("shard"), F.lit(256))).orderBy(*order)
    every = every.withColumn("_n", F.row_number().over(some)).where(F.col("_n") <= k)
    every = every.withColumn("rank", F.row_number().over(Window.partitionBy("item_name").orderBy(*order))).where(F.col("rank") <= k)
    return every.select(F.col("item_name").alias(item_column), "rank", F.col("id").alias(id_column), "score")
