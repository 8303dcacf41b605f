"""Exact dedup by progressive refinement, in DataFrame operations only.

1. Count texts by length; a length that one row has needs no more work.
2. Of the rows of other lengths, hash the first characters and count by (length,
   hash).
3. Only rows of groups that still have two members get a full SHA-256, and
   only these digests are grouped.

Steps 1 and 2 shuffle counts (hot groups are summed before the shuffle). What
survives a step returns to the scan of the next one as a bitmap of bounded
size. For step 3 ``bits`` is the least power of two that gives ``BITS_PER_GROUP`` bits a
group, ``MAX_BITS`` at most. A false positive costs one more SHA-256; it never
changes a result. Texts are never shuffled unless carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stored
from strata.operators.bitmaps import bitmap_bits, key_bitmap, with_may_match

PREFIX_CHARS = 64
BITS_PER_GROUP = 16
MIN_BITS = 1 << 15
MAX_BITS = 1 << 25  # 4 MB of bitmap
_BUCKET = 1 << 15  # bits of a row that bitmap_construct_agg makes


def normalised(text: Column) -> Column:
    """``text`` with each run of white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _keys(text: Column) -> tuple[Column, Column]:
    return F.length(text), F.xxhash64(F.substring(text, 1, PREFIX_CHARS))


def _bit(length: Column, prefix: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(length, prefix), F.lit(bits))


def suspects(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> tuple[DataFrame, int]:
    """Steps 1 and 2: (length, prefix hash) groups of two rows or more, and their count."""
    measured = docs.select(normalised(F.col(text_column)).alias("_t")).withColumn("_n", F.length("_t"))
    lengths = measured.groupBy("_n").agg(F.count("*").alias("_c")).where("_c > 1").select("_n")
    lengths = stored(lengths, "exact-lengths")
    bits = bitmap_bits(lengths.count())
    some = with_may_match(measured, ["_n"], key_bitmap(lengths, ["_n"], bits), bits, "_l").where("_l")
    length, prefix = _keys(F.col("_t"))
    groups = some.select(length.alias("_n"), prefix.alias("_p")).groupBy("_n", "_p").agg(F.count("*").alias("_c"))
    found = groups.where("_c > 1").select("_n", "_p")
    found = stored(found, "exact-suspects")
    return found, found.count()


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", carry: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: its id, ``keep_id``, ``group_size``, ``kept``.

    ``carry`` names columns of ``docs`` that go along (none by default).
    ``full_hash`` is the SHA-256 of the normalised text where step 3 needed it,
    else null. Of equal texts the row with the smallest id stays. Null text
    equals empty text. Rows that repeat an id and a text count as rows of the
    group and share its decision; a null id counts in the group but stays only
    if all ids of the group are null. An empty table gives an empty result.
    """
    carry = [c for c in carry or [] if c != id_column]
    found, n = suspects(docs, id_column, text_column)
    bits = MIN_BITS
    while bits < min(MAX_BITS, n * BITS_PER_GROUP):
        bits *= 2
    place = _bit(F.col("_n"), F.col("_p"), bits)
    # bitmap positions count from 1
    bitmap = (
        found.select((place + 1).alias("_b"))
        .groupBy(F.bitmap_bucket_number("_b").alias("_bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_b")).alias("_map"))
    )
    length, prefix = _keys(F.col("_t"))
    rows = (
        docs.select(F.col(id_column).alias("_id"), *[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)], normalised(F.col(text_column)).alias("_t"))
        .withColumns({"_n": length, "_p": prefix})
        .withColumn("_b", place + 1)
        .withColumns({"_bucket": F.bitmap_bucket_number("_b"), "_at": F.bitmap_bit_position("_b")})
        .join(F.broadcast(bitmap), "_bucket", "left")
    )
    byte = F.conv(F.hex(F.expr("substring(_map, cast(_at div 8 as int) + 1, 1)")), 16, 10).cast("int")
    hit = F.getbit(byte, (F.col("_at") % 8).cast("int")) == 1
    hashed = rows.select(
        "_id",
        *[f"_c{i}" for i in range(len(carry))],
        F.when(hit, F.sha2(F.col("_t"), 256)).alias("full_hash"),
    )
    twins = hashed.where("full_hash is not null")
    sizes = twins.groupBy("full_hash").agg(F.min("_id").alias("keep_id"), F.count("*").alias("group_size")).where("group_size > 1")
    # a row without a digest is alone and, with what it carries, is not shuffled
    out = twins.join(stored(sizes, "exact-sizes"), "full_hash", "left")
    out = out.unionByName(hashed.where("full_hash is null"), allowMissingColumns=True)
    keep = F.when(F.col("group_size").isNull(), F.col("_id")).otherwise(F.col("keep_id"))
    return out.select(
        F.col("_id").alias(id_column),
        *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)],
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("_id").eqNullSafe(keep).alias("kept"),
        "full_hash",
    )
