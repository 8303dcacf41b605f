"""Bitmaps of key hashes: which rows may have a partner, told before a shuffle.

A set of keys becomes bits (one hash a key, ``BITS_PER_KEY`` bits for each), held
as rows of 4,096 bytes that Spark's bitmap functions build. Broadcast, they split
a large table into rows that surely have no partner among the keys and rows that
may have one. No row with a partner is ever among the former. The bitmap has
``MAX_BITS`` bits at most, so its size is bounded whatever the keys' number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import col

BITS_PER_KEY = 16
MIN_BITS = 1 << 15  # of one row of Spark's bitmaps
MAX_BITS = 1 << 27  # 16 MB
# Above so many keys more than a fifth of the bits are set and few rows are told apart.
MAX_KEYS = MAX_BITS // 4

_BUCKET, _MAP, _AT = "__bitmap_bucket", "__bitmap_map", "__bitmap_at"


def bitmap_bits(keys: int) -> int:
    """Bits of a bitmap of so many keys: a power of two."""
    bits = MIN_BITS
    while bits < min(MAX_BITS, BITS_PER_KEY * keys):
        bits *= 2
    return bits


def _place(columns: Sequence[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*[col(c) for c in columns]), F.lit(bits)) + 1  # bitmap positions count from 1


def key_bitmap(keys: DataFrame, columns: Sequence[str], bits: int) -> DataFrame:
    """The bitmap of the rows of ``columns``: one row for each 32,768 bits that has any set.

    The bits are merged within each task before the shuffle, so repeated keys
    and hot keys cost nothing more.
    """
    place = keys.select(_place(columns, bits).alias("p"))
    return place.groupBy(F.bitmap_bucket_number("p").alias(_BUCKET)).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias(_MAP))


def with_may_match(df: DataFrame, columns: Sequence[str], bitmap: DataFrame, bits: int, flag: str) -> DataFrame:
    """``df`` with ``flag``: false where the row's key is surely not among the bitmap's.

    Key types must be those of the bitmap's rows (a hash of an INT is not that of
    the BIGINT of the same value).
    """
    place = _place(columns, bits)
    rows = df.withColumns({_BUCKET: F.bitmap_bucket_number(place), _AT: F.bitmap_bit_position(place)})
    rows = rows.join(F.broadcast(bitmap), _BUCKET, "left")
    byte = F.conv(F.hex(F.expr(f"substring({_MAP}, cast({_AT} div 8 as int) + 1, 1)")), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, (F.col(_AT) % 8).cast("int")) == 1, F.lit(False))
    return rows.withColumn(flag, hit).drop(_BUCKET, _MAP, _AT)
