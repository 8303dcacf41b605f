"""Exact distinct counts by bitmap (A2, A3, Q2): counted once, merged for any roll-up.

The distinct values of a column set get numbers from 1 without gaps (its
dictionary). The facts of a part - a month, say - then are bits: one row of 4,096
bytes for each 32,768 numbers that has any set. Bits of several parts are merged
by OR, so a count over a year, or after another run, reads bitmaps and no fact.

The facts are shuffled once for all column sets: to their distinct combinations.
Bits are merged within each task before they are shuffled, so a value or a part
that holds a third of all rows is no larger than another. A bit set twice is set
once: a batch that is published again changes nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import col
from strata.session import path_exists, scratch_path
from strata.sinks.writers import stage_table, write_table

PART_ROWS = 1_000_000  # values that one task numbers
NAME, BUCKET, BITS, ID = "column_set", "bucket", "bits", "id"


def numbered(values: DataFrame, first: int = 1, part_rows: int = PART_ROWS) -> DataFrame:
    """Distinct rows with ``id``: ``first`` and on, without gaps, each once.

    Rows are dealt by hash to parts, which are numbered each in one task by the
    order of their columns; a part begins where the sizes of those before it end.
    So the numbers are the same when a lost task is run again.
    """
    columns = values.columns
    parts = 1 + values.count() // part_rows
    dealt = values.withColumn("__part", F.pmod(F.xxhash64(*[col(c) for c in columns]), F.lit(parts)).cast("int"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("__part").agg(F.count("*").alias("__n"))  # a row a part
    starts = starts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    place = F.row_number().over(Window.partitionBy("__part").orderBy(*[col(c) for c in columns]))
    rows = dealt.withColumn("__place", place).join(F.broadcast(starts), "__part")
    return rows.select(*[col(c) for c in columns], (F.col("__start") + F.col("__place") + F.lit(first - 1)).alias(ID))


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str]):
    """Equality of ``columns``, null to null, of frames whose own names are ``columns`` and ``__<k>``."""
    on = None
    for k, c in enumerate(columns):
        equal = left[f"`{c}`"].eqNullSafe(right[f"__{k}"])
        on = equal if on is None else on & equal
    return on


def _renamed(dictionary: DataFrame, columns: Sequence[str], id_name: str = ID) -> DataFrame:
    return dictionary.select(*[col(c).alias(f"__{k}") for k, c in enumerate(columns)], F.col(ID).alias(id_name))


def distinct_rows(df: DataFrame, column_sets: Mapping[str, Sequence[str]], by: Sequence[str] = ()) -> DataFrame:
    """The distinct combinations of the parts and all column sets, written to the shared scratch folder."""
    every = list(dict.fromkeys([*by, *(c for cols in column_sets.values() for c in cols)]))
    return stage_table(df.select(*[col(c) for c in every]).distinct(), scratch_path(df.sparkSession, "distinct-rows"))


def extended(known: DataFrame | None, rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The values of ``rows`` that ``known`` lacks, with numbers after its own."""
    values = rows.select(*[col(c) for c in columns]).distinct()
    if known is None:
        return numbered(values)
    old = _renamed(known, columns)
    first = known.agg(F.coalesce(F.max(ID), F.lit(0))).first()[0] + 1
    return numbered(values.join(old, _same(values, old, columns), "left_anti"), first)


def set_bitmaps(rows: DataFrame, dictionaries: Mapping[str, DataFrame], column_sets: Mapping[str, Sequence[str]], by: Sequence[str] = ()) -> DataFrame:
    """(``by``, ``column_set``, ``bucket``, ``bits``): the numbers that occur in each part."""
    names = list(column_sets)
    out = rows
    for k, name in enumerate(names):
        found = _renamed(dictionaries[name], column_sets[name], f"__id{k}")
        out = out.join(found, _same(out, found, column_sets[name]), "left").drop(*[f"__{i}" for i in range(len(column_sets[name]))])
    pairs = F.explode(F.array(*[F.struct(F.lit(name).alias(NAME), F.col(f"__id{k}").alias(ID)) for k, name in enumerate(names)]))
    pairs = out.select(*[col(c) for c in by], pairs.alias("__pair")).select(*[col(c) for c in by], f"__pair.{NAME}", f"__pair.{ID}")
    return pairs.groupBy(*[col(c) for c in by], NAME, F.bitmap_bucket_number(ID).alias(BUCKET)).agg(F.bitmap_construct_agg(F.bitmap_bit_position(ID)).alias(BITS))


def count_bitmaps(bitmaps: DataFrame, by: Sequence[str] = (), alias: str = "n") -> DataFrame:
    """(``by``, ``column_set``, ``n``): distinct values, parts that agree in ``by`` merged."""
    keys = [*[col(c) for c in by], F.col(NAME)]
    merged = bitmaps.groupBy(*keys, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count(BITS)).cast("bigint").alias(alias))


def distinct_bitmaps(df: DataFrame, column_sets: Mapping[str, Sequence[str]], by: Sequence[str] = ()) -> DataFrame:
    """Bitmaps of ``df`` alone, for :func:`count_bitmaps`.

    A null, in a column set or in ``by``, is a value. An empty table has no
    bitmap. Columns of ``df`` may not be named ``column_set``, ``bucket``,
    ``bits`` or ``id`` if they are among ``by``.
    """
    _check(column_sets, by)
    rows = distinct_rows(df, column_sets, by)
    return set_bitmaps(rows, {name: extended(None, rows, cols) for name, cols in column_sets.items()}, column_sets, by)


def publish_bitmaps(df: DataFrame, path: str, column_sets: Mapping[str, Sequence[str]], by: Sequence[str] = ()) -> None:
    """Add ``df`` to the dictionaries and bitmaps at ``path``; earlier facts are not read.

    Values already known keep their numbers. A run that failed, or a batch that
    was published before, may be published again: it sets the same bits. Runs of
    one path must not overlap in time, as both would give out the same numbers.
    """
    _check(column_sets, by)
    spark = df.sparkSession
    rows = distinct_rows(df, column_sets, by)
    dictionaries = {}
    for name, columns in column_sets.items():
        place = f"{path}/dictionary/{name}"
        known = spark.read.parquet(place) if path_exists(spark, place) else None
        write_table(extended(known, rows, columns), place, mode="append")
        dictionaries[name] = spark.read.parquet(place)
    write_table(set_bitmaps(rows, dictionaries, column_sets, by), f"{path}/bitmaps", mode="append")


def read_bitmaps(spark, path: str) -> DataFrame:  # noqa: ANN001
    """What :func:`publish_bitmaps` wrote."""
    return spark.read.parquet(f"{path}/bitmaps")


def _check(column_sets: Mapping[str, Sequence[str]], by: Sequence[str]) -> None:
    clash = {NAME, BUCKET, BITS, ID} & set(by)
    if clash or not column_sets:
        raise ValueError(f"names of the bitmaps' own columns: {sorted(clash)}" if clash else "no column set given")
    if any(not columns for columns in column_sets.values()):
        raise ValueError("a column set without columns")
