"""Data-quality checks returned as DataFrames.

Each check is a distributed DataFrame: counts are aggregates (partial
aggregation before any shuffle, so a hot key is collapsed map-side),
listings are filters or anti joins (:func:`unmatched_values` measures its
dimension with one small job when it is called). Several counts over one table are
computed in a single pass. :func:`gate` turns any check into a fail-fast
assertion.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import col
from strata.operators.relational import anti_join


class CheckFailed(AssertionError):
    """A gated data-quality check found rows."""


def _as_list(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def unmatched_values(df: DataFrame, key: str, dim: DataFrame, dim_key: str | None = None) -> DataFrame:
    """Distinct values of ``df[key]`` with no row in ``dim``.

    A null value never matches, so it is listed when present. The values
    are de-duplicated first (partial aggregation before the shuffle), so
    only the distinct values, not every row, reach the anti join.
    """
    return anti_join(df.select(col(key)).distinct(), dim, key, dim_key or key)


def key_uniqueness(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """One row ``(total_ids, distinct_ids, duplicate_ids)`` (Q2, A1, A2).

    ``distinct_ids`` counts a null key as one value, like
    ``select(key).distinct().count()``.
    """
    per_key = df.groupBy(*[col(k) for k in _as_list(key)]).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_ids"),
        F.count(F.lit(1)).alias("distinct_ids"),
    ).withColumn("duplicate_ids", F.col("total_ids") - F.col("distinct_ids"))


def null_profile(df: DataFrame, columns: Sequence[str], conditions: Mapping[str, Column] | None = None) -> DataFrame:
    """One row: ``rows``, one ``<column>_nulls`` count per column, and one
    count per named extra condition, all in a single pass (Q3, A6)."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.count_if(col(c).isNull()).alias(f"{c}_nulls") for c in columns]
    aggs += [F.count_if(cond).alias(name) for name, cond in (conditions or {}).items()]
    return df.agg(*aggs)


def null_rows(df: DataFrame, predicate: Column | str) -> DataFrame:
    """Rows matching a missing-value predicate."""
    return df.where(predicate)


def missing_country_with_date(users: DataFrame) -> DataFrame:
    """Users that have a registration text but no country."""
    return users.where(col("country").isNull() & col("registered").isNotNull())


def unparsed_values(df: DataFrame, text_column: str, parsed_column: str) -> DataFrame:
    """Rows whose text is present but did not parse (Q4)."""
    return df.where(col(text_column).isNotNull() & col(parsed_column).isNull())


def distinct_counts(df: DataFrame, column_sets: Mapping[str, Sequence[str]]) -> DataFrame:
    """One row with the number of distinct rows of each column set (A2, A3).

    Rows holding nulls count as values, as in ``select(cols).distinct()
    .count()``. The distinct combinations of all columns are found first and
    the sets are counted on that smaller table (its shuffle is shared), so no
    fact row is copied once per set.
    """
    every = list(dict.fromkeys(c for cols in column_sets.values() for c in _as_list(cols)))
    rows = df.select(*[col(c) for c in every]).distinct()
    parts = []
    for name, cols in column_sets.items():
        part = rows if set(_as_list(cols)) == set(every) else rows.select(*[col(c) for c in _as_list(cols)]).distinct()
        parts.append(part.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n")))
    union = reduce(lambda a, b: a.unionByName(b), parts)
    return union.agg(*[F.coalesce(F.sum(F.when(F.col("name") == name, F.col("n"))), F.lit(0)).cast("bigint").alias(name) for name in column_sets])


def fd_violations(df: DataFrame, determinant: str | Sequence[str], dependent: str | Sequence[str], alias: str = "n_values") -> DataFrame:
    """Determinant values mapped to more than one dependent value.

    ``groupBy(det).agg(countDistinct(dep)) HAVING > 1``. A row with a null
    dependent is not counted (count-distinct skips nulls).
    """
    det = _as_list(determinant)
    dep = _as_list(dependent)
    return (
        df.groupBy(*[col(c) for c in det])
        .agg(F.count_distinct(*[col(c) for c in dep]).alias(alias))
        .where(F.col(alias) > 1)
    )


def duplicate_naming(
    df: DataFrame,
    names: Sequence[str] = ("group_name", "song_name"),
    ids: Sequence[str] = ("group_id", "song_id"),
    alias: str = "n_id_pairs",
) -> DataFrame:
    """Name combinations carried by more than one id combination (Q6, A5)."""
    return fd_violations(df, list(names), list(ids), alias)


def group_counts(df: DataFrame, key: str, alias: str = "total_facts") -> DataFrame:
    """Rows per key, counting the key itself (Q7, A4): the null group
    reports 0, like ``count(user_id)``."""
    return df.groupBy(col(key)).agg(F.count(col(key)).alias(alias))


def filter_impact(before: DataFrame, excluded: DataFrame, key: str, excluded_key: str) -> DataFrame:
    """One row ``(rows_before, rows_after, rows_removed)`` of an exclusion.

    One scan: rows are counted by key first (a hot key before the shuffle), and
    the counts meet the distinct excluded keys.
    """
    bad = excluded.select(col(excluded_key).alias("__key")).where(F.col("__key").isNotNull()).distinct().withColumn("__bad", F.lit(True))
    counts = before.groupBy(col(key).alias("__key")).agg(F.count(F.lit(1)).alias("n")).join(bad, "__key", "left")
    kept = F.col("__key").isNotNull() & F.col("__bad").isNull()
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows_before"),
        F.coalesce(F.sum(F.when(kept, F.col("n"))), F.lit(0)).cast("bigint").alias("rows_after"),
    ).withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


def duplicate_keys(df: DataFrame, keys: str | Sequence[str], alias: str = "copies") -> DataFrame:
    """Key values present on more than one row (Q10)."""
    return (
        df.groupBy(*[col(k) for k in _as_list(keys)])
        .agg(F.count(F.lit(1)).alias(alias))
        .where(F.col(alias) > 1)
    )


def preview(df: DataFrame, n: int = 20, order_by: str | Sequence[str | Column] | None = None) -> DataFrame:
    """First ``n`` rows (Q11); ordered when ``order_by`` (names or columns) is given, so the
    result is deterministic (planned as a per-partition top-n, then merge)."""
    if order_by:
        df = df.orderBy(*[col(c) if isinstance(c, str) else c for c in _as_list(order_by)])
    return df.limit(n)


def gate(check: DataFrame, name: str) -> None:
    """Fail fast when a check lists any row; reads at most one row."""
    if check.limit(1).count() > 0:
        raise CheckFailed(f"data-quality check {name!r} found rows")
