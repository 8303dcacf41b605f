"""Column-name operations (projections P1-P9).

All of these only rewrite the logical plan's projection; Catalyst collapses
them into the scan's column list, so a dropped column is never read.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(name: str) -> Column:
    """Column by exact name, safe for names such as ``#id`` or `` name``."""
    return F.col("`" + name.replace("`", "``") + "`")


def trim_headers(df: DataFrame) -> DataFrame:
    """Strip surrounding spaces (and a byte-order mark on the first header)
    from every column name in one projection (P1)."""
    names = [c.lstrip("\ufeff").strip() for c in df.columns]
    if names == df.columns:
        return df
    dupes = {n for n in names if names.count(n) > 1}
    if dupes:
        raise ValueError(f"header clean-up would merge columns: {sorted(dupes)}")
    return df.toDF(*names)


def rename_columns(df: DataFrame, mapping: Mapping[str, str], strict: bool = True) -> DataFrame:
    """Rename several columns at once.

    Spark silently ignores a rename of an absent column; with ``strict`` a
    missing source name raises instead, so a misspelt name cannot slip by.
    """
    missing = [old for old in mapping if old not in df.columns]
    if strict and missing:
        raise ValueError(f"cannot rename absent columns {missing}; has {df.columns}")
    present = {old: new for old, new in mapping.items() if old in df.columns}
    return df.withColumnsRenamed(present) if present else df


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop columns by name; absent names are ignored (P5)."""
    return df.drop(*list(names))


def with_columns(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """Add or replace computed columns in a single projection."""
    return df.withColumns(dict(exprs))


def select_plus(df: DataFrame, **exprs: Column) -> DataFrame:
    """All columns followed by aliased expressions."""
    return df.select("*", *[e.alias(n) for n, e in exprs.items()])
