"""Value mappings built as native CASE expressions.

Rules are data handed in by the caller; each builder folds them into one
``CASE WHEN`` that stays inside whole-stage code generation. No Python
runs per row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_col(c: str | Column) -> Column:
    if isinstance(c, Column):
        return c
    return F.col("`" + c + "`")


def map_exact(c: str | Column, mapping: Mapping[str, str], default: Column | str | None = None) -> Column:
    """Exact-match mapping, else ``default`` (the input itself when None).

    Matching is case- and accent-sensitive. A null input matches no arm.
    """
    source = _as_col(c)
    otherwise = source if default is None else (default if isinstance(default, Column) else F.lit(default))
    if not mapping:
        return otherwise
    expr = None
    for key, value in mapping.items():
        cond = source == F.lit(key)
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    return expr.otherwise(otherwise)


def map_prefix(c: str | Column, rules: Sequence[tuple[str, str]], default: Column | str | None = None) -> Column:
    """Ordered literal-prefix rules; the first matching prefix wins, else
    ``default`` (the input itself when None)."""
    source = _as_col(c)
    otherwise = source if default is None else (default if isinstance(default, Column) else F.lit(default))
    if not rules:
        return otherwise
    expr = None
    for prefix, value in rules:
        cond = source.startswith(F.lit(prefix))
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    return expr.otherwise(otherwise)


def fill_null(c: str | Column, value: str) -> Column:
    """Replace a null with a fixed value."""
    return F.coalesce(_as_col(c), F.lit(value))
