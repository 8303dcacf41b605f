"""Table shapes of the three layers.

Raw delimited files carry strings only. The headerless facts file is bound
by position through an explicit schema; headered files are read by name,
because their column order (and any extra pass-through columns) is a
property of the file, and the required names are checked afterwards.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Positional layout of the raw facts file (no header).
FACT_COLUMNS = ("user_id", "fact_date", "group_id", "group_name", "song_id", "song_name")


def facts_schema(extra: Iterable[str] = ()) -> T.StructType:
    """All-string schema of the headerless facts file; ``extra`` names
    trailing columns some feeds append (they pass through)."""
    names = list(FACT_COLUMNS) + list(extra)
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


# Columns each raw table must provide (names after header clean-up).
USERS_REQUIRED = ("#id", "country", "registered")
COUNTRIES_REQUIRED = ("nombre", "name", "continente")
HOROSCOPES_REQUIRED = ("Date", "Day", "Month", "Horocope")


class MissingColumnsError(ValueError):
    """A table lacks columns an operator needs."""


def require_columns(df: DataFrame, names: Iterable[str], table: str = "table") -> DataFrame:
    """Fail fast (on the driver, no job) when ``names`` are not all present."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise MissingColumnsError(f"{table}: missing columns {missing}; has {df.columns}")
    return df
