"""Sources: raw delimited files, layer Parquet tables, literal rows."""

from strata.sources.readers import (
    literal_rows,
    read_countries,
    read_delimited,
    read_facts,
    read_horoscopes,
    read_layer_table,
    read_users,
)
from strata.sources.schemas import FACT_COLUMNS, facts_schema, require_columns

__all__ = [
    "FACT_COLUMNS",
    "facts_schema",
    "literal_rows",
    "read_countries",
    "read_delimited",
    "read_facts",
    "read_horoscopes",
    "read_layer_table",
    "read_users",
    "require_columns",
]
