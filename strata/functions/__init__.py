"""Native column functions: header clean-up, value mappings, date parsing."""

from strata.functions.columns import col, drop_columns, rename_columns, select_plus, trim_headers, with_columns
from strata.functions.dates import day_of, month_of, parse_date, parse_timestamp, to_int, year_of
from strata.functions.mapping import fill_null, map_exact, map_prefix

__all__ = [
    "col",
    "day_of",
    "drop_columns",
    "fill_null",
    "map_exact",
    "map_prefix",
    "month_of",
    "parse_date",
    "parse_timestamp",
    "rename_columns",
    "select_plus",
    "to_int",
    "trim_headers",
    "with_columns",
    "year_of",
]
