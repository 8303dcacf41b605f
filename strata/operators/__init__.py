"""Relational operators and data-quality checks."""

from strata.operators.distinct import count_bitmaps, distinct_bitmaps, publish_bitmaps, read_bitmaps
from strata.operators.observed import Probes
from strata.operators.quality import (
    CheckFailed,
    distinct_counts,
    duplicate_keys,
    duplicate_naming,
    fd_violations,
    filter_impact,
    gate,
    group_counts,
    key_uniqueness,
    missing_country_with_date,
    null_profile,
    null_rows,
    preview,
    unmatched_values,
    unparsed_values,
)
from strata.operators.relational import (
    DEFAULT_BROADCAST_MAX_BYTES,
    DEFAULT_BROADCAST_MAX_ROWS,
    FROM_SESSION,
    DuplicateKeyError,
    Lookup,
    SideStats,
    anti_join,
    distinct_values,
    drop_duplicate_rows,
    exclude_keys,
    key_stats,
    key_stats_many,
    lookup_join,
    lookup_joins,
    row_bytes,
    rows_missing_lookup,
    side_size,
    side_stats_many,
    union_rows,
)
from strata.operators.rules import map_prefix_rules

__all__ = [
    "DEFAULT_BROADCAST_MAX_BYTES",
    "DEFAULT_BROADCAST_MAX_ROWS",
    "FROM_SESSION",
    "CheckFailed",
    "DuplicateKeyError",
    "Lookup",
    "Probes",
    "SideStats",
    "anti_join",
    "count_bitmaps",
    "distinct_bitmaps",
    "distinct_counts",
    "distinct_values",
    "drop_duplicate_rows",
    "duplicate_keys",
    "duplicate_naming",
    "exclude_keys",
    "fd_violations",
    "filter_impact",
    "gate",
    "group_counts",
    "key_stats",
    "key_stats_many",
    "key_uniqueness",
    "lookup_join",
    "lookup_joins",
    "map_prefix_rules",
    "missing_country_with_date",
    "null_profile",
    "null_rows",
    "preview",
    "publish_bitmaps",
    "read_bitmaps",
    "row_bytes",
    "rows_missing_lookup",
    "side_size",
    "side_stats_many",
    "union_rows",
    "unmatched_values",
    "unparsed_values",
]
