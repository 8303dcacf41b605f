"""Sinks: overwritten / partitioned / catalogued Parquet tables and the run log."""

from strata.sinks.bucketed import Bucketing, bucketing, read_bucketed, write_bucketed
from strata.sinks.run_log import RUN_LOG_SCHEMA, RunLog
from strata.sinks.writers import (
    SchemaChangeError,
    ensure_database,
    key_bucket_filter,
    save_catalog_table,
    stage_table,
    table_name,
    update_catalog_table,
    with_key_bucket,
    write_table,
)

__all__ = [
    "RUN_LOG_SCHEMA",
    "Bucketing",
    "RunLog",
    "SchemaChangeError",
    "bucketing",
    "ensure_database",
    "key_bucket_filter",
    "read_bucketed",
    "save_catalog_table",
    "stage_table",
    "table_name",
    "update_catalog_table",
    "with_key_bucket",
    "write_bucketed",
    "write_table",
]
