"""Layer sinks: overwritten snappy Parquet, optionally partitioned and
registered in the catalog (K1-K4).

Writes go through Spark's file commit protocol: a task lost with its
executor is re-run and only committed task output becomes visible, so a
job survives executor loss. ``mode("overwrite")`` lets Spark clear the
target when the write starts (or, with dynamic partition overwrite, only
the partitions written) instead of a separate prefix delete; a write that
fails as a whole is repaired by running it again.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import col


ADVISORY_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


@contextmanager
def _advisory_size(spark: SparkSession, target_bytes: int | None):
    """Use ``target_bytes`` as AQE's partition size for one write: the pieces
    a hot key is split into, and so the size of the files it produces. The
    setting is session-wide while the write runs."""
    if not target_bytes:
        yield
        return
    previous = spark.conf.get(ADVISORY_SIZE)
    spark.conf.set(ADVISORY_SIZE, str(int(target_bytes)))
    try:
        yield
    finally:
        spark.conf.set(ADVISORY_SIZE, previous)


def _observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Count the written rows inside the write job itself (no extra pass).

    To be the last step of the plan: AQE drops what is below a shuffle that
    turns out empty, and its counts with it.
    """
    obs = Observation(f"rows_written_{uuid.uuid4().hex[:8]}")
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def _prepare(df: DataFrame, partition_by: Sequence[str], rebalance: bool) -> DataFrame:
    """Cluster rows by partition key before a partitioned write.

    The REBALANCE hint shuffles by key and lets AQE split an oversized key
    (one user may own a third of all facts) across several tasks and merge
    small ones, so each partition directory gets a few reasonably sized
    files rather than one file per task or a single huge task.
    """
    if partition_by and rebalance:
        return df.hint("rebalance", *[col(c) for c in partition_by])
    return df


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    compression: str = "snappy",
    dynamic_partition_overwrite: bool = False,
    rebalance: bool = True,
    max_records_per_file: int | None = None,
    target_file_bytes: int | None = None,
) -> int:
    """Write ``df`` as Parquet at ``path`` (K1, K2, K4). Returns the number
    of rows written, observed by the write job itself.

    ``dynamic_partition_overwrite`` replaces only the partitions present in
    ``df`` (incremental loads); the default replaces the whole table.
    ``target_file_bytes`` sets the size AQE splits and merges partitions to
    for this write (larger files for a hot key) without changing it for
    other jobs.
    A null partition key is written to the default partition and reads
    back as null.
    """
    partition_by = list(partition_by)
    counted, obs = _observed(_prepare(df, partition_by, rebalance))
    writer = counted.write.mode(mode).option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
        if dynamic_partition_overwrite:
            writer = writer.option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    with _advisory_size(df.sparkSession, target_file_bytes):
        writer.parquet(path)
    return int(obs.get["rows"])


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create the catalog database when missing."""
    quoted = location.replace("\\", "\\\\").replace("'", "\\'") if location else ""
    where = f" LOCATION '{quoted}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")


def save_catalog_table(
    df: DataFrame,
    database: str,
    table: str,
    path: str | None = None,
    partition_by: Sequence[str] = (),
    compression: str = "snappy",
    rebalance: bool = True,
    target_file_bytes: int | None = None,
) -> int:
    """Overwrite a catalog table, stored at ``path`` when given (K3).

    Returns the number of rows written; read the table back with
    ``spark.table(table_name(database, table))``.
    """
    partition_by = list(partition_by)
    name = table_name(database, table)
    counted, obs = _observed(_prepare(df, partition_by, rebalance))
    writer = (
        counted.write.mode("overwrite")
        .format("parquet")
        .option("compression", compression)
    )
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with _advisory_size(df.sparkSession, target_file_bytes):
        writer.saveAsTable(name)
    return int(obs.get["rows"])


class SchemaChangeError(ValueError):
    """A table's column would change its type."""


def update_catalog_table(
    df: DataFrame,
    database: str,
    table: str,
    path: str | None = None,
    partition_by: Sequence[str] = (),
    compression: str = "snappy",
    rebalance: bool = True,
) -> int:
    """Write ``df`` into a catalog table, whose columns and partitions follow it (K3).

    A table that is not there is created (:func:`save_catalog_table`). Columns
    that are new are added to it (``ALTER TABLE ADD COLUMNS``) and null in the
    rows there; columns that ``df`` lacks are null in its rows; a column whose
    type differs raises :class:`SchemaChangeError` before anything is written.
    The partitions in ``df`` are replaced and known to the catalog when the
    write ends; others stay. A table without partitions is replaced whole.
    Returns the rows written.
    """
    spark, name = df.sparkSession, table_name(database, table)
    if not spark.catalog.tableExists(f"{database}.{table}"):
        return save_catalog_table(df, database, table, path, partition_by, compression, rebalance)
    have = {f.name: f.dataType for f in spark.table(name).schema.fields}
    other = sorted(f.name for f in df.schema.fields if f.name in have and f.dataType != have[f.name])
    if other:
        raise SchemaChangeError(f"{database}.{table}: columns {other} have other types in the table")
    added = [f for f in df.schema.fields if f.name not in have]
    if added:
        columns = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
    given = set(df.columns)
    target = spark.table(name).schema.fields
    df = df.select(*[col(f.name) if f.name in given else F.lit(None).cast(f.dataType).alias(f.name) for f in target])
    where = next(r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect() if r["col_name"] == "Location")
    n = write_table(df, where, partition_by, compression=compression, rebalance=rebalance, dynamic_partition_overwrite=bool(partition_by))
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {name} ADD PARTITIONS")  # lists in parallel; nothing passes the driver by partition
    spark.catalog.refreshTable(f"{database}.{table}")
    return n


def table_name(database: str, table: str) -> str:
    """Quoted qualified catalog name."""
    return f"`{database}`.`{table}`"


def stage_table(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` once as Parquet and return the written table.

    Several checks over the same parsed text then read a columnar,
    column-pruned copy instead of re-parsing the text each time, and the
    lineage is cut at a table in the shared folder (not a local checkpoint).
    """
    write_table(df, path)
    return df.sparkSession.read.parquet(path)


def with_key_bucket(df: DataFrame, key: str = "user_id", buckets: int = 1024, name: str | None = None) -> DataFrame:
    """Add ``<key>_bucket``: a hash of the key's text, modulo ``buckets``.

    Partitioning by this column instead of the key itself bounds the number
    of directories (and catalog partitions) by ``buckets`` however many
    users there are; :func:`key_bucket_filter` selects one key's bucket so
    reads still prune partitions.
    """
    return df.withColumn(name or f"{key}_bucket", _bucket(col(key), buckets))


def _bucket(key: Column, buckets: int) -> Column:
    # The text of a key is the same for an int, a bigint and a string of it;
    # their own hashes are not. Null has a bucket too.
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


def key_bucket_filter(value, key: str = "user_id", buckets: int = 1024, name: str | None = None, key_type: str | None = None):
    """Predicate for the rows of one key value in a bucketed table: the
    bucket (pruned at listing time) and the key itself; ``None`` finds the
    rows with a null key. Give ``key_type`` where the value's text differs
    from the column's (a decimal, a timestamp)."""
    literal = F.lit(value).cast(key_type) if key_type else F.lit(value)
    return (col(name or f"{key}_bucket") == _bucket(literal, buckets)) & col(key).eqNullSafe(literal)
