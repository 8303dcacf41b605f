"""Joins, set operations and de-duplication.

Scale notes
-----------
* Lookup joins (users -> calendar, users -> countries) read a dimension
  whose size (rows, and bytes summed from the values) is checked with one
  small aggregate job before it is broadcast; above the bounds the join
  stays a shuffle join and AQE may still convert or split it at run time.
* The same job proves the lookup key unique, so a lookup can never
  multiply fact rows.
* Above the bounds a lookup's hot keys (found by a sketch of the left keys)
  are joined with the few rows of the dimension that they need, which are
  broadcast; the rest is a shuffle join without hot partitions.
* Exclusion (facts of invalid users) drops null keys first, then runs a
  left-anti join. The excluded set is broadcast only under the checked
  bound. Otherwise a bitmap of its keys (bounded size) tells most facts apart
  before a shuffle: only those that may be excluded go through a sort-merge
  anti join, where AQE's skew handling splits the partition of a hot user
  (left-anti supports left-side splits).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import col
from strata.operators.bitmaps import MAX_KEYS, bitmap_bits, key_bitmap, with_may_match

# Bounds for broadcasting a join side, checked on the data itself: rows,
# and bytes summed from the actual values (string lengths, fixed widths).
# Spark's hash relation takes a few times the raw bytes on each executor.
DEFAULT_BROADCAST_MAX_ROWS = 1_000_000
DEFAULT_BROADCAST_MAX_BYTES = 32 * 1024 * 1024
# Session settings that replace the default bounds; "-1" turns explicit
# broadcasting off. An explicit argument always wins.
BROADCAST_MAX_ROWS_CONF = "spark.strata.broadcast.maxRows"
BROADCAST_MAX_BYTES_CONF = "spark.strata.broadcast.maxBytes"
# Default of the bound arguments: the session setting, else the default bound.
FROM_SESSION = "session"


def _bound(df: DataFrame, value: int | str | None, default: int, conf: str) -> int | None:
    """The bound to apply: an explicit argument, else the session setting,
    else the library default. ``None`` or a negative value: no broadcast."""
    if value != FROM_SESSION:
        return value
    configured = df.sparkSession.conf.get(conf, None)
    if configured is None:
        return default
    n = int(configured)
    return None if n < 0 else n


class DuplicateKeyError(ValueError):
    """A lookup table holds more than one row for a key."""


@dataclass(frozen=True)
class SideStats:
    """Measured size of a join side."""

    keys: int  # distinct non-null keys
    max_copies: int  # largest number of rows for one key
    rows: int
    bytes: int

    def fits(self, max_rows: int | None, max_bytes: int | None) -> bool:
        """Whether the side may be broadcast under the given bounds."""
        if max_rows is None or max_bytes is None:
            return False
        return self.rows <= max_rows and self.bytes <= max_bytes


def _as_list(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def row_bytes(df: DataFrame) -> Column:
    """Size of a row in bytes: the encoded length of text and binary values,
    the JSON length of nested values, the fixed width of other types."""
    parts = []
    for f in df.schema.fields:
        c = col(f.name)
        if isinstance(f.dataType, (T.StringType, T.BinaryType, T.VarcharType, T.CharType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)))
        else:
            parts.append(F.lit(_fixed_width(f.dataType)))
    return reduce(lambda a, b: a + b, parts, F.lit(0)).cast("long")


def _fixed_width(t: T.DataType) -> int:
    """Bytes of a fixed-width value (Spark's in-memory widths)."""
    if isinstance(t, (T.ByteType, T.BooleanType, T.NullType)):
        return 1
    if isinstance(t, T.ShortType):
        return 2
    if isinstance(t, (T.IntegerType, T.FloatType, T.DateType)):
        return 4
    if isinstance(t, T.DecimalType):
        return 8 if t.precision <= 18 else 16
    return 8  # long, double, timestamps, intervals


def _summary(df: DataFrame, keys: Sequence[str], tag: int) -> DataFrame:
    """One row: (tag, keys, max_copies, rows, bytes) of the non-null-key rows."""
    non_null = df.where(F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))) if keys else df
    per_key = non_null.groupBy(*[col(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("copies"), F.sum(row_bytes(non_null)).alias("size")
    )
    return per_key.agg(
        F.lit(tag).alias("tag"),
        F.count(F.lit(1)).alias("keys"),
        F.coalesce(F.max("copies"), F.lit(0)).alias("max_copies"),
        F.coalesce(F.sum("copies"), F.lit(0)).cast("long").alias("rows"),
        F.coalesce(F.sum("size"), F.lit(0)).cast("long").alias("bytes"),
    )


def side_stats_many(frames: Sequence[tuple[DataFrame, Sequence[str]]]) -> list[SideStats]:
    """:class:`SideStats` of several join sides in a single job.

    The one-row summaries are unioned, so one action returns one small row
    per side; partial aggregation collapses repeated keys before each
    shuffle.
    """
    if not frames:
        return []
    parts = [_summary(df, keys, i) for i, (df, keys) in enumerate(frames)]
    union = reduce(lambda a, b: a.unionByName(b), parts)
    found = {
        r["tag"]: SideStats(int(r["keys"]), int(r["max_copies"]), int(r["rows"]), int(r["bytes"])) for r in union.collect()
    }
    return [found[i] for i in range(len(frames))]


def side_size(df: DataFrame) -> SideStats:
    """Rows and bytes of a join side, from one aggregate job (no shuffle
    beyond the final single-row merge)."""
    r = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes")).first()
    return SideStats(keys=-1, max_copies=-1, rows=int(r["rows"]), bytes=int(r["bytes"]))


def key_stats_many(frames: Sequence[tuple[DataFrame, Sequence[str]]]) -> list[tuple[int, int]]:
    """(distinct non-null keys, largest number of rows per key) of several
    tables, from a single job."""
    return [(st.keys, st.max_copies) for st in side_stats_many(frames)]


def key_stats(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """(number of distinct non-null keys, largest number of rows per key),
    from one aggregate job; only the summary row reaches the driver."""
    return key_stats_many([(df, keys)])[0]


@dataclass(frozen=True)
class Lookup:
    """One lookup: ``dim`` joined on ``left_on`` = ``right_on``."""

    dim: DataFrame
    left_on: str | Sequence[str]
    right_on: str | Sequence[str] | None = None
    how: str = "left"


def _prepare(df_columns: Sequence[str], lk: Lookup, index: int) -> tuple[DataFrame, list[str], list[str]]:
    left_keys = _as_list(lk.left_on)
    right_keys = _as_list(lk.right_on) if lk.right_on is not None else list(left_keys)
    if len(left_keys) != len(right_keys):
        raise ValueError("left_on and right_on need the same number of keys")
    missing = [k for k in left_keys if k not in df_columns]
    if missing:
        raise ValueError(f"left side lacks key columns {missing}")
    tmp = [f"__lookup{index}_key_{i}" for i in range(len(right_keys))]
    payload = [c for c in lk.dim.columns if c not in right_keys]
    clash = sorted(set(payload) & set(df_columns))
    if clash:
        raise ValueError(f"lookup columns {clash} already exist on the left side; rename or drop them first")
    right = lk.dim.select(*[col(r).alias(t) for r, t in zip(right_keys, tmp)], *[col(c) for c in payload])
    right = right.where(F.expr(" AND ".join(f"`{t}` IS NOT NULL" for t in tmp)))
    return right, left_keys, tmp


def lookup_joins(
    df: DataFrame,
    lookups: Sequence[Lookup],
    check_unique: bool = True,
    broadcast_max_rows: int | str | None = FROM_SESSION,
    broadcast_max_bytes: int | str | None = FROM_SESSION,
    isolate_hot_keys: bool = True,
) -> DataFrame:
    """Apply several lookups in order, checking all of them in one job.

    Each lookup side is proven key-unique (so no fact row is multiplied)
    and broadcast only when its measured rows and bytes are within the
    bounds; above them it is a shuffle join that AQE may still convert or
    split at run time, and with ``isolate_hot_keys`` one whose hot keys are
    joined apart (:func:`hot_keys` reads the left keys once for that).
    """
    columns = list(df.columns)
    prepared = []
    for i, lk in enumerate(lookups):
        right, left_keys, tmp = _prepare(columns, lk, i)
        prepared.append((lk, right, left_keys, tmp))
        columns += [c for c in right.columns if c not in tmp]
    stats = side_stats_many([(right, tmp) for _, right, _, tmp in prepared])
    max_rows = _bound(df, broadcast_max_rows, DEFAULT_BROADCAST_MAX_ROWS, BROADCAST_MAX_ROWS_CONF)
    max_bytes = _bound(df, broadcast_max_bytes, DEFAULT_BROADCAST_MAX_BYTES, BROADCAST_MAX_BYTES_CONF)
    out = df
    for (lk, right, left_keys, tmp), st in zip(prepared, stats):
        if check_unique and st.max_copies > 1:
            raise DuplicateKeyError(
                f"lookup key {_as_list(lk.right_on or lk.left_on)} is not unique ({st.max_copies} rows for one key)"
            )
        if st.fits(max_rows, max_bytes):
            right = F.broadcast(right)
        elif isolate_hot_keys and None not in (max_rows, max_bytes) and st.max_copies <= 1 and lk.how in ("left", "inner") and (hot := hot_keys(out, left_keys)):
            out = _isolated_lookup(out, right, left_keys, tmp, lk.how, hot)
            continue
        cond = [col(lk_) == F.col(t) for lk_, t in zip(left_keys, tmp)]
        out = out.join(right, on=cond, how=lk.how).drop(*tmp)
    return out


# Keys that a sketch follows, and the most that are joined apart.
HOT_TRACKED = 10_000
HOT_KEYS = 256


def _key_hash(columns: Sequence[str]) -> Column:
    return F.xxhash64(*[col(c).cast("string") for c in columns])


def hot_keys(df: DataFrame, keys: Sequence[str]) -> list[int]:
    """Hashes of the non-null keys that hold more rows than an even share of a shuffle partition.

    One pass over the key columns with a sketch of frequent items, of fixed
    size; the driver gets ``HOT_KEYS`` hashes at most. The counts are lower
    bounds, which is enough: a key that is missed stays in the shuffle join.
    """
    rows = df.where(F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))).select(_key_hash(keys).alias("h"))
    found = rows.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(h, {HOT_KEYS}, {HOT_TRACKED})").alias("top")).first()
    share = found["n"] / int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return [r["item"] for r in found["top"] or [] if r["count"] > max(share, 1)]


def _isolated_lookup(df: DataFrame, right: DataFrame, left_keys: Sequence[str], tmp: Sequence[str], how: str, hot: Sequence[int]) -> DataFrame:
    """A lookup whose hot keys meet their few dimension rows in a broadcast join, and all others in a shuffle join.

    Rows with a null key match nothing and need no shuffle either.
    """
    cond = [col(k) == F.col(t) for k, t in zip(left_keys, tmp)]
    is_hot = _key_hash(left_keys).isin(list(hot))
    for k in left_keys:
        is_hot = is_hot | col(k).isNull()
    few = right.where(_key_hash(tmp).isin(list(hot)))  # unique keys: a row a hot key, but for equal hashes
    apart = df.where(is_hot).join(F.broadcast(few), on=cond, how=how)
    rest = df.where(~is_hot).join(right, on=cond, how=how)
    return apart.unionAll(rest).drop(*tmp)


def lookup_join(
    df: DataFrame,
    dim: DataFrame,
    left_on: str | Sequence[str],
    right_on: str | Sequence[str] | None = None,
    how: str = "left",
    check_unique: bool = True,
    broadcast_max_rows: int | str | None = FROM_SESSION,
    broadcast_max_bytes: int | str | None = FROM_SESSION,
) -> DataFrame:
    """Enrich ``df`` with the columns of a lookup table.

    The right-side key columns are dropped from the result, so a key that
    shares a name with a left column (``country``) causes no ambiguity.
    Other right columns must not clash with left names. Null keys never
    match: a left row with a null key keeps null lookup columns.
    Raises :class:`DuplicateKeyError` when ``check_unique`` and a key has
    more than one row.
    """
    return lookup_joins(df, [Lookup(dim, left_on, right_on, how)], check_unique, broadcast_max_rows, broadcast_max_bytes)


def exclude_keys(
    df: DataFrame,
    excluded: DataFrame,
    key: str,
    excluded_key: str | None = None,
    broadcast_max_rows: int | str | None = FROM_SESSION,
    cluster_output: bool = False,
    broadcast_max_bytes: int | str | None = FROM_SESSION,
) -> DataFrame:
    """Rows of ``df`` whose ``key`` is set and not among the excluded keys.

    This is SQL ``key NOT IN (list)`` with the list's nulls removed, so the
    result is never emptied by a null in the list, and rows with a null key
    are always dropped (also when the list is empty). The list is a
    DataFrame, never collected to the driver.

    The anti join is always part of the plan, also while the list is empty:
    a frame built before the list grows still drops the new keys. One small
    job measures the list when this function is called; its outcome picks
    the join strategy only.

    Above the bounds a bitmap of the keys (16 MB at most) is broadcast in place
    of the list; facts that it rules out are not shuffled. Lists beyond
    ``bitmaps.MAX_KEYS`` rows, or of another type than ``key``, are joined
    without it.

    With ``cluster_output`` the result comes out clustered by ``key`` (ready
    for a write partitioned by it) after exactly one shuffle of ``df``:
    the sort-merge anti join already delivers that clustering; the broadcast
    path adds a REBALANCE by ``key`` after the (map-side) join.
    """
    ek = excluded_key or key
    bad = excluded.select(col(ek).alias("__excluded_key")).where(F.col("__excluded_key").isNotNull())
    kept = df.where(col(key).isNotNull())
    # Rows and bytes of the list (not distinct keys): an upper bound, no shuffle.
    size = side_size(bad)
    max_rows = _bound(df, broadcast_max_rows, DEFAULT_BROADCAST_MAX_ROWS, BROADCAST_MAX_ROWS_CONF)
    max_bytes = _bound(df, broadcast_max_bytes, DEFAULT_BROADCAST_MAX_BYTES, BROADCAST_MAX_BYTES_CONF)
    anti = col(key) == F.col("__excluded_key")
    if not size.fits(max_rows, max_bytes):
        # No distinct() on the excluded side: repeated keys do not change an
        # anti join, and a plain shuffle below the sort-merge join lets AQE
        # split the partition of a hot key. When the output must stay
        # clustered, the MERGE hint keeps AQE from turning the join into a
        # broadcast join at run time (whose output would not be clustered).
        if cluster_output:
            return kept.join(bad.hint("merge"), anti, "left_anti")
        same_type = df.schema[key].dataType == excluded.schema[ek].dataType
        off = max_rows is None or max_bytes is None  # no broadcast is wanted, not even of a bitmap
        if off or size.rows > MAX_KEYS or not same_type:
            return kept.join(bad, anti, "left_anti")
        return _exclude_flagged(kept, bad, key, size.rows)
    out = kept.join(F.broadcast(bad), anti, "left_anti")
    return out.hint("rebalance", col(key)) if cluster_output else out


def _exclude_flagged(kept: DataFrame, bad: DataFrame, key: str, keys: int) -> DataFrame:
    """The anti join, with a shuffle of only those rows whose key may be excluded.

    ``kept`` is read twice, once for either part; neither a hot user that is
    not excluded nor any other such row (but for about one in sixteen) moves.
    """
    bits = bitmap_bits(keys)
    rows = with_may_match(kept, [key], key_bitmap(bad, ["__excluded_key"], bits), bits, "__may_be_excluded")
    may = rows.where(F.col("__may_be_excluded")).drop("__may_be_excluded")
    surely_not = rows.where(~F.col("__may_be_excluded")).drop("__may_be_excluded")
    return surely_not.unionAll(may.join(bad, col(key) == F.col("__excluded_key"), "left_anti"))


def anti_join(
    left: DataFrame,
    right: DataFrame,
    left_on: str | Sequence[str],
    right_on: str | Sequence[str] | None = None,
    broadcast_max_rows: int | str | None = FROM_SESSION,
    broadcast_max_bytes: int | str | None = FROM_SESSION,
) -> DataFrame:
    """Left rows without a match on the right.

    Plain ``left_anti`` semantics: a left row with a null key has no match
    and is therefore returned. Only the right key columns take part. They
    are broadcast when their measured rows and bytes are within the bounds
    (so the left side is never shuffled for a small right side); above
    them, or with a bound of ``None`` (no size job; Spark and AQE decide
    from their estimates), it is a shuffle join in which AQE splits a
    skewed left partition.
    """
    left_keys = _as_list(left_on)
    right_keys = _as_list(right_on) if right_on is not None else list(left_keys)
    tmp = [f"__anti_key_{i}" for i in range(len(right_keys))]
    keys = right.select(*[col(r).alias(t) for r, t in zip(right_keys, tmp)])
    max_rows = _bound(left, broadcast_max_rows, DEFAULT_BROADCAST_MAX_ROWS, BROADCAST_MAX_ROWS_CONF)
    max_bytes = _bound(left, broadcast_max_bytes, DEFAULT_BROADCAST_MAX_BYTES, BROADCAST_MAX_BYTES_CONF)
    if max_rows is not None and max_bytes is not None and side_size(keys).fits(max_rows, max_bytes):
        keys = F.broadcast(keys)
    cond = [col(lk) == F.col(t) for lk, t in zip(left_keys, tmp)]
    return left.join(keys, on=cond, how="left_anti")


def rows_missing_lookup(enriched: DataFrame, lookup_column: str) -> DataFrame:
    """Rows of a left-joined table whose looked-up column is null (F8).

    This is the audit as the jobs print it: it also lists rows that matched
    a lookup row holding a null value. Use :func:`anti_join` for "no
    matching row".
    """
    return enriched.where(col(lookup_column).isNull())


def union_rows(df: DataFrame, other: DataFrame, allow_missing: bool = False) -> DataFrame:
    """UNION ALL matched by column name."""
    return df.unionByName(other, allowMissingColumns=allow_missing)


def drop_duplicate_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Remove repeated rows; nulls compare equal."""
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def distinct_values(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """DISTINCT over a projection (D1); a null is one of the values."""
    return df.select(*[col(c) for c in _as_list(columns)]).distinct()
