"""Compare a registered Spark query with its DuckDB oracle.

Mirrors the driver's check: same column names, same row count, same
canonical column types, and the same multiset of rows (order-insensitive).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

_SPARK_TYPES = {
    "string": "string",
    "bigint": "bigint",
    "int": "int",
    "double": "double",
    "date": "date",
    "timestamp_ntz": "timestamp",
    "timestamp": "timestamp_tz",
    "boolean": "boolean",
}
_DUCK_TYPES = {
    "VARCHAR": "string",
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "DATE": "date",
    "TIMESTAMP": "timestamp",
    "TIMESTAMP WITH TIME ZONE": "timestamp_tz",
    "BOOLEAN": "boolean",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _canon(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "item"):  # numpy scalars
        return _canon(v.item())
    return v


def _rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_canon(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, sf_dir: str, name: str, query, sql: str) -> dict:
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_types = {f.name: _SPARK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
    s_rows = _rows(s_cols, [tuple(r) for r in sdf.collect()])
    con = duck(sf_dir)
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = {c: _DUCK_TYPES.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    d_rows = _rows(d_cols, rel.fetchall())
    res = {
        "name": name,
        "columns_match": sorted(s_cols) == sorted(d_cols),
        "types_match": s_types == d_types,
        "rows_spark": len(s_rows),
        "rows_oracle": len(d_rows),
        "values_match": s_rows == d_rows,
    }
    res["ok"] = res["columns_match"] and res["types_match"] and res["values_match"]
    if not res["ok"]:
        res["spark_types"] = s_types
        res["oracle_types"] = d_types
        diff_s = [r for r in s_rows if r not in set(d_rows)][:3] if len(s_rows) < 50000 else []
        diff_d = [r for r in d_rows if r not in set(s_rows)][:3] if len(d_rows) < 50000 else []
        res["only_spark"] = diff_s
        res["only_oracle"] = diff_d
    return res
