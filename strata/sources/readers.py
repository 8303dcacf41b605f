"""Readers for the raw (delimited) and layer (Parquet) tables.

All readers are lazy: nothing is scanned until an action, and Catalyst
pushes later filters and column selections into the scan (CSV and Parquet
both prune columns; Parquet also pushes predicates).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import col, trim_headers
from strata.session import first_folder_of_key
from strata.sources.schemas import (
    COUNTRIES_REQUIRED,
    HOROSCOPES_REQUIRED,
    USERS_REQUIRED,
    facts_schema,
    require_columns,
)

NULL_KEY = "__HIVE_DEFAULT_PARTITION__"  # in a folder's name


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    sep: str,
    header: bool = True,
    schema: T.StructType | None = None,
    quote: str | None = None,
    trim_values: bool = False,
) -> DataFrame:
    """Delimited text scan with every column a string.

    ``schema`` binds headerless files by position. ``quote=""`` turns quote
    handling off, so a field that opens a double quote without closing it
    cannot swallow the following columns (tab-separated feeds). Values are
    kept as they are unless ``trim_values``.
    """
    reader = spark.read.option("sep", sep).option("header", str(header).lower())
    # Keep header padding and values as written; trimming is explicit.
    reader = reader.option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
    if quote is not None:
        reader = reader.option("quote", quote)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", "false")
    df = reader.csv(path)
    if trim_values:
        df = df.select([F.trim(col(c)).alias(c) for c in df.columns])
    return df


def read_users(spark: SparkSession, path, sep: str = "\t", trim_values: bool = False) -> DataFrame:
    """Raw users: tab-separated with a header."""
    df = trim_headers(read_delimited(spark, path, sep=sep, header=True, trim_values=trim_values))
    return require_columns(df, USERS_REQUIRED, "users")


def read_countries(spark: SparkSession, path, sep: str = ",", trim_values: bool = False) -> DataFrame:
    """Raw countries: comma-separated with a header whose names may carry
    a leading space (S2 + P1)."""
    df = trim_headers(read_delimited(spark, path, sep=sep, header=True, trim_values=trim_values))
    return require_columns(df, COUNTRIES_REQUIRED, "countries")


def read_horoscopes(spark: SparkSession, path, sep: str = ",", trim_values: bool = False) -> DataFrame:
    """Raw horoscope calendar: comma-separated with a header."""
    df = trim_headers(read_delimited(spark, path, sep=sep, header=True, trim_values=trim_values))
    return require_columns(df, HOROSCOPES_REQUIRED, "horoscopes")


def read_facts(
    spark: SparkSession,
    path,
    sep: str = "\t",
    quote: str = "",
    extra_columns: Iterable[str] = (),
    trim_values: bool = False,
) -> DataFrame:
    """Raw facts: headerless tab-separated, named by position (S3 + P2).

    Quote handling is off by default (song titles may open a quote).
    """
    return read_delimited(
        spark,
        path,
        sep=sep,
        header=False,
        schema=facts_schema(extra_columns),
        quote=quote,
        trim_values=trim_values,
    )


def read_layer_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet table of a layer, partitioned or not.

    For a table partitioned by a string key pass ``schema``: partition
    discovery would otherwise type numeric-looking keys (``001`` -> 1).
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def read_partitioned_strings(spark: SparkSession, path: str) -> DataFrame:
    """Partitioned Parquet table whose partition keys stay strings.

    Partition discovery would type a key such as ``001`` as the number 1, and
    its time grows with the square of the folders (Spark 4.1 looks each one up
    in a linked list), its memory by a list of them beside that of the files. So
    the files are listed without it, once, and the keys are read from the names
    of the folders that each file lies in. A filter on a key alone still leaves
    out the other folders' files before anything is read. The other columns are
    those of one file, as Spark takes them. No session setting is changed.
    """
    keys = _partition_columns(spark, path)
    if not keys:
        return spark.read.parquet(path)
    files = spark.read.option("recursiveFileLookup", "true").parquet(path)
    where = files.metadataColumn("_metadata")["file_path"]
    folders = {k: F.substring_index(F.substring_index(where, "/", i - len(keys) - 1), "/", 1) for i, k in enumerate(keys)}
    held = reduce(Column.__and__, [F.contains(f, F.lit("=")) for f in folders.values()])  # files beside the folders are not the table's
    return files.where(held).withColumns({k: _key_of(f) for k, f in folders.items()})


def _partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Names of ``key=value`` folders below ``path``, following the first of each level."""
    names = []
    while folder := first_folder_of_key(spark, path):
        names.append(unquote(folder.split("=")[0]))
        path = f"{path.rstrip('/')}/{folder}"
    return names


def _key_of(folder: Column) -> Column:
    """The value in a folder's name ``key=value``: null by its stand-in, else
    unescaped twice, from the file's path and from the name (where Spark leaves a
    ``%`` that escapes nothing as it is)."""

    def unescaped(text: Column) -> Column:
        return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))

    text = F.substr(folder, F.instr(folder, "=") + F.lit(1))
    return F.when(text != NULL_KEY, unescaped(F.regexp_replace(unescaped(text), "%(?![0-9A-Fa-f]{2})", "%25")))


def literal_rows(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType | Sequence[str]) -> DataFrame:
    """A handful of fixed rows shipped from the driver (S5); bounded by the
    caller's literal list, never by data."""
    if not isinstance(schema, T.StructType):
        schema = T.StructType([T.StructField(c, T.StringType(), True) for c in schema])
    return spark.createDataFrame([tuple(r) for r in rows], schema)
