"""Lines that do not have a table's columns, kept apart with their text.

Delimited readers fill a short line with nulls and cut a long one, silently.
``read_facts_checked`` marks such lines; ``split_rejected`` parts them from the
rows, and ``quarantine`` publishes them with the file they came from, so nothing
is lost and counts add up.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sinks.writers import write_table
from strata.sources.schemas import facts_schema

REJECTED = "__rejected_line"
FILE = "__file"


def read_checked(spark: SparkSession, path, schema: T.StructType, sep: str, quote: str = "") -> DataFrame:
    """Headerless delimited lines with ``schema``, and in ``__rejected_line`` the text of a line with more or fewer fields.

    The lines are scanned as text and parsed by ``from_csv``, all fields at once:
    a CSV scan that prunes columns cannot tell such lines. Empty lines are none.
    """
    marked = T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType())])
    options = {"sep": sep, "quote": quote, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECTED, "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    lines = spark.read.text(path).where(F.length("value") > 0)
    return lines.select(F.from_csv("value", marked.toDDL(), options).alias("r"), F.col("_metadata.file_path").alias(FILE)).select("r.*", FILE)


def read_facts_checked(spark: SparkSession, path, sep: str = "\t", quote: str = "", extra_columns: Iterable[str] = ()) -> DataFrame:
    """Raw facts (S3) with the lines that are not of their shape marked."""
    return read_checked(spark, path, facts_schema(extra_columns), sep, quote=quote)


def split_rejected(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected lines ``(line, file)``) of a checked scan; each reads the text once."""
    rows = df.where(F.col(REJECTED).isNull()).drop(REJECTED, FILE)
    lines = df.where(F.col(REJECTED).isNotNull()).select(F.col(REJECTED).alias("line"), F.col(FILE).alias("file"))
    return rows, lines


def quarantine(rejected: DataFrame, path: str) -> int:
    """Append rejected lines to the table at ``path``, with the time; returns how many."""
    return write_table(rejected.withColumn("at", F.current_timestamp()), path, mode="append")
