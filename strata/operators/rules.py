"""Prefix rules as a table (X2, F5), for rule sets that outgrow a CASE expression.

A CASE of thousands of arms is tested arm by arm for each row, and no longer fits
generated code. Here the rules of one prefix length are a lookup table, joined on
the beginning of that length: one equi join a length, of which there are few,
however many rules there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import col
from strata.operators.relational import FROM_SESSION, Lookup, lookup_joins


def map_prefix_rules(
    df: DataFrame,
    column: str,
    rules: DataFrame,
    output: str,
    prefix: str = "prefix",
    value: str = "value",
    order: str = "n",
    default: Column | None = None,
    broadcast_max_rows: int | str | None = FROM_SESSION,
) -> DataFrame:
    """``df`` with ``output``: the value of the first rule, by ``order``, whose prefix ``column`` begins with.

    Without such a rule it is ``default`` (the text itself when ``None``), as
    :func:`strata.functions.map_prefix` gives. Null text and rules with a null
    prefix match nothing; an empty prefix matches every text; of rules of one
    prefix the first counts. The lengths of the prefixes are gathered by the
    driver: they are distinct small numbers. The tables are broadcast within
    the measured bounds, else joined by shuffle with hot beginnings apart.
    """
    rules = rules.where(col(prefix).isNotNull()).select(col(prefix).alias("p"), F.length(col(prefix)).alias("l"), F.struct(col(order).alias("n"), col(value).alias("v")).alias("r"))
    first = rules.groupBy("p", "l").agg(F.min("r").alias("r"))
    lengths = sorted(r[0] for r in first.select("l").distinct().collect())
    lookups, names = [], []
    out = df
    for n in lengths:
        key, found = f"__prefix_{n}", f"__rule_{n}"
        text = col(column)
        # a text shorter than the rule's prefix has no such beginning
        out = out.withColumn(key, F.when(F.length(text) >= n, F.substring(text, 1, n)))
        lookups.append(Lookup(first.where(F.col("l") == n).select(F.col("p").alias(key), F.col("r").alias(found)), key))
        names.append(found)
    if lookups:
        out = lookup_joins(out, lookups, broadcast_max_rows=broadcast_max_rows)
    best = F.least(*names) if len(names) > 1 else (F.col(names[0]) if names else None)
    otherwise = col(column) if default is None else default
    result = otherwise if best is None else F.when(best.isNotNull(), best["v"]).otherwise(otherwise)
    return out.select(*[col(c) for c in df.columns if c != output], result.alias(output))
