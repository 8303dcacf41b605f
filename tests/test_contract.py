"""The driver contract of __spark_entry__.py."""

import inspect
import re

import __spark_entry__ as E
from strata.plans.registry import QUERIES


def test_query_callables_take_spark_and_sf_dir():
    for name, fn in E.queries().items():
        assert re.fullmatch(r"[a-z][a-z0-9_]*", name), name
        assert len(inspect.signature(fn).parameters) == 2, name


def test_entry_schema_is_stable_and_columns_unique(spark):
    first = E.entry(spark).schema
    second = E.entry(spark).schema
    assert first == second
    names = [f.name for f in first.fields]
    assert len(names) == len(set(names))


def test_oracle_sql_reads_only_the_driver_tables():
    allowed = set(
        "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
    )
    for name, sql in E.oracle_sql().items():
        if name not in QUERIES:  # the optional training-data queries are tested beside their operators
            continue
        for table in re.findall(r"\b(?:FROM|JOIN)\s+([a-z_]+)", sql):
            assert table in allowed or table in {"users_raw", "countries_raw", "calendar", "facts_raw", "facts_parsed",
                                                 "facts_curated", "users_curated", "countries_curated", "users_refined",
                                                 "range"}, (name, table)
