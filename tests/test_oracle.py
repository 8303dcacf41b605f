"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from oracle import compare
from strata.plans.registry import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF, name, E.queries()[name], E.oracle_sql()[name])
    assert res["ok"], res


def test_every_query_has_an_oracle():
    assert sorted(QUERIES) == sorted(ORACLE_SQL)
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def test_entry_flagship(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "horoscope" in df.columns and "continent" in df.columns


SHUFFLE_PATH_QUERIES = [
    "enriched_users",
    "exclude_invalid_users",
    "anti_keeps_null_keys",
    "unmatched_after_mapping",
    "users_without_sign",
    "filter_impact",
    "map_continent_exact",
    "refined_users_published",
]


def test_shuffle_paths_match_oracle(spark):
    """The same results when no side may be broadcast (bounds set to -1 in
    the session, Spark's automatic broadcast off)."""
    keys = {"spark.strata.broadcast.maxRows": "-1", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        for name in SHUFFLE_PATH_QUERIES:
            res = compare(spark, SF, name, E.queries()[name], E.oracle_sql()[name])
            assert res["ok"], res
        df = E.queries()["enriched_users"](spark, SF)
        assert "broadcast" not in df._jdf.queryExecution().optimizedPlan().toString().lower()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
