import pytest

from helpers import rows
from strata.operators import (
    DuplicateKeyError,
    anti_join,
    distinct_values,
    drop_duplicate_rows,
    exclude_keys,
    key_stats,
    lookup_join,
    rows_missing_lookup,
    union_rows,
)


@pytest.fixture
def facts(spark):
    return spark.createDataFrame([(1, "a"), (2, None), (3, "b"), (4, "c")], "id int, user_id string")


def test_exclusion_drops_null_keys_and_listed_users(spark, facts):
    bad = spark.createDataFrame([("a",)], "uid string")
    assert rows(exclude_keys(facts, bad, "user_id", "uid"), "id") == [(3,), (4,)]


def test_exclusion_ignores_null_in_the_list(spark, facts):
    bad = spark.createDataFrame([("a",), (None,)], "uid string")
    assert rows(exclude_keys(facts, bad, "user_id", "uid"), "id") == [(3,), (4,)]


def test_exclusion_with_empty_list_keeps_all_non_null(spark, facts):
    bad = spark.createDataFrame([], "uid string")
    assert rows(exclude_keys(facts, bad, "user_id", "uid"), "id") == [(1,), (3,), (4,)]


def test_exclusion_keeps_users_absent_from_the_list(spark):
    facts = spark.createDataFrame([(1, "u99")], "id int, user_id string")
    bad = spark.createDataFrame([("a",)], "uid string")
    assert exclude_keys(facts, bad, "user_id", "uid").count() == 1


def test_exclusion_shuffle_path_matches_broadcast_path(spark, facts):
    bad = spark.createDataFrame([("a",), ("c",)], "uid string")
    small = exclude_keys(facts, bad, "user_id", "uid")
    big = exclude_keys(facts, bad, "user_id", "uid", broadcast_max_rows=0)
    assert rows(small) == rows(big) == [(3, "b")]
    assert "strategy=broadcast" in anti_of(small)
    assert "strategy=broadcast" not in anti_of(big)  # a bitmap may be, the list is not


def anti_of(df):
    """The anti join's line of a plan."""
    return next(x for x in df._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join LeftAnti" in x)


def test_anti_join_keeps_null_keys(spark, facts):
    bad = spark.createDataFrame([("a",)], "uid string")
    assert rows(anti_join(facts, bad, "user_id", "uid"), "id") == [(2,), (3,), (4,)]


def test_lookup_join_preserves_rows_and_drops_right_key(spark):
    users = spark.createDataFrame([("u1", "Spain"), ("u2", "Narnia"), ("u3", None)], "user_id string, country_name string")
    dim = spark.createDataFrame([("Spain", "Europe")], "country string, continent string")
    out = lookup_join(users, dim, "country_name", "country")
    assert out.columns == ["user_id", "country_name", "continent"]
    assert rows(out) == [("u1", "Spain", "Europe"), ("u2", "Narnia", None), ("u3", None, None)]


def test_lookup_join_same_key_name_on_both_sides(spark):
    users = spark.createDataFrame([("u1", "Spain")], "user_id string, country string")
    dim = spark.createDataFrame([("Spain", "Europe")], "country string, continent string")
    assert rows(lookup_join(users, dim, "country")) == [("u1", "Spain", "Europe")]


def test_lookup_join_rejects_duplicate_keys(spark):
    users = spark.createDataFrame([("u1", "Congo")], "user_id string, country string")
    dim = spark.createDataFrame([("Congo", "Africa"), ("Congo", "Africa")], "country string, continent string")
    with pytest.raises(DuplicateKeyError):
        lookup_join(users, dim, "country")


def test_lookup_join_null_key_duplicates_do_not_count(spark):
    users = spark.createDataFrame([("u1", "Spain")], "user_id string, country string")
    dim = spark.createDataFrame([(None, "x"), (None, "y"), ("Spain", "Europe")], "country string, continent string")
    assert rows(lookup_join(users, dim, "country")) == [("u1", "Spain", "Europe")]


def test_lookup_join_rejects_clashing_payload(spark):
    users = spark.createDataFrame([("u1", "Spain", "x")], "user_id string, country string, continent string")
    dim = spark.createDataFrame([("Spain", "Europe")], "country string, continent string")
    with pytest.raises(ValueError):
        lookup_join(users, dim, "country")


def test_lookup_join_broadcasts_only_under_the_bound(spark):
    users = spark.createDataFrame([("u1", "Spain")], "user_id string, country string")
    dim = spark.createDataFrame([("Spain", "Europe")], "country string, continent string")
    small = lookup_join(users, dim, "country")
    assert "broadcast" in small._jdf.queryExecution().optimizedPlan().toString().lower()
    big = lookup_join(users, dim, "country", broadcast_max_rows=0)
    assert "broadcast" not in big._jdf.queryExecution().optimizedPlan().toString().lower()
    assert rows(small) == rows(big)


def test_key_stats(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    assert key_stats(df, ["k"]) == (2, 2)


def test_rows_missing_lookup_lists_null_lookups(spark):
    df = spark.createDataFrame([("u1", None), ("u2", "Leo")], "user_id string, horoscope string")
    assert rows(rows_missing_lookup(df, "horoscope"), "user_id") == [("u1",)]


def test_union_dedup_distinct(spark):
    a = spark.createDataFrame([("Congo", None)], "c string, d string")
    b = spark.createDataFrame([(None, "Congo")], "d string, c string")
    u = union_rows(a, b)
    assert u.count() == 2
    assert drop_duplicate_rows(u).count() == 1  # nulls compare equal
    assert rows(distinct_values(u, "c")) == [("Congo",)]


def _skew_session_settings(spark):
    keys = {
        # With only 8 test partitions a key holding a third of the rows is
        # ~3.5x the median partition; at cluster scale it is far above the
        # default factor of 5.
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    return old


def test_exclusion_shuffle_path_splits_a_hot_user(spark):
    """One user owns a third of the facts: the sort-merge anti join's hot
    partition is split by AQE instead of landing in one task."""
    from pyspark.sql import functions as F

    old = _skew_session_settings(spark)
    try:
        facts = spark.range(300_000).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 5000).cast("string")).alias("user_id"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        )
        bad = spark.range(0, 5000, 7).select(F.col("id").cast("string").alias("uid"))
        out = exclude_keys(facts, bad, "user_id", "uid", broadcast_max_rows=0, cluster_output=True)
        n = len(out.collect())
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "LeftAnti" in plan
        assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan
        expected = facts.where(~F.col("user_id").isin([str(i) for i in range(0, 5000, 7)])).count()
        assert n == expected
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_rebalanced_partitioned_write_splits_a_hot_user(spark):
    """The partitioned sink's REBALANCE shuffle splits the hot key too."""
    from pyspark.sql import functions as F

    old = _skew_session_settings(spark)
    try:
        facts = spark.range(300_000).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 500).cast("string")).alias("user_id"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        )
        out = facts.hint("rebalance", F.col("user_id"))
        out.collect()
        assert "AQEShuffleRead skewed" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_lookup_joins_checks_all_lookups_in_one_job(spark):
    from strata.operators import Lookup, key_stats_many, lookup_joins

    users = spark.createDataFrame([("u1", "Spain", 4, 2)], "user_id string, country string, d int, m int")
    countries = spark.createDataFrame([("Spain", "Europe")], "country string, continent string")
    signs = spark.createDataFrame([(4, 2, "Aquarius")], "day int, month int, horoscope string")
    out = lookup_joins(users, [Lookup(countries, "country"), Lookup(signs, ["d", "m"], ["day", "month"])])
    assert rows(out) == [("u1", "Spain", 4, 2, "Europe", "Aquarius")]
    assert key_stats_many([(countries, ["country"]), (signs, ["day", "month"])]) == [(1, 1), (1, 1)]
    dup = signs.unionByName(signs)
    with pytest.raises(DuplicateKeyError):
        lookup_joins(users, [Lookup(countries, "country"), Lookup(dup, ["d", "m"], ["day", "month"])])


@pytest.mark.parametrize("bound", [100_000, 0])
def test_clustered_exclusion_shuffles_facts_once(spark, bound):
    """Ready for a write partitioned by user: one exchange on the fact key,
    whether the exclusion is broadcast or a sort-merge join."""
    facts = spark.range(2000).selectExpr("CAST(id % 50 AS STRING) AS user_id", "id")
    bad = spark.createDataFrame([("3",), ("7",)], "uid string")
    out = exclude_keys(facts, bad, "user_id", "uid", broadcast_max_rows=bound, cluster_output=True)
    assert len(out.collect()) == 2000 - 80
    final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    fact_shuffles = [l for l in final.splitlines() if "Exchange hashpartitioning(user_id" in l]
    assert len(fact_shuffles) == 1
    if bound == 0:
        # the list is tiny, yet AQE must not turn the join into a broadcast
        # join: its output would no longer be clustered by user
        assert "SortMergeJoin" in final and "BroadcastHashJoin" not in final


def test_side_size_measures_rows_and_bytes(spark):
    from strata.operators import side_size, side_stats_many

    df = spark.createDataFrame([("ab", 1), ("çé", None), (None, 3)], "s string, n int")
    st = side_size(df)
    # "ab" 2 bytes, "çé" 4 bytes (UTF-8), null 0; an int is 4 bytes wide
    assert (st.rows, st.bytes) == (3, 2 + 4 + 0 + 3 * 4)
    (lk,) = side_stats_many([(df, ["s"])])
    assert (lk.keys, lk.max_copies, lk.rows, lk.bytes) == (2, 1, 2, 2 + 4 + 2 * 4)


def test_lookup_join_respects_the_byte_bound(spark):
    users = spark.createDataFrame([("u1", "Spain")], "user_id string, country string")
    dim = spark.createDataFrame([("Spain", "Europe" * 100)], "country string, continent string")
    wide = lookup_join(users, dim, "country", broadcast_max_bytes=100)
    assert "broadcast" not in wide._jdf.queryExecution().optimizedPlan().toString().lower()
    narrow = lookup_join(users, dim, "country")
    assert "broadcast" in narrow._jdf.queryExecution().optimizedPlan().toString().lower()
    assert rows(wide) == rows(narrow)


def test_exclusion_respects_the_byte_bound(spark, facts):
    bad = spark.createDataFrame([("a",), ("c",)], "uid string")
    out = exclude_keys(facts, bad, "user_id", "uid", broadcast_max_bytes=1)
    assert "strategy=broadcast" not in anti_of(out)
    assert rows(out) == [(3, "b")]
