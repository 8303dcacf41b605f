"""Property tests: Spark operators against plain-Python models of their rules."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import rows
from strata.functions import map_prefix
from strata.operators import anti_join, exclude_keys, group_counts, key_uniqueness

KEYS = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d"]))
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(facts=st.lists(KEYS, max_size=12), excluded=st.lists(KEYS, max_size=5))
def test_exclusion_is_not_in_with_nulls_removed(spark, facts, excluded):
    f = spark.createDataFrame(list(enumerate(facts)), "id int, user_id string")
    x = spark.createDataFrame([(k,) for k in excluded], "uid string")
    bad = {k for k in excluded if k is not None}
    expected = sorted(i for i, k in enumerate(facts) if k is not None and k not in bad)
    got = sorted(r.id for r in exclude_keys(f, x, "user_id", "uid").collect())
    assert got == expected
    shuffled = sorted(r.id for r in exclude_keys(f, x, "user_id", "uid", broadcast_max_rows=0).collect())
    assert shuffled == expected


@SETTINGS
@given(facts=st.lists(KEYS, max_size=12), excluded=st.lists(KEYS, max_size=5))
def test_anti_join_keeps_null_keys(spark, facts, excluded):
    f = spark.createDataFrame(list(enumerate(facts)), "id int, user_id string")
    x = spark.createDataFrame([(k,) for k in excluded], "uid string")
    bad = {k for k in excluded if k is not None}
    expected = sorted(i for i, k in enumerate(facts) if k is None or k not in bad)
    assert sorted(r.id for r in anti_join(f, x, "user_id", "uid").collect()) == expected


@SETTINGS
@given(values=st.lists(st.one_of(st.none(), st.text(alphabet="ABC, ", max_size=6)), max_size=10))
def test_map_prefix_first_match_wins(spark, values):
    rules = [("AB", "first"), ("A", "second"), ("C,", "third")]

    def model(v):
        if v is None:
            return None
        for prefix, out in rules:
            if v.startswith(prefix):
                return out
        return v

    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = {r.i: r.m for r in df.select("i", map_prefix("v", rules).alias("m")).collect()}
    assert got == {i: model(v) for i, v in enumerate(values)}


@SETTINGS
@given(keys=st.lists(KEYS, max_size=15))
def test_counts_match_python(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "user_id string")
    total, distinct = len(keys), len(set(keys))
    assert rows(key_uniqueness(df, "user_id")) == [(total, distinct, total - distinct)]
    per_key = {r.user_id: r.total_facts for r in group_counts(df, "user_id").collect()}
    assert per_key == {k: (0 if k is None else keys.count(k)) for k in set(keys)}


@SETTINGS
@given(
    left=st.lists(KEYS, max_size=10),
    dim=st.dictionaries(st.sampled_from(["a", "b", "c", "d", "e"]), st.text(alphabet="xyz", max_size=3), max_size=4),
)
def test_lookup_join_is_a_left_lookup(spark, left, dim):
    from strata.operators import lookup_join

    users = spark.createDataFrame(list(enumerate(left)), "id int, k string")
    d = spark.createDataFrame(list(dim.items()), "key string, v string")
    got = {r.id: r.v for r in lookup_join(users, d, "k", "key").collect()}
    assert got == {i: (dim.get(k) if k is not None else None) for i, k in enumerate(left)}


@SETTINGS
@given(data=st.lists(st.tuples(KEYS, KEYS), max_size=12))
def test_distinct_counts_count_null_rows(spark, data):
    from strata.operators import distinct_counts

    df = spark.createDataFrame(data, "a string, b string")
    out = distinct_counts(df, {"a": ["a"], "ab": ["a", "b"]}).first()
    assert (out.a, out.ab) == (len({a for a, _ in data}), len(set(data)))
