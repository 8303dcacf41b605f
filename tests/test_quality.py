import pytest

from helpers import rows
from strata.operators import (
    CheckFailed,
    distinct_counts,
    duplicate_keys,
    duplicate_naming,
    fd_violations,
    filter_impact,
    gate,
    group_counts,
    key_uniqueness,
    missing_country_with_date,
    null_profile,
    preview,
    unmatched_values,
    unparsed_values,
)


def test_unmatched_values_lists_null(spark):
    users = spark.createDataFrame([("Spain",), ("Narnia",), (None,), ("Narnia",)], "country string")
    dim = spark.createDataFrame([("Spain",)], "country string")
    assert rows(unmatched_values(users, "country", dim)) == [(None,), ("Narnia",)]


def test_key_uniqueness_counts_null_as_a_value(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "id string")
    assert rows(key_uniqueness(df, "id")) == [(4, 3, 1)]


def test_key_uniqueness_empty(spark):
    df = spark.createDataFrame([], "id string")
    assert rows(key_uniqueness(df, "id")) == [(0, 0, 0)]


def test_null_profile_one_pass(spark):
    df = spark.createDataFrame([("a", None), (None, None), ("c", "x")], "country string, registered string")
    out = null_profile(df, ["country", "registered"])
    assert out.columns == ["rows", "country_nulls", "registered_nulls"]
    assert rows(out) == [(3, 1, 2)]


def test_missing_country_with_date(spark):
    df = spark.createDataFrame([("u1", None, "Feb 4, 2005"), ("u2", None, None), ("u3", "Spain", "x")], "id string, country string, registered string")
    assert rows(missing_country_with_date(df), "id") == [("u1",)]


def test_unparsed_values(spark):
    df = spark.createDataFrame([("x", None), (None, None), ("y", 1)], "t string, p int")
    assert rows(unparsed_values(df, "t", "p"), "t") == [("x",)]


def test_distinct_counts_count_null_rows(spark):
    df = spark.createDataFrame([("a", None), ("a", None), (None, None), ("a", "x")], "g string, s string")
    out = distinct_counts(df, {"g": ["g"], "gs": ["g", "s"]})
    assert rows(out) == [(2, 3)]


def test_fd_violations(spark):
    df = spark.createDataFrame([("Underworld", "g1"), ("Underworld", "g9"), ("Moby", "g3"), ("Moby", None)], "name string, id string")
    assert rows(fd_violations(df, "name", "id", "n")) == [("Underworld", 2)]


def test_duplicate_naming_on_ids(spark):
    df = spark.createDataFrame(
        [("U", "Born Slippy", "g1", "s1"), ("U", "Born Slippy", "g9", "s9"), ("M", "P", "g3", "s5")],
        "group_name string, song_name string, group_id string, song_id string",
    )
    assert rows(duplicate_naming(df)) == [("U", "Born Slippy", 2)]


def test_duplicate_naming_on_names_is_vacuous(spark):
    """Grouping by (group, song) and counting distinct (group, song) can
    never exceed 1 -- the published check found nothing by construction."""
    df = spark.createDataFrame(
        [("U", "Born Slippy", "g1", "s1"), ("U", "Born Slippy", "g9", "s9")],
        "group_name string, song_name string, group_id string, song_id string",
    )
    assert duplicate_naming(df, ids=("group_name", "song_name")).count() == 0


def test_group_counts_null_group_reports_zero(spark):
    df = spark.createDataFrame([("u1",), ("u1",), (None,), (None,)], "user_id string")
    assert rows(group_counts(df, "user_id")) == [(None, 0), ("u1", 2)]


def test_filter_impact(spark):
    before = spark.createDataFrame([("a",)] * 5 + [("b",)] * 3 + [(None,)] * 2, "u string")
    excluded = spark.createDataFrame([("b",), ("b",), (None,), ("z",)], "k string")
    assert rows(filter_impact(before, excluded, "u", "k")) == [(10, 5, 5)]
    assert rows(filter_impact(before, excluded.where("k = 'z'"), "u", "k")) == [(10, 8, 2)]


def test_duplicate_keys(spark):
    df = spark.createDataFrame([("Congo",), ("Congo",), ("Spain",)], "country string")
    assert rows(duplicate_keys(df, "country")) == [("Congo", 2)]


def test_preview_is_ordered(spark):
    df = spark.range(100).selectExpr("99 - id AS id")
    assert [r.id for r in preview(df, 3, "id").collect()] == [0, 1, 2]


def test_gate(spark):
    gate(spark.range(0), "empty")
    with pytest.raises(CheckFailed):
        gate(spark.range(1), "nonempty")


def test_empty_inputs(spark):
    from strata.operators import distinct_counts, filter_impact, null_profile

    empty = spark.createDataFrame([], "a string, b string")
    assert rows(null_profile(empty, ["a"])) == [(0, 0)]
    assert rows(distinct_counts(empty, {"a": ["a"]})) == [(0,)]
    assert rows(filter_impact(empty, empty, "a", "b")) == [(0, 0, 0)]


def test_profile_summary_needs_checks(spark):
    from strata.plans import profile_summary

    with pytest.raises(ValueError):
        profile_summary({})
    assert rows(profile_summary({"x": spark.range(3)})) == [("x", "rows", 3)]
