"""Exact distinct counts by bitmap."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from strata.operators.distinct import count_bitmaps, distinct_bitmaps, numbered, publish_bitmaps, read_bitmaps

SETS = {"users": ["user"], "pairs": ["user", "song name"]}


def some(n, seed):
    rnd = random.Random(seed)
    user = lambda: rnd.choice([None, "", "hot", "hot", *(f"u{i}" for i in range(200))])
    return [(rnd.choice([None, 1, 2, 3]), user(), rnd.choice([None, 1, 2, 3])) for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "month int, user string, `song name` int")


def brute(rows):
    out = {}
    for month, user, song in rows:
        for at in (month, "all"):
            out.setdefault((at, "users"), set()).add(user)
            out.setdefault((at, "pairs"), set()).add((user, song))
    return {k: len(v) for k, v in out.items()}


def counted(bitmaps):
    by = {(r.month, r.column_set): r.n for r in count_bitmaps(bitmaps, ["month"]).collect()}
    return {**by, **{("all", r.column_set): r.n for r in count_bitmaps(bitmaps).collect()}}


def test_counts_like_sets(spark):
    rows = some(3000, 1)
    assert counted(distinct_bitmaps(frame(spark, rows), SETS, ["month"])) == brute(rows)


@pytest.mark.parametrize("part_rows", [10**6, 700])
def test_numbers_have_no_gaps(spark, part_rows):
    values = spark.range(5000).selectExpr("nullif(id, 7) AS a", "'x' AS b")
    ids = sorted(r.id for r in numbered(values, 11, part_rows).collect())
    assert ids == list(range(11, 5011))


def test_more_values_than_a_bitmap_row_holds(spark):
    df = spark.range(100_000).selectExpr("cast(id % 2 AS int) AS month", "cast(id AS string) AS user", "1 AS `song name`")
    bitmaps = distinct_bitmaps(df, {"users": ["user"]}, ["month"])
    assert bitmaps.agg(F.max("bucket"), F.count("*")).first()[:] == (4, 8)  # 100,000 numbers are four rows a part
    assert {(r.month, r.n) for r in count_bitmaps(bitmaps, ["month"]).collect()} == {(0, 50_000), (1, 50_000)}


def test_runs_add_up_and_may_be_repeated(spark, tmp_path):
    path = str(tmp_path / "distinct")
    first, second = some(800, 2), [*some(800, 3), (9, "late", 4)]
    publish_bitmaps(frame(spark, first), path, SETS, ["month"])
    numbers = {r.user: r.id for r in spark.read.parquet(f"{path}/dictionary/users").collect()}
    assert counted(read_bitmaps(spark, path)) == brute(first)
    for _ in range(2):
        publish_bitmaps(frame(spark, second), path, SETS, ["month"])
        assert counted(read_bitmaps(spark, path)) == brute(first + second)
    after = [(r.user, r.id) for r in spark.read.parquet(f"{path}/dictionary/users").collect()]
    assert numbers.items() <= dict(after).items() and len({i for _, i in after}) == len(after)


def test_one_shuffle_of_the_facts(spark, tmp_path):
    frame(spark, some(2000, 4)).write.parquet(str(tmp_path / "facts"))
    plan = distinct_bitmaps(spark.read.parquet(str(tmp_path / "facts")), SETS, ["month"])._jdf.queryExecution().toString()
    assert str(tmp_path / "facts") not in plan  # the bitmaps are made of the distinct rows


def test_empty_tables_and_wrong_names(spark, tmp_path):
    none = frame(spark, [])
    assert count_bitmaps(distinct_bitmaps(none, SETS, ["month"]), ["month"]).count() == 0
    publish_bitmaps(none, str(tmp_path / "d"), SETS, ["month"])
    publish_bitmaps(frame(spark, [(1, "a", 1)]), str(tmp_path / "d"), SETS, ["month"])
    assert counted(read_bitmaps(spark, str(tmp_path / "d"))) == brute([(1, "a", 1)])
    with pytest.raises(ValueError, match="bits"):
        distinct_bitmaps(none.withColumn("bits", F.lit(1)), SETS, ["bits"])
    with pytest.raises(ValueError, match="no column set"):
        distinct_bitmaps(none, {})
