"""Exclusion, buckets, sessions and layouts: behaviour that does not depend on when a plan was built."""

from __future__ import annotations

import pytest

from strata.operators import exclude_keys
from strata.plans import clean_facts, read_layer, run_curated, run_refined
from strata.session import checkpoint_root, names_in, require_persistent_catalog, scratch_path
from strata.sinks.writers import ensure_database, key_bucket_filter, with_key_bucket, write_table
from strata.sources import read_users


def test_exclusion_sees_a_list_that_grows_after_the_frame_was_built(spark, raw, tmp_path):
    users = tmp_path / "users.tsv"
    users.write_text("#id\tcountry\tregistered\nu1\tSpain\tFeb 4, 2005\n", encoding="utf-8")
    frame = clean_facts(raw["facts"], read_users(spark, str(users)))
    assert frame.count() == 7
    users.write_text("#id\tcountry\tregistered\nu1\tSpain\t\n", encoding="utf-8")
    assert clean_facts(raw["facts"], read_users(spark, str(users))).count() == 5
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan


def test_bounds_are_not_compared_by_identity(spark):
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    bad = spark.createDataFrame([("b",)], "k string")
    spark.conf.set("spark.strata.broadcast.maxRows", "-1")
    try:
        plan = exclude_keys(df, bad, "k", broadcast_max_rows=1_000_000)._jdf.queryExecution().optimizedPlan().toString()
        assert "broadcast" in plan  # the argument wins, also when it equals the default
        assert "broadcast" not in exclude_keys(df, bad, "k")._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.strata.broadcast.maxRows")


@pytest.mark.parametrize("kind,values", [("bigint", [5, 7]), ("int", [5, 7]), ("string", ["5", "007"])])
def test_key_bucket_filter_finds_every_row(spark, tmp_path, kind, values):
    rows = [(v,) for v in values] * 3 + [(None,)] * 2
    path = str(tmp_path / kind)
    write_table(with_key_bucket(spark.createDataFrame(rows, f"user_id {kind}"), buckets=8), path, partition_by=["user_id_bucket"])
    back = spark.read.parquet(path)
    for v in values:
        assert back.where(key_bucket_filter(v, buckets=8)).count() == 3
    assert back.where(key_bucket_filter(None, buckets=8)).count() == 2


def test_bucket_layout_of_a_layer(spark, raw_paths):
    root = scratch_path(spark, "bucket-layers")
    run_curated(spark, raw_paths, f"{root}/curated", log_path=f"{root}/log", buckets=4)
    run_refined(spark, f"{root}/curated", f"{root}/refined", log_path=f"{root}/log", buckets=4)
    for layer in ("curated", "refined"):
        folders = [n for n in names_in(spark, f"{root}/{layer}/facts") if "=" in n]
        assert folders and len(folders) <= 4 and all(n.startswith("user_id_bucket=") for n in folders)
        facts = read_layer(spark, f"{root}/{layer}")["facts"]
        assert facts.count() == 6
        assert facts.where(key_bucket_filter("u1", buckets=4)).count() == 2
    with pytest.raises(ValueError):
        run_refined(spark, f"{root}/curated", f"{root}/curated/")


def test_a_database_needs_a_persistent_catalog(spark):
    with pytest.raises(RuntimeError, match="persistent catalog"):
        require_persistent_catalog(spark)


def test_database_location_with_a_quote(spark, tmp_path):
    ensure_database(spark, "quoted_db", str(tmp_path / "it's"))
    assert "quoted_db" in [d.name for d in spark.catalog.listDatabases()]


def test_scratch_folder_off_local_mode(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        _jsparkSession = None
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="shared folder"):
        checkpoint_root(Session())
