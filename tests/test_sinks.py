from helpers import rows
from strata.session import scratch_path
from strata.sinks import save_catalog_table, table_name, write_table
from strata.sinks.writers import ensure_database
from strata.sources import read_delimited, read_facts
from strata.sources.readers import read_partitioned_strings


def _facts(spark, data):
    return spark.createDataFrame(data, "user_id string, song_name string")


def test_partitioned_write_keeps_string_keys_and_null_partition(spark):
    path = scratch_path(spark, "t-part")
    n = write_table(_facts(spark, [("001", "a"), ("1", "b"), (None, "c"), ("001", "d")]), path, partition_by=["user_id"])
    assert n == 4  # rows observed by the write job
    back = read_partitioned_strings(spark, path)
    assert dict(back.dtypes)["user_id"] == "string"
    assert rows(back, "user_id", "song_name") == [(None, "c"), ("001", "a"), ("001", "d"), ("1", "b")]


def test_overwrite_replaces_whole_table(spark):
    path = scratch_path(spark, "t-over")
    write_table(_facts(spark, [("old", "x")]), path, partition_by=["user_id"])
    write_table(_facts(spark, [("new", "y")]), path, partition_by=["user_id"])
    assert rows(read_partitioned_strings(spark, path), "user_id") == [("new",)]


def test_dynamic_partition_overwrite_replaces_only_written_partitions(spark):
    path = scratch_path(spark, "t-dyn")
    write_table(_facts(spark, [("a", "1"), ("b", "2")]), path, partition_by=["user_id"])
    write_table(_facts(spark, [("b", "3")]), path, partition_by=["user_id"], dynamic_partition_overwrite=True)
    assert rows(read_partitioned_strings(spark, path), "user_id", "song_name") == [("a", "1"), ("b", "3")]


def test_rerun_is_idempotent(spark):
    path = scratch_path(spark, "t-rerun")
    df = _facts(spark, [("a", "1"), ("b", "2")])
    write_table(df, path, partition_by=["user_id"])
    first = rows(read_partitioned_strings(spark, path), "user_id", "song_name")
    write_table(df, path, partition_by=["user_id"])
    assert rows(read_partitioned_strings(spark, path), "user_id", "song_name") == first


def test_catalog_table_round_trip(spark):
    root = scratch_path(spark, "t-cat")
    ensure_database(spark, "strata_t", f"{root}/_db")
    n = save_catalog_table(_facts(spark, [("a", "1")]), "strata_t", "facts", path=f"{root}/facts", partition_by=["user_id"])
    name = table_name("strata_t", "facts")
    assert n == 1
    assert rows(spark.table(name), "user_id", "song_name") == [("a", "1")]
    save_catalog_table(_facts(spark, [("b", "2")]), "strata_t", "facts", path=f"{root}/facts", partition_by=["user_id"])
    assert rows(spark.table(name), "user_id", "song_name") == [("b", "2")]


def test_headerless_reader_binds_by_position_and_ignores_quotes(spark, tmp_path):
    p = tmp_path / "f.tsv"
    p.write_text('u1\tt\tg\tG\ts\t"Open quote\nu2\tt2\tg2\tG2\ts2\tClosed\n', encoding="utf-8")
    df = read_facts(spark, str(p))
    assert df.columns == ["user_id", "fact_date", "group_id", "group_name", "song_id", "song_name"]
    assert rows(df, "user_id", "song_name") == [("u1", '"Open quote'), ("u2", "Closed")]


def test_default_quoting_would_swallow_columns(spark, tmp_path):
    """Why quote handling is off for the facts feed."""
    p = tmp_path / "f.tsv"
    p.write_text('u1\t"Open\tx\nu2\tb\ty\n', encoding="utf-8")
    with_quotes = read_delimited(spark, str(p), sep="\t", header=False)
    without = read_delimited(spark, str(p), sep="\t", header=False, quote="")
    assert with_quotes.count() != without.count() or rows(with_quotes) != rows(without)
    assert rows(without) == [("u1", '"Open', "x"), ("u2", "b", "y")]


def test_header_padding_is_kept_then_trimmed(spark, tmp_path):
    from strata.functions import trim_headers

    p = tmp_path / "c.csv"
    p.write_text("nombre, name, iso2\nEspaña,Spain,ES\n", encoding="utf-8")
    raw = read_delimited(spark, str(p), sep=",")
    assert raw.columns == ["nombre", " name", " iso2"]
    assert trim_headers(raw).columns == ["nombre", "name", "iso2"]


def test_header_with_byte_order_mark(spark, tmp_path):
    from strata.sources import read_users

    p = tmp_path / "u.tsv"
    p.write_text("﻿#id\tcountry\tregistered\nu1\tSpain\tFeb 4, 2005\n", encoding="utf-8")
    df = read_users(spark, str(p))
    assert df.columns[0] == "#id"
    assert rows(df) == [("u1", "Spain", "Feb 4, 2005")]


def test_target_file_bytes_is_scoped_to_the_write(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    path = scratch_path(spark, "t-target")
    n = write_table(_facts(spark, [("a", "1"), ("b", "2")]), path, partition_by=["user_id"], target_file_bytes=512 * 1024 * 1024)
    assert n == 2
    assert spark.conf.get(key) == before


def test_read_layer_with_pinned_schema(spark):
    from pyspark.sql import types as T

    from strata.plans import read_layer

    root = scratch_path(spark, "t-layer-schema")
    write_table(spark.createDataFrame([("001", "x")], "code string, v string"), f"{root}/countries")
    schema = T.StructType([T.StructField("code", T.StringType()), T.StructField("v", T.StringType())])
    out = read_layer(spark, root, names=["countries"], schemas={"countries": schema})["countries"]
    assert rows(out) == [("001", "x")]


def test_bucketed_layout_bounds_directories_and_prunes(spark):
    import os

    from strata.sinks import key_bucket_filter, with_key_bucket

    facts = spark.range(2000).selectExpr("CAST(id % 500 AS STRING) AS user_id", "id")
    path = scratch_path(spark, "t-bucket")
    write_table(with_key_bucket(facts, buckets=8), path, partition_by=["user_id_bucket"])
    dirs = [d for d in os.listdir(path.replace("file:", "")) if d.startswith("user_id_bucket=")]
    assert len(dirs) <= 8
    back = spark.read.parquet(path)
    one = back.where(key_bucket_filter("42", buckets=8))
    assert sorted(r.id for r in one.collect()) == [42, 542, 1042, 1542]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(user_id_bucket" in plan


def test_trim_values_option(spark, tmp_path):
    p = tmp_path / "u.tsv"
    p.write_text("#id\tcountry\tregistered\n u1 \t Spain\tFeb 4, 2005 \n", encoding="utf-8")
    from strata.sources import read_users

    assert rows(read_users(spark, str(p))) == [(" u1 ", " Spain", "Feb 4, 2005 ")]  # kept as written
    assert rows(read_users(spark, str(p), trim_values=True)) == [("u1", "Spain", "Feb 4, 2005")]


def test_windows_line_endings(spark, tmp_path):
    from strata.plans import clean_users
    from strata.sources import read_users

    p = tmp_path / "u.tsv"
    p.write_bytes(b"#id\tcountry\tregistered\r\nu1\tSpain\tFeb 4, 2005\r\n")
    f = tmp_path / "f.tsv"
    f.write_bytes(b"u1\t2009-05-04T23:08:57Z\tg\tG\ts\tSong\r\n")
    import datetime as dt

    assert clean_users(read_users(spark, str(p))).first().register_date == dt.date(2005, 2, 4)
    assert read_facts(spark, str(f)).first().song_name == "Song"


def test_a_table_by_key_is_listed_once(spark):
    path = scratch_path(spark, "listed-once")
    df = spark.range(60).selectExpr("concat('song', id) AS song_name", "lpad(cast(id AS string), 3, '0') AS user_id")
    write_table(df, path, partition_by=["user_id"])
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("listed-once", "read")
    try:
        back = read_partitioned_strings(spark, path)
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("listed-once")]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    listings = [j for j in jobs if tracker.getStageInfo(j.stageIds[0]).numTasks > 1]  # more than 32 folders are listed by a job
    assert len(listings) == 1
    assert back.columns == ["song_name", "user_id"]
    assert rows(back, "user_id", "song_name") == rows(df, "user_id", "song_name")


def test_first_folder_without_files(spark, tmp_path):
    """The columns then come from the other folders; those of two levels of keys stay strings."""
    path = str(tmp_path / "t")
    spark.createDataFrame([("a", "01", "1"), ("b", "02", "x")], "song_name string, day string, user_id string").write.partitionBy("day", "user_id").parquet(path)
    (tmp_path / "t" / "day=00" / "user_id=0").mkdir(parents=True)
    back = read_partitioned_strings(spark, path)
    assert back.columns == ["song_name", "day", "user_id"]
    assert rows(back, "day", "user_id", "song_name") == [("01", "1", "a"), ("02", "x", "b")]


ODD_KEYS = ["a b", "100%", "a/b", "x=y", "ü+ñ", "001", None, "%41", "a%2Fb", "q?#[]{}^'\"", "tab\tx", "+", "é%zz", "a:b*c\\d"]


def test_keys_are_read_from_the_folders_names(spark, tmp_path):
    """Keys with signs that Spark escapes, in two levels and under a folder that looks like a key's."""
    path = str(tmp_path / "x=1 %20" / "t")
    df = spark.createDataFrame([(v, f"+ %{i}", str(i)) for i, v in enumerate(ODD_KEYS)], "user_id string, `#day` string, n string")
    write_table(df, path, partition_by=["#day", "user_id"])
    back = read_partitioned_strings(spark, path)
    assert back.dtypes == [("n", "string"), ("#day", "string"), ("user_id", "string")]
    assert rows(back, "n", "#day", "user_id") == rows(df, "n", "#day", "user_id")
    plain = spark.read.schema("n string, `#day` string, user_id string").parquet(path)
    assert rows(back) == rows(plain)


def test_a_key_whose_name_escapes_nothing(spark, tmp_path):
    spark.createDataFrame([("z",)], "n string").write.parquet(str(tmp_path / "t" / "user_id=100%"))
    assert rows(read_partitioned_strings(spark, str(tmp_path / "t"))) == [("z", "100%")]


def test_folders_are_not_listed_beside_their_files(spark):
    """Spark's list of partitions takes time by the square of the folders, and memory that the files' list takes already."""
    path = scratch_path(spark, "t-no-folders")
    write_table(_facts(spark, [(f"{i:03}", "a") for i in range(40)]), path, partition_by=["user_id"])
    back = read_partitioned_strings(spark, path)
    source = back._jdf.queryExecution().optimizedPlan().collectLeaves().head().relation().location()
    assert source.partitionSpec().partitions().isEmpty()
    assert back.where("user_id IS NOT NULL").count() == 40


def test_a_filter_on_the_key_leaves_other_files_unread(spark, tmp_path):
    path = tmp_path / "t"
    write_table(_facts(spark, [("a", "1"), ("b", "2")]), str(path), partition_by=["user_id"])
    back = read_partitioned_strings(spark, str(path))
    for f in (path / "user_id=b").iterdir():
        f.write_bytes(b"no Parquet") if f.suffix == ".parquet" else f.unlink()
    assert rows(back.where("user_id = 'a'")) == [("1", "a")]
    assert back.where("user_id = 'c'").count() == 0


def test_files_beside_the_folders_are_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(_facts(spark, [("a", "1")]), path, partition_by=["user_id"])
    spark.createDataFrame([("2",)], "song_name string").write.mode("append").parquet(path)
    assert rows(read_partitioned_strings(spark, path)) == [("1", "a")]
