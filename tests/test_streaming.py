import os

import pytest

from helpers import FACTS_TSV, rows
from strata.plans import clean_facts
from strata.session import scratch_path
from strata.sources import read_facts
from strata.streaming import ForeignTargetError, batches, read_streamed_facts, start_curated_facts


def _drop(dirpath, name, lines):
    os.makedirs(dirpath, exist_ok=True)
    tmp = os.path.join(dirpath, "." + name)
    with open(tmp, "w", encoding="utf-8") as fh:
        fh.write("".join("\t".join(r) + "\n" for r in lines))
    os.rename(tmp, os.path.join(dirpath, name))  # files appear atomically


def test_stream_matches_batch_and_resumes_from_checkpoint(spark, raw, tmp_path):
    src = str(tmp_path / "incoming")
    target = scratch_path(spark, "t-stream")
    ckpt = scratch_path(spark, "t-stream-ckpt")
    _drop(src, "part1.tsv", FACTS_TSV[:4])
    start_curated_facts(spark, src, raw["users"], target, checkpoint=ckpt).awaitTermination()
    first = read_streamed_facts(spark, target).count()
    # a second file arrives; the restarted query only processes the new one
    _drop(src, "part2.tsv", FACTS_TSV[4:])
    start_curated_facts(spark, src, raw["users"], target, checkpoint=ckpt).awaitTermination()
    out = read_streamed_facts(spark, target)
    batch = clean_facts(read_facts(spark, os.path.join(str(tmp_path), "incoming")), raw["users"])
    cols = ["user_id", "fact_date", "group_id", "group_name", "song_id", "song_name"]
    assert first == 3  # null user dropped from the first file
    assert rows(out, *cols) == rows(batch, *cols)
    assert out.count() == 6


def _facts_file(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(f"{u}\t2009-05-04T23:08:57Z\tg\tG\ts\t{s}\n" for u, s in lines), encoding="utf-8")


def test_runs_without_a_named_checkpoint_continue(spark, raw, tmp_path):
    src, target = tmp_path / "in", str(tmp_path / "facts")
    _facts_file(src, "a.tsv", [("u1", f"a{i}") for i in range(5)])
    start_curated_facts(spark, str(src), raw["users"], target).awaitTermination()
    _facts_file(src, "b.tsv", [("u2", f"b{i}") for i in range(7)])
    start_curated_facts(spark, str(src), raw["users"], target).awaitTermination()
    assert read_streamed_facts(spark, target).count() == 12
    start_curated_facts(spark, str(src), raw["users"], target).awaitTermination()
    assert read_streamed_facts(spark, target).count() == 12


def test_a_batch_table_is_refused_and_stays_whole(spark, raw, tmp_path):
    from strata.plans import clean_facts
    from strata.sinks import write_table

    target = str(tmp_path / "facts")
    write_table(clean_facts(raw["facts"], raw["users"]), target, partition_by=["user_id"])
    before = spark.read.parquet(target).count()
    _facts_file(tmp_path / "in", "a.tsv", [("u1", "a")])
    with pytest.raises(ForeignTargetError):
        start_curated_facts(spark, str(tmp_path / "in"), raw["users"], target)
    own = str(tmp_path / "facts_stream")
    start_curated_facts(spark, str(tmp_path / "in"), raw["users"], own).awaitTermination()
    assert spark.read.parquet(target).count() == before == 6
    assert read_streamed_facts(spark, own).count() == 1
    with pytest.raises(ForeignTargetError):  # the target's log needs the checkpoint that wrote it
        start_curated_facts(spark, str(tmp_path / "in"), raw["users"], own, checkpoint=str(tmp_path / "other"))


def test_list_that_is_empty_at_first(spark, tmp_path):
    """A user who becomes invalid after the query was built is excluded later on."""
    from strata.sources import read_users

    users = tmp_path / "users.tsv"
    users.write_text("#id\tcountry\tregistered\nu1\tSpain\tFeb 4, 2005\nu2\tSpain\tFeb 4, 2005\n", encoding="utf-8")
    frame = read_users(spark, str(users))
    src, target = tmp_path / "in", str(tmp_path / "facts")
    _facts_file(src, "a.tsv", [("u1", "a"), ("u2", "a")] * 20)
    start_curated_facts(spark, str(src), frame, target).awaitTermination()
    assert read_streamed_facts(spark, target).count() == 40
    users.write_text("#id\tcountry\tregistered\nu1\tSpain\tFeb 4, 2005\nu2\tSpain\t\n", encoding="utf-8")
    _facts_file(src, "b.tsv", [("u1", "b"), ("u2", "b")] * 20)
    start_curated_facts(spark, str(src), read_users(spark, str(users)), target).awaitTermination()
    assert read_streamed_facts(spark, target).count() == 60


def _files(folder):
    return [f for f in folder.rglob("*.parquet")]


def test_replayed_batch_is_published_once(spark, tmp_path):
    """A batch whose commit was lost runs again over what it wrote, with the list as it is then."""
    from strata.sources import read_users

    users = tmp_path / "users.tsv"
    head = "#id\tcountry\tregistered\n"
    users.write_text(head + "".join(f"u{k}\tSpain\tFeb 4, 2005\n" for k in range(4)), encoding="utf-8")
    src, target = tmp_path / "in", tmp_path / "facts"
    run = lambda: start_curated_facts(spark, str(src), lambda: read_users(spark, str(users)), str(target)).awaitTermination()
    _facts_file(src, "a.tsv", [(f"u{i % 4}", f"a{i}") for i in range(400)])
    run()
    _facts_file(src, "b.tsv", [(f"u{i % 4}", f"b{i}") for i in range(40)])
    run()
    before = sorted(map(tuple, read_streamed_facts(spark, str(target)).collect()))
    assert len(before) == 440
    assert len(_files(target)) <= 2 * 4 * 2  # two files a user and run at most
    assert sorted(map(tuple, batches(spark, str(target)).select("batch_id", "rows", "read").collect())) == [(0, 400, 400), (1, 40, 40)]

    for f in (tmp_path / "facts_checkpoint" / "commits").glob("*1*"):  # the driver died before the commit of batch 1
        f.unlink()
    run()
    assert sorted(map(tuple, read_streamed_facts(spark, str(target)).collect())) == before
    for f in (tmp_path / "facts_checkpoint" / "commits").glob("*1*"):
        f.unlink()
    users.write_text(head + "u0\tSpain\t\n" + "".join(f"u{k}\tSpain\tFeb 4, 2005\n" for k in range(1, 4)), encoding="utf-8")
    run()
    assert read_streamed_facts(spark, str(target)).count() == 430


def test_unfinished_batch_is_not_read(spark, raw, tmp_path):
    src, target = tmp_path / "in", tmp_path / "facts"
    _facts_file(src, "a.tsv", [("u1", "a"), ("u2", "a")])
    start_curated_facts(spark, str(src), raw["users"], str(target)).awaitTermination()
    read_streamed_facts(spark, str(target)).write.parquet(str(target / "batch_id=1" / "user_id=u1"))  # a batch without its note
    assert spark.read.option("basePath", str(target)).parquet(str(target)).count() == 4
    assert read_streamed_facts(spark, str(target)).count() == 2


def test_hot_user_and_buckets(spark, raw, tmp_path):
    """Files are bounded by rows; with buckets the folders do not follow the users."""
    src = tmp_path / "in"
    _facts_file(src, "a.tsv", [("u1", f"a{i}") for i in range(900)] + [(f"x{i}", "b") for i in range(100)])
    start_curated_facts(spark, str(src), raw["users"], str(tmp_path / "rows"), max_records_per_file=300).awaitTermination()
    assert len(_files(tmp_path / "rows" / "batch_id=0" / "user_id=u1")) >= 3
    assert read_streamed_facts(spark, str(tmp_path / "rows")).count() == 1000
    start_curated_facts(spark, str(src), raw["users"], str(tmp_path / "hash"), buckets=4).awaitTermination()
    assert len([p for p in (tmp_path / "hash" / "batch_id=0").iterdir() if p.is_dir()]) == 4
    got = read_streamed_facts(spark, str(tmp_path / "hash"))
    assert rows(got, "user_id", "song_name") == rows(read_streamed_facts(spark, str(tmp_path / "rows")), "user_id", "song_name")


def test_streamed_facts_are_read_without_a_list_of_folders(spark, raw, tmp_path):
    """A folder for each batch and user: the driver holds their files once, not their folders beside them."""
    src, target = tmp_path / "in", str(tmp_path / "facts")
    for k in range(2):
        _facts_file(src, f"{k}.tsv", [(f"x{i:02}", f"{k}") for i in range(20)])
        start_curated_facts(spark, str(src), raw["users"], target).awaitTermination()
    back = read_streamed_facts(spark, target)
    sources = back._jdf.queryExecution().optimizedPlan().collectLeaves()
    lists = [sources.apply(i).relation().location().partitionSpec().partitions() for i in range(sources.size())]
    assert lists and all(found.isEmpty() for found in lists)
    assert rows(back, "user_id", "song_name") == [(f"x{i:02}", f"{k}") for i in range(20) for k in range(2)]
