from __future__ import annotations

import gzip
import io
import os

import pytest
from pyspark.sql import functions as F

from strata.llm.warc import digest, file_system, inflated, marked, normalise, parse_head, read_records, record, split_records, warc_round_trip, write_archives

SCHEMA = "page_id bigint, url string, html string"


def test_records_split_however_the_stream_is_cut():
    records = [record(i, f"http://x/{i} y", bytes([i]) * (i * 37) + b"\r\n\r\nWARC/1.1\r\n", None, False) for i in range(20)]
    data = b"".join(records)
    for size in (1, 7, 100, 10_000):
        pieces = (data[i : i + size] for i in range(0, len(data), size))
        assert list(split_records(pieces)) == records
    with pytest.raises(ValueError):
        list(split_records(iter([data[:-1]])))
    one, many = gzip.compress(data), b"".join(gzip.compress(r) for r in records)
    for packed in (one, many):
        assert b"".join(inflated(io.BytesIO(packed), 50)) == data
    assert parse_head(records[3][: records[3].index(b"\r\n\r\n")])["warc-target-uri"] == "http://x/3%20y"


def test_round_trip(spark, tmp_path):
    rows = [(1, "http://a", "same"), (5, "http://b", "same"), (3, None, "same"), (2, "http://c\r\nX: y", "é" * 50_000), (4, "u", None), (6, "u", ""), (None, "u", "same"), (5, "http://b", "same"), (None, "u", "only")]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as payload", "'y' as archive", "'z' as keeper").repartition(3)
    got = warc_round_trip(frame, folder=f"file://{tmp_path}/w").collect()
    assert len(got) == 9
    for r in got:
        html = next((h for p, _, h in rows if p == r.page_id and r.page_id is not None), None) or ""
        if r.page_id is not None:
            assert (r.payload_bytes, r.payload_digest) == (len(html.encode()), digest(html.encode()))
        assert (bytes(r.payload).decode() == html if r.page_id is not None else True) if r.record_type == "response" else r.payload is None
    by = sorted(((r.page_id, r.record_type, r.refers_to) for r in got), key=str)
    assert by == sorted([(1, "revisit", 5), (5, "response", None), (5, "response", None), (3, "revisit", 5), (2, "response", None), (4, "revisit", 6), (6, "response", None), (None, "revisit", 5), (None, "response", None)], key=str)
    small = warc_round_trip(frame.where("page_id is not null"), min_bytes=5).where("record_type = 'revisit'")
    assert small.count() == 0


def test_every_record_is_a_member_at_its_offset(spark, tmp_path):
    rows = [(i, f"http://h/{i}", "text " * (i % 50)) for i in range(200)]
    pages = marked(spark.createDataFrame(rows, SCHEMA).select("page_id", "url", F.encode("html", "UTF-8").alias("payload")).coalesce(2))
    archives = write_archives(pages, str(tmp_path))
    for r in archives.collect():
        with open(r.archive, "rb") as f:
            assert f.read(3) == b"\x1f\x8b\x08"
        assert gzip.open(r.archive).read().count(b"WARC-Record-ID") == r.records
    ranges = normalise(archives)
    n = 0
    for r in ranges.collect():
        assert os.path.getsize(r.archive) == r.stop
        data = open(r.archive, "rb").read()
        for line in open(r.sidecar):
            at, length, kind, name = line.split()
            member = gzip.decompress(data[int(at) : int(at) + int(length)])
            assert member.startswith(b"WARC/1.1") and name.encode() in member
            n += 1
    assert n == 200 == read_records(ranges).count()


def test_empty_table(spark):
    assert warc_round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


def test_paths():
    assert file_system("file:///a/b")[1] == file_system("file:/a/b")[1] == file_system("/a/b")[1] == "/a/b"


def test_a_task_an_archive_and_a_range(spark, tmp_path, monkeypatch):
    """Archives are rewritten, and their ranges read, by as many tasks as there are of them."""
    from strata.llm import warc

    monkeypatch.setattr(warc, "RANGE_BYTES", 2000)
    rows = [(i, f"http://h/{i}", f"{i} " * (i % 90)) for i in range(600)]
    pages = marked(spark.createDataFrame(rows, SCHEMA).select("page_id", "url", F.encode("html", "UTF-8").alias("payload")).repartition(6))
    archives = write_archives(pages, str(tmp_path))
    assert archives.count() == 6
    ranges = normalise(archives)
    assert ranges.select(F.input_file_name()).distinct().count() == 6  # a file a task
    assert ranges.count() > 20
    records = read_records(ranges)
    own = records.where("payload is not null").groupBy(F.spark_partition_id()).count().collect()
    assert len(own) >= ranges.count() * 0.8
    assert sorted(r.page_id for r in records.collect()) == list(range(600))


def test_like_recomputed(spark, tmp_path):
    """Kinds, lengths, digests and references of a random table with many equal payloads, from the rows alone."""
    import random

    rng = random.Random(10)
    rows = [(rng.randrange(400), rng.choice([None, f"http://u/{i}"]), rng.choice([None, "", "a" * 300, "é\r\n\r\nWARC/1.0", f"<p>{rng.randrange(40)}</p>" * rng.randrange(1, 60)])) for i in range(500)]
    rows = list({r[0]: r for r in rows}.values())
    got = {r.page_id: r for r in warc_round_trip(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    keeper = {}
    for page, _, html in rows:
        keeper[html or ""] = max(page, keeper.get(html or "", -1))
    assert got.keys() == {r[0] for r in rows}
    for page, url, html in rows:
        payload, r = (html or "").encode(), got[page]
        first = keeper[html or ""]
        assert (r.payload_bytes, r.payload_digest, r.url) == (len(payload), digest(payload), url or f"urn:page:{page}")
        assert (r.record_type, r.refers_to) == (("response", None) if first == page else ("revisit", first))
        assert r.payload == (payload if first == page else None)
