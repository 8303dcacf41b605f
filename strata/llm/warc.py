"""WARC: archives as one gzip stream, normalised to a member a record.

``write_archives`` writes pages as WARC records; a task's file is one gzip
member, as some crawlers leave it, which can only be read from its start.
``normalise`` inflates each such stream once, in pieces of bounded size, writes
every record as a member of its own and, beside the archive, a sidecar index of
offsets. ``read_records`` reads ranges of archives by that index, in parallel.

Files go through ``pyarrow.fs`` to the folder given (by default in the shared
folder of ``spark.checkpoint.dir``). Each attempt of a task writes files of its
own; a manifest table, written when the tasks are done, names the ones that
count, so lost executors and repeated tasks leave unused files, not wrong ones.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ship, stored
from strata.session import scratch_path

ARCHIVE_BYTES = 1 << 30  # of records, before a task starts another archive
RANGE_BYTES = 32 << 20  # of a normalised archive that one row of the manifest covers
LEVEL = 6
DATE = "1970-01-01T00:00:00Z"  # pages have no time of capture
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the URL namespace of RFC 4122
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
MANIFEST = "archive string, sidecar string, start bigint, stop bigint, records bigint, side_start bigint, side_stop bigint"
RECORD = "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary"


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path within it."""
    local = re.sub(r"^file:/*", "/", path)
    return (fs.LocalFileSystem(), local) if local.startswith("/") else fs.FileSystem.from_uri(path)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'page:{page}')}>"


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record, uncompressed. A revisit has the HTTP header alone as its block."""
    block = _HTTP.format(len(payload)).encode() + (b"" if revisit else payload)
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url) if url else f"urn:page:{page}"
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": _record_id(page),
        "WARC-Date": DATE,
        "WARC-Target-URI": target,
        "WARC-Payload-Digest": f"sha1:{digest(payload)}",
        "X-Payload-Length": len(payload),
    }
    if page is not None:
        head["X-Page-Id"] = page
    if revisit:
        head |= {"WARC-Profile": _REVISIT, "WARC-Refers-To": _record_id(refers_to), "X-Refers-To-Page": refers_to}
    head |= {"Content-Type": "application/http; msgtype=response", "Content-Length": len(block)}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode("utf-8", "replace") + b"\r\n" + block + b"\r\n\r\n"


def parse_head(data: bytes) -> dict[str, str]:
    """Header fields, by lower-case name."""
    first, _, rest = data.partition(b"\r\n")
    if not first.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {first[:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in rest.decode("utf-8", "replace").split("\r\n") if x)}


def split_records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records of a stream that comes in pieces; holds one record and a piece."""
    held, need = bytearray(), 0
    for piece in pieces:
        held += piece
        while len(held) >= max(need, 1):
            if not need:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                need = end + 4 + int(parse_head(bytes(held[:end]))["content-length"]) + 4
                continue
            yield bytes(held[:need])
            del held[:need]
            need = 0
    if held:
        raise ValueError(f"the archive ends within a record ({len(held)} bytes left)")


def inflated(stream: object, size: int = 1 << 20) -> Iterator[bytes]:
    """Pieces of at most ``size`` bytes of a gzip stream of one member or several."""
    unzip = zlib.decompressobj(31)
    while data := stream.read(size):
        while data:
            out = unzip.decompress(data, size)
            if out:
                yield out
            data = unzip.unconsumed_tail
            if unzip.eof:
                data, unzip = unzip.unused_data, zlib.decompressobj(31)


def marked(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``pages`` (page_id, url, payload) with ``keeper``: the page that answers for this payload.

    Of pages with equal payloads of ``min_bytes`` bytes or more it is the
    largest id; payloads are grouped by their SHA-1 and length. Groups are
    counted before the shuffle and only those of two pages or more are joined.
    """
    pages = pages.withColumns({"_sha": F.sha1("payload"), "_n": F.octet_length("payload")})
    groups = pages.where(F.col("_n") >= min_bytes).groupBy("_sha", "_n").agg(F.max("page_id").alias("keeper"), F.count("*").alias("_c"))
    groups = stored(groups.where("_c > 1").drop("_c"), "payload-groups")
    return pages.join(groups, ["_sha", "_n"], "left").select("page_id", "url", "payload", "keeper")


def write_archives(pages: DataFrame, folder: str, level: int = LEVEL) -> DataFrame:
    """Write ``marked`` pages as WARC files of one gzip member each; returns (archive, records)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, pack, path, records, size = None, None, "", 0, 0

        def closed() -> pa.RecordBatch:
            out.write(pack.flush())
            out.close()
            return pa.RecordBatch.from_pydict({"archive": [path], "records": pa.array([records], pa.int64())})

        for b in batches:
            for page, url, payload, keeper in zip(*(b.column(c) for c in ("page_id", "url", "payload", "keeper"))):
                if out is None:
                    path, records, size = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    system, name = file_system(path)
                    system.create_dir(name.rpartition("/")[0], recursive=True)
                    out, pack = system.open_output_stream(name, compression=None), zlib.compressobj(level, zlib.DEFLATED, 31)
                page, keeper = page.as_py(), keeper.as_py()
                data = record(page, url.as_py(), payload.as_py() or b"", keeper, keeper is not None and keeper != page)
                out.write(pack.compress(data))
                records, size = records + 1, size + len(data)
                if size >= ARCHIVE_BYTES:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return stored(pages.mapInArrow(run, "archive string, records bigint"), "warc-manifest")


def normalise(archives: DataFrame, level: int = LEVEL) -> DataFrame:
    """Rewrite archives with a member for each record, beside them, with a sidecar index.

    Takes a column ``archive`` of paths of gzip WARC files (one member or many)
    and returns ranges of the new ones: archive, sidecar, start, stop, records, and
    the bytes of the sidecar that tell of them. A line of the sidecar is offset,
    length, type and record id of a record. An archive is one task's.
    """
    ship(archives.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column("archive").to_pylist():
                system, name = file_system(path)
                stem = f"{path.removesuffix('.gz').removesuffix('.warc')}-{uuid.uuid4().hex[:8]}"
                new, side = f"{stem}.members.warc.gz", f"{stem}.idx"
                at, start, n, ranges = 0, 0, 0, []
                told, told_from = 0, 0  # bytes of the sidecar
                with system.open_input_stream(name, compression=None) as source, system.open_output_stream(file_system(new)[1], compression=None) as out, system.open_output_stream(file_system(side)[1], compression=None) as index:
                    for data in split_records(inflated(source)):
                        head = parse_head(data[: data.index(b"\r\n\r\n")])
                        pack = zlib.compressobj(level, zlib.DEFLATED, 31)
                        member = pack.compress(data) + pack.flush()
                        out.write(member)
                        line = f"{at} {len(member)} {head['warc-type']} {head['warc-record-id']}\n".encode()
                        index.write(line)
                        at, n, told = at + len(member), n + 1, told + len(line)
                        if at - start >= RANGE_BYTES:
                            ranges.append((new, side, start, at, n, told_from, told))
                            start, n, told_from = at, 0, told
                if n:
                    ranges.append((new, side, start, at, n, told_from, told))
                kinds = (pa.string(), pa.string(), *[pa.int64()] * 5)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*ranges)) or [[]] * 7, kinds)], names=[c.split()[0] for c in MANIFEST.split(", ")])

    # a number of its own, which AQE leaves as it is: the rows are few, the work behind each is not
    files = archives.select("archive").repartitionByRange(max(archives.count(), 1), "archive")
    return stored(files.mapInArrow(run, MANIFEST), "warc-index")


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def read_records(ranges: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records of ranges of normalised archives, member by member.

    Length and digest of a response are taken from its payload, and the digest
    is held against the header's; a revisit has those of its header.
    """

    def one(data: bytes) -> tuple:
        cut = data.index(b"\r\n\r\n")
        head = parse_head(data[:cut])
        block = data[cut + 4 : cut + 4 + int(head["content-length"])]
        said, kind = head["warc-payload-digest"].removeprefix("sha1:"), head["warc-type"]
        payload, n, found = None, int(head["x-payload-length"]), said
        if kind == "response":
            payload = block.partition(b"\r\n\r\n")[2]
            n, found = len(payload), digest(payload)
            if found != said:
                raise ValueError(f"payload of {head['warc-record-id']} has digest {found}, its header says {said}")
        return _number(head.get("x-page-id")), head["warc-target-uri"], kind, _number(head.get("x-refers-to-page")), n, found, payload if with_payload else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        names = [c.split()[0] for c in RECORD.split(", ")]
        for b in batches:
            for archive, side, begin, end in zip(*(b.column(c).to_pylist() for c in ("archive", "sidecar", "side_start", "side_stop"))):
                system, name = file_system(archive)
                rows, size = [], 0
                with system.open_input_file(file_system(side)[1]) as index, system.open_input_file(name) as source:
                    for line in _lines(index, begin, end):
                        at, length, _ = line.split(" ", 2)
                        source.seek(int(at))
                        rows.append(one(zlib.decompress(source.read(int(length)), 31)))
                        size += rows[-1][4]
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return ranges.repartitionByRange(max(ranges.count(), 1), "archive", "start").mapInArrow(run, RECORD)


def _lines(file: object, begin: int, end: int) -> Iterator[str]:
    """Lines of a part of a file that ends with a line."""
    file.seek(begin)
    held = b""
    while begin < end and (data := file.read(min(1 << 20, end - begin))):
        begin += len(data)
        *whole, held = (held + data).split(b"\n")
        yield from (x.decode() for x in whole)


def warc_round_trip(pages: DataFrame, folder: str | None = None, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", min_bytes: int = 0, with_payload: bool = True) -> DataFrame:
    """Write ``pages`` as archives, normalise them, and read every record back (``RECORD``).

    Null html is an empty payload, null url the target ``urn:page:<id>``. Pages
    with equal payloads: that with the largest id is the response (so are rows
    that repeat its id), the others revisit it; a null id revisits a page with
    an id, and pages whose ids are all null are all responses. Extra columns are
    ignored. No pages, no archives and no records.
    """
    spark = pages.sparkSession
    ship(spark)
    folder = folder or scratch_path(spark, "llm-warc")
    rows = pages.select(
        pages[id_column].cast("bigint").alias("page_id"),
        pages[url_column].alias("url"),
        F.encode(F.coalesce(pages[html_column], F.lit("")), "UTF-8").alias("payload"),
    )
    return read_records(normalise(write_archives(marked(rows, min_bytes), folder)), with_payload)
