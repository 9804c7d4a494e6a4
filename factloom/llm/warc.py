"""WARC archives: written by executors, indexed first, read by coalesced byte ranges.

Each task writes archives of gzip members, one per record, and returns an index row per
record: file, offset, length, URL, digest.  A reader selects rows of the index, sorts the
byte ranges of a file, joins neighbouring ranges and fetches each joined range at once.

Payloads of at least ``REVISIT_BYTES`` that are equal are stored once: the record with the
largest id is the response, others are revisits that name it.  Records with the id of the
response are responses too.  A null payload is empty; a null id never is a response that
others refer to, and is a revisit where another record can be.  File names carry the task's
attempt, so a task that runs twice harms nothing: the index names the files that count.
"""

from __future__ import annotations

import gzip
import hashlib
import base64
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .shared import arrow_map, fresh_path, slices, stored

REVISIT_BYTES = 1000
ARCHIVE_BYTES = 256 << 20
GAP = 64 << 10  # bytes between two ranges that are read along
SPAN = 8 << 20  # bytes of a joined range
TASK_BYTES = 4 << 20  # compressed bytes that a task reads back, about
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = "urn:page:"
INDEX = "page_id long, url string, digest string, record_type string, file string, offset long, length long"
READ = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def base32(digest: str) -> str:
    return base64.b32encode(bytes.fromhex(digest)).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record; a revisit keeps the HTTP head and leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<{ID}{'' if page_id is None else page_id}>",
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Target-URI": None if url is None else quote(url, safe="".join(map(chr, range(0x21, 0x7F))).replace("%", "")),
        "WARC-Payload-Digest": f"sha1:{base32(digest)}",
        "WARC-Refers-To": None if refers_to is None else f"<{ID}{refers_to}>",
        "WARC-Profile": None if refers_to is None else PROFILE,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    }
    lines = "".join(f"{name}: {value}\r\n" for name, value in head.items() if value is not None)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])]


def number(value: str | None) -> int | None:
    found = re.fullmatch(f"<{ID}(-?\\d+)>", value or "")
    return int(found[1]) if found else None


def location(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if re.match(r"\w+:", path) else f"file://{path}")


class Archive:
    """The archive file a task is writing."""

    def __init__(self, folder: str):
        store, root = location(folder)
        context = TaskContext.get()
        self.name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}.warc.gz"
        store.create_dir(root, recursive=True)
        self.out, self.size = store.open_output_stream(f"{root}/{self.name}", compression=None), 0

    def add(self, data: bytes) -> tuple[int, int]:
        member = gzip.compress(data, 6, mtime=0)
        self.out.write(member)
        self.size += len(member)
        return self.size - len(member), len(member)


def with_references(pages: DataFrame, payload: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``payload``, ``digest`` and ``refers_to`` of every page."""
    body = F.coalesce(F.encode(F.col(payload).cast("string"), "UTF-8"), F.lit("").cast("binary"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), body.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    same = rows.where(F.col("size") >= REVISIT_BYTES).groupBy("digest", "size").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return rows.join(same, ["digest", "size"], "left").select("page_id", "url", "payload", "digest", refers.alias("refers_to"))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record per page below ``folder``; the index is stored and returned."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("digest", pa.string()), ("record_type", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = None
        for batch in slices(batches):
            rows = []
            for page_id, url, payload, digest, refers_to in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if archive is None or archive.size > ARCHIVE_BYTES:
                    if archive:
                        archive.out.close()
                    archive = Archive(folder)
                place = archive.add(record(page_id, url, payload, digest, refers_to))
                rows.append((page_id, url, digest, "response" if refers_to is None else "revisit", archive.name, *place))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
        if archive:
            archive.out.close()

    return stored(arrow_map(with_references(pages), work, INDEX), "index")


def joined_ranges(rows: list[tuple[int, int]]) -> Iterator[list[tuple[int, int]]]:
    """Sorted ranges in groups to read at once: near one another and not too long together."""
    group: list[tuple[int, int]] = []
    for offset, length in rows:
        if group and (offset - sum(group[-1]) > GAP or offset + length - group[0][0] > SPAN):
            yield group
            group = []
        group.append((offset, length))
    if group:
        yield group


def read_records(spark: SparkSession, folder: str, selected: DataFrame) -> DataFrame:
    """The records that index rows name.  Payload fields of a revisit are those of the full
    payload, from its own header; its ``payload`` is null."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = location(folder)
        name, source = None, None
        for batch in slices(batches, 2048):
            files = batch.column(0).to_pylist()
            ranges = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()))
            for file in dict.fromkeys(files):
                if file != name:
                    if source:
                        source.close()
                    name, source = file, store.open_input_file(f"{root}/{file}")
                for group in joined_ranges([r for r, f in zip(ranges, files) if f == file]):
                    data = source.read_at(sum(group[-1]) - group[0][0], group[0][0])
                    yield records([data[o - group[0][0]:o - group[0][0] + n] for o, n in group])
        if source:
            source.close()

    # Index rows are tiny and what they name is not: tasks follow the bytes to be read.
    total = selected.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first().bytes
    ranges = selected.select("file", "offset", "length").repartition(total // TASK_BYTES + 1, "file", F.floor(F.col("offset") / SPAN))
    return arrow_map(ranges.sortWithinPartitions("file", "offset"), work, READ)


def records(members: list[bytes]) -> pa.RecordBatch:
    rows = []
    for member in members:
        fields, block = parse(zlib.decompress(member, wbits=31))
        http, _, payload = block.partition(b"\r\n\r\n")
        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
        digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
        full = fields["WARC-Type"] == "response"
        if full and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
        url = fields.get("WARC-Target-URI")
        rows.append((
            number(fields["WARC-Record-ID"]), None if url is None else unquote(url), fields["WARC-Type"], number(fields.get("WARC-Refers-To")), size, digest, payload if full else None,
        ))
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
    )


def archive_folder(spark: SparkSession) -> str:
    return fresh_path(spark, "warc")
