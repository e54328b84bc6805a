"""WARC archives, index first.

Writing: every page becomes one gzip member.  Of pages with equal payloads of
at least ``REVISIT_BYTES`` bytes the one with the least page_id is a response
and the others are revisits that name it; smaller payloads are all responses.
The writer returns one index row per record: file, offset, length, url, digest.
Files carry a name of their own per task attempt, and only rows of attempts
that Spark accepted enter the index, so a lost executor leaves at worst a file
that nothing points to.

Reading: index rows are sorted by file and offset, neighbouring records are
read with one byte-range request, each member is unpacked and its payload's
digest compared with its header.

Null html is an empty payload; a null url has no target header; a null page_id
has no id header and comes after all others in the choice of the response.
Pages that repeat the least page_id with equal payloads are all responses.
Extra columns are ignored.  An empty table gives an empty index.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkclust.llm.common import shared_path, stored

REVISIT_BYTES = 100
FILE_BYTES = 128 << 20
#: Records of one file at most this far apart are read together, up to BLOCK_BYTES at once.
GAP_BYTES = 64 << 10
BLOCK_BYTES = 8 << 20
#: Fixed values of the format.
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "file string, offset long, length long, page_id long, url string, payload_digest string, record_type string"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def _line(text: str) -> str:
    """A header value: control characters and blanks percent-encoded."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def member(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record as a gzip member."""
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}|{url}|{digest}')}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/http;msgtype=response",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page-Id: {refers_to}"]
        block = f"{http}\r\n".encode()
    else:
        block = f"{http}Content-Length: {len(payload)}\r\n\r\n".encode() + payload
    head.append(f"Content-Length: {len(block)}")
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def parse(data: bytes) -> dict:
    """The fields of one member; raises ValueError where a response's payload does not have its digest."""
    raw = zlib.decompress(data, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = fields["WARC-Type"]
    payload = None
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} does not have its digest")
    page_id, refers_to = fields.get("X-Page-Id"), fields.get("X-Refers-To-Page-Id")
    return {
        "page_id": None if page_id is None else int(page_id),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": int(fields["X-Payload-Length"]) if payload is None else len(payload),
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": None if refers_to in (None, "None") else int(refers_to),
        "payload": payload,
    }


def _open(uri: str):
    return pyarrow.fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else uri.replace(":", "://", 1))


def _writer(base: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        stem = f"{base}/pages-{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        out, uri, at, files = None, "", 0, 0
        try:
            for batch in batches:
                index = []
                for r in batch.to_pylist():
                    if out is None or at >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        uri, at, files = f"{stem}-{files:04d}.warc.gz", 0, files + 1
                        fs, path = _open(uri)
                        out = fs.open_output_stream(path, compression=None)  # members are packed here
                    revisit = r["revisit"]
                    data = member(r["page_id"], r["url"], r["payload"], r["payload_digest"], r["first_id"], revisit)
                    out.write(data)
                    kind = "revisit" if revisit else "response"
                    index.append((uri, at, len(data), r["page_id"], r["url"], r["payload_digest"], kind))
                    at += len(data)
                names = [x.split()[0] for x in INDEX.split(", ")]
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
                columns = list(zip(*index, strict=True)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
        finally:
            if out is not None:
                out.close()

    return run


def write(pages: DataFrame, base: str | None = None) -> DataFrame:
    """Write the archives below ``base`` (default: a new shared folder); returns the stored index."""
    spark = pages.sparkSession
    base = base or shared_path(spark, "warc")
    fs, path = _open(base)
    fs.create_dir(path, recursive=True)
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload")
    ).withColumn("payload_digest", F.sha2("payload", 256))
    # one row per digest that repeats: summed up before the shuffle, without payloads
    large = rows.where(F.octet_length("payload") >= REVISIT_BYTES)
    firsts = large.groupBy("payload_digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    firsts = firsts.where("n > 1 and first_id is not null").drop("n")
    rows = rows.join(firsts, "payload_digest", "left").withColumn(
        "revisit", F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    )
    rows = rows.select("page_id", "url", "payload", "payload_digest", "first_id", "revisit")
    return stored(rows.mapInArrow(_writer(base), INDEX), "warc-index")


def ranges(entries: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[int]]]:
    """(file, start, end, positions) of the byte ranges that cover sorted (file, offset, length) entries."""
    at: list[int] = []
    file, start, end = "", 0, 0
    for i, (f, o, n) in enumerate(entries):
        if at and f == file and o <= end + GAP_BYTES and max(end, o + n) - start <= BLOCK_BYTES:
            end = max(end, o + n)
            at.append(i)
            continue
        if at:
            yield file, start, end, at
        file, start, end, at = f, o, o + n, [i]
    if at:
        yield file, start, end, at


def _reader(payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in RECORDS.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        handle, opened = None, None
        try:
            for batch in batches:
                entries = list(zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True))
                for file, start, end, at in ranges(entries):
                    if file != opened:
                        if handle is not None:
                            handle.close()
                        fs, path = _open(file)
                        handle, opened = fs.open_input_file(path), file
                    block = handle.read_at(end - start, start)
                    rows = [parse(block[entries[i][1] - start : entries[i][1] - start + entries[i][2]]) for i in at]
                    if not payloads:
                        for r in rows:
                            r["payload"] = None
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=True)], names=names
                    )
        finally:
            if handle is not None:
                handle.close()

    return run


def read(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records that the (selected) rows of the index point to.

    ``payload`` is null for revisits, and for all with ``payloads=False``,
    where it is still unpacked and compared with its digest.
    """
    entries = index.select("file", "offset", "length").repartitionByRange("file", "offset").sortWithinPartitions("file", "offset")
    return entries.mapInArrow(_reader(payloads), RECORDS)
