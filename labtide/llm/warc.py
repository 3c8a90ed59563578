"""WARC archives: written with an index first, read back by coalesced byte ranges of selected records."""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labtide.llm.staging import staged
from labtide.session import scratch_dir

MIN_SHARED = 100
DATE = "2024-01-01T00:00:00Z"
FILE_BYTES = 1 << 30
READ_BYTES = 8 << 20
TASK_BYTES = 16 << 20
GAP_BYTES = 64 << 10
LEVEL = 4

INDEX = "file string, offset bigint, length bigint, page_id bigint, url string, digest string, record_type string"
RECORDS = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"


# Spark's names of stores that the file systems used here call otherwise.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def address(folder: str) -> str:
    """A folder under the name that the file systems used here know; ``dbfs:`` is reached by its mount below ``/dbfs``."""
    scheme, found, rest = folder.partition(":")
    if found and scheme == "dbfs":
        return "/dbfs/" + rest.lstrip("/")
    return f"{SCHEMES.get(scheme, scheme)}:{rest}" if found else folder


def store_of(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder: local paths, ``file:``, ``s3:`` (and Spark's ``s3a:``), ``gs:``, ``abfs:``, ``hdfs:``, ``viewfs:``.

    Other schemes are refused with an error that names them.
    """
    return fs.FileSystem.from_uri(address(folder))


def _record_id(page: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page}-{digest}')}>"


def record_bytes(page: int | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: int | None) -> bytes:
    """One gzip member with a response record, or with a revisit record that has no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http if refers_to is not None else http + payload
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": _record_id(page, digest),
        "WARC-Date": DATE,
        "WARC-Target-URI": quote(url or "", safe=":/?#[]@!$&'()*+,;=%-._~"),
        "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": f"sha256:{digest}",
        "X-Payload-Length": str(size),
    }
    if page is not None:
        head["X-Page-Id"] = str(page)
    if refers_to is not None:
        head["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        head["WARC-Refers-To"] = _record_id(refers_to, digest)
        head["X-Refers-To-Page"] = str(refers_to)
    head["Content-Length"] = str(len(block))
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + "\r\n"
    return gzip.compress(text.encode() + block + b"\r\n\r\n", LEVEL, mtime=0)


def parse_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a record."""
    head, _, rest = gzip.decompress(member).partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(headers["Content-Length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


def _with_first(pages: DataFrame, least: int) -> DataFrame:
    """Pages with digest, size and, for repeated payloads, the page that has the response."""
    payload: Column = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload")
    )
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "size": F.octet_length("payload").cast("bigint")})
    same = rows.where(F.col("size") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    return rows.join(same.where("n > 1").select("digest", "first"), "digest", "left").withColumn(
        "refers_to", F.when(F.coalesce(F.col("page_id") != F.col("first"), F.col("first").isNotNull()), F.col("first"))
    )


def write_archives(pages: DataFrame, folder: str, least: int = MIN_SHARED, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record for each row of ``pages`` (page_id, url, html) and return the index of the records.

    Of equal payloads of ``least`` bytes or more, the rows with the smallest page_id are responses and all others revisit
    them; smaller payloads are all responses. Each task writes files of its own, under names that no other attempt uses,
    and returns their index rows; the index is saved by Spark's commit, so files of lost attempts are never referred to.
    Null html is an empty payload. A page without an id can only revisit.
    """

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = store_of(folder)
        out, name, at, number = None, "", 0, 0
        for part in parts:
            rows = []
            for page, url, payload, digest, size, refers_to in zip(*[c.to_pylist() for c in part.columns]):
                if out is None or at >= file_bytes:
                    if out is not None:
                        out.close()
                    name = f"part-{TaskContext.get().partitionId():05d}-{number:03d}-{uuid.uuid4().hex}.warc.gz"
                    store.create_dir(base, recursive=True)
                    out, at, number = store.open_output_stream(f"{base}/{name}", compression=None), 0, number + 1
                member = record_bytes(page, url, payload or b"", digest, size, refers_to)
                out.write(member)
                kind = "response" if refers_to is None else "revisit"
                rows.append((name, at, len(member), page, url, digest, kind))
                at += len(member)
            columns = list(zip(*rows)) if rows else [()] * 7
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
            names = ["file", "offset", "length", "page_id", "url", "digest", "record_type"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
        if out is not None:
            out.close()

    rows = _with_first(pages, least)
    # A revisit has no payload of its own, so it need not travel to Python.
    payload = F.when(F.col("refers_to").isNull(), F.col("payload"))
    rows = rows.select("page_id", "url", payload.alias("payload"), "digest", "size", "refers_to")
    return staged(rows.mapInArrow(batches, INDEX), "warc-index")


def coalesced(spans: list[tuple[int, int]], gap: int = GAP_BYTES, most: int = READ_BYTES) -> list[list[tuple[int, int]]]:
    """Sorted (offset, length) spans, put together where at most ``gap`` bytes lie between and a read stays below ``most``."""
    reads: list[list[tuple[int, int]]] = []
    for offset, length in sorted(spans):
        if reads and offset - sum(reads[-1][-1]) <= gap and offset + length - reads[-1][0][0] <= most:
            reads[-1].append((offset, length))
        else:
            reads.append([(offset, length)])
    return reads


def read_records(index: DataFrame, folder: str, with_payload: bool = True, gap: int = GAP_BYTES, most: int = READ_BYTES) -> DataFrame:
    """The records that ``index`` (any selection of index rows) points to.

    Rows are grouped by file and stretch of about ``most`` bytes; a group is sorted by offset and read in coalesced byte
    ranges. Groups are dealt over tasks by the bytes they stand for, not by the few bytes of their index rows. The digest and
    the size of every response are checked against its payload; those of a revisit are what its header says.
    """

    def records(rows: pa.Table) -> pa.Table:
        store, base = store_of(folder)
        out = []
        spans = list(zip(rows.column("offset").to_pylist(), rows.column("length").to_pylist()))
        with store.open_input_file(f"{base}/{rows.column('file')[0].as_py()}") as file:
            for read in coalesced(spans, gap, most):
                start = read[0][0]
                data = file.read_at(sum(read[-1]) - start, start)
                for offset, length in read:
                    head, payload = parse_record(data[offset - start : offset - start + length])
                    digest, kind = head["WARC-Payload-Digest"].removeprefix("sha256:"), head["WARC-Type"]
                    size = int(head["X-Payload-Length"])
                    if kind == "response" and (hashlib.sha256(payload).hexdigest(), len(payload)) != (digest, size):
                        raise ValueError(f"{rows.column('file')[0]}: damaged record at {offset}")
                    page, first = head.get("X-Page-Id"), head.get("X-Refers-To-Page")
                    out.append(
                        (
                            None if page is None else int(page),
                            head["WARC-Target-URI"],
                            size,
                            digest,
                            kind,
                            None if first is None else int(first),
                            payload if with_payload and kind == "response" else None,
                        )
                    )
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        return pa.table({n: pa.array(c, k) for n, c, k in zip(names, zip(*out), kinds)})

    tasks = max(1, -(-(index.agg(F.sum("length")).first()[0] or 0) // TASK_BYTES))
    places = index.select("file", "offset", "length", F.floor(F.col("offset") / most).alias("stretch"))
    return places.repartition(tasks, "file", "stretch").groupBy("file", "stretch").applyInArrow(records, RECORDS)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Archives of all pages, written below the scratch folder and read back through their index, without payloads."""
    folder = scratch_dir(pages.sparkSession, "warc")
    return read_records(write_archives(pages, folder), folder, with_payload=False).drop("payload")
