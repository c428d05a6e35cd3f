"""WARC archives: writing, the gzip normaliser with its offset index, reading.

`write_archives` writes one gzip stream a task over all its records. `normalise` inflates such a
file once from start to end, writes every record as a gzip member of its own, and beside it an
index of offsets. `read_archives` reads records one by one through the index.

Files lie in the folder that all machines share, under names with the task's attempt: a task
that runs again writes another file, and only files that finished tasks name are read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from millrace.session import shared_folder, stage

READ_BYTES = 1 << 20
MIN_REVISIT_BYTES = 0
_LEVEL = 6
_DATE = "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
_RECORDS = "archive string, page_id long, payload_bytes long, payload_digest string"


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_id(name: str) -> int | None:
    inner = name.removeprefix("<urn:page:").removesuffix(">")
    return int(inner) if inner else None


def record(page_id: int | None, url: str | None, payload: bytes, own: str, refers_to: int | None = None) -> bytes:
    """One record. A revisit has the HTTP header of the full payload, without the payload."""
    revisit = refers_to is not None
    block = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    ).encode() + (b"" if revisit else payload)
    target = "".join((url or "").split())
    head = ["WARC/1.0", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}",
            f"WARC-Date: {_DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{own}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if revisit:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {_PROFILE}"]
    return "\r\n".join([*head, "", ""]).encode() + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], int, bytes]:
    """A record's headers, its full payload's size, and the payload that it holds."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    headers = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:] if ": " in x)
    block = rest[: int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x[16:]) for x in http.decode().split("\r\n") if x.startswith("Content-Length: "))
    return headers, size, payload


def inflated(source: BinaryIO) -> Iterator[bytes]:
    """The whole file, inflated once in order, also where it has several members."""
    inflater = zlib.decompressobj(31)
    while raw := source.read(READ_BYTES):
        while raw:
            if part := inflater.decompress(raw, READ_BYTES):
                yield part
            raw = inflater.unconsumed_tail
            if inflater.eof:
                raw = inflater.unused_data
                inflater = zlib.decompressobj(31)


def split_records(parts: Iterator[bytes]) -> Iterator[bytes]:
    """Records of a stream, by their headers' lengths; one record is held at a time."""
    held = bytearray()

    def fill(enough) -> bool:
        while not enough():
            part = next(parts, None)
            if part is None:
                return False
            held.extend(part)
        return True

    while fill(lambda: b"\r\n\r\n" in held):
        end = held.index(b"\r\n\r\n") + 4
        length = next(int(x[16:]) for x in bytes(held[:end]).split(b"\r\n") if x.startswith(b"Content-Length: "))
        whole = end + length + 4
        if not fill(lambda: len(held) >= whole):
            raise ValueError("an archive ends within a record")
        yield bytes(held[:whole])
        del held[:whole]
    if held:
        raise ValueError("an archive ends within a record's header")


def _columns(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write pages (page_id, url, html) as response records, one gzip stream a task.
    Returns a row a record, of its archive, size and digest."""
    schema = pa.schema([("archive", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])

    def batches(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        uri = f"{folder}/whole-{task.partitionId():05d}-{task.taskAttemptId()}.warc.gz"
        where, path = _opened(uri)
        where.create_dir(path.rpartition("/")[0], recursive=True)
        with where.open_output_stream(path, compression=None) as raw, gzip.GzipFile(fileobj=raw, mode="wb", compresslevel=1, mtime=0) as out:
            for batch in them:
                rows = []
                for page, url, html in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    payload = (html or "").encode()
                    own = digest(payload)
                    out.write(record(page, url, payload, own))
                    rows.append((uri, page, len(payload), own))
                yield _columns(schema, rows)

    return pages.select("page_id", "url", "html").mapInArrow(batches, _RECORDS)


def find_revisits(records: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(archive, page_id, payload_digest, refers_to) of the records whose payload an earlier page holds."""
    alike = records.filter(F.col("page_id").isNotNull() & (F.col("payload_bytes") >= min_bytes))
    first = alike.groupBy("payload_digest", "payload_bytes").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("_last"))
    return (
        alike.join(first.filter("refers_to <> _last"), ["payload_digest", "payload_bytes"])
        .filter("page_id <> refers_to")
        .select("archive", "page_id", "payload_digest", "refers_to")
        .distinct()
    )


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite each archive with a gzip member a record and an index file beside it.

    archives: (archive, revisits), the latter a list of (page_id, payload_digest, refers_to), or null:
    records of this page and payload become revisits. The payload is the one that is read: one that
    doesn't match its record's digest raises an error. Returns (archive, index), the new files. The index has a line a
    record: offset, length, record id.
    """
    schema = pa.schema([("archive", pa.string()), ("index", pa.string())])

    def batches(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in them:
            rows = []
            for uri, revisits in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                first = {(record_id(x["page_id"]), x["payload_digest"]): x["refers_to"] for x in revisits or ()}
                where, source = _opened(uri)
                new = f"{folder}/{uri.rpartition('/')[2].removesuffix('.warc.gz')}-{TaskContext.get().taskAttemptId()}.warc.gz"
                _, target = _opened(new)
                where.create_dir(target.rpartition("/")[0], recursive=True)
                offset = 0
                with (
                    where.open_input_stream(source, compression=None) as raw,
                    where.open_output_stream(target, compression=None) as out,
                    where.open_output_stream(f"{target}.idx", compression=None) as index,
                ):
                    for one in split_records(inflated(raw)):
                        headers, _, payload = parse(one)
                        name, own = headers["WARC-Record-ID"], headers["WARC-Payload-Digest"].removeprefix("sha1:")
                        if digest(payload) != own:
                            raise ValueError(f"{uri}, {name}: the payload doesn't match its digest")
                        if (name, own) in first:
                            one = record(_page_id(name), headers.get("WARC-Target-URI"), payload, own, first[name, own])
                        member = gzip.compress(one, _LEVEL, mtime=0)
                        out.write(member)
                        index.write(f"{offset} {len(member)} {name}\n".encode())
                        offset += len(member)
                rows.append((new, f"{new}.idx"))
            yield _columns(schema, rows)

    return archives.select("archive", "revisits").mapInArrow(batches, "archive string, index string")


def read_archives(archives: DataFrame) -> DataFrame:
    """The records of normalised archives (archive, index), read member by member."""
    ddl = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])

    def batches(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in them:
            for uri, listed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                where, path = _opened(uri)
                with where.open_input_stream(_opened(listed)[1], compression=None) as index:
                    entries = [x.split(b" ", 2) for x in index.read().splitlines()]
                rows, held = [], 0
                with where.open_input_file(path) as source:
                    for offset, length, _ in entries:
                        source.seek(int(offset))
                        headers, size, payload = parse(gzip.decompress(source.read(int(length))))
                        own, kind = headers["WARC-Payload-Digest"].removeprefix("sha1:"), headers["WARC-Type"]
                        if kind == "response" and (digest(payload) != own or len(payload) != size):
                            raise ValueError(f"{uri} at {offset.decode()}: the payload doesn't match its digest")
                        refers = headers.get("WARC-Refers-To")
                        rows.append((_page_id(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), size, own, kind,
                                     None if refers is None else _page_id(refers), payload if kind == "response" else None))
                        held += len(payload)
                        if held > READ_BYTES:
                            yield _columns(schema, rows)
                            rows, held = [], 0
                yield _columns(schema, rows)

    return archives.select("archive", "index").repartition(max(1, archives.count())).mapInArrow(batches, ddl)


def archive_pages(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write pages (page_id, url, html) to archives, normalise them, and return (archive, index).

    A null html is an empty payload, a null url an empty target. Pages without a page_id are
    responses. Rows that repeat a page_id make a record each, told apart by their payloads: of
    equal payloads the smallest page_id's records all stay responses, other pages' records revisit
    it, and a payload of its own stays a response whatever other rows its page_id has. Other columns
    take no part. A payload is held whole by a task, whatever its length. An empty table makes archives without records.
    """
    spark = pages.sparkSession
    folder = shared_folder(spark, "warc")
    records = stage(write_archives(pages, f"{folder}/whole"), "warc-records")
    revisits = find_revisits(records, min_bytes).groupBy("archive").agg(
        F.collect_list(F.struct("page_id", "payload_digest", "refers_to")).alias("revisits")
    )
    names = records.select("archive").distinct()
    listed = names.join(revisits, "archive", "left").repartition(max(1, names.count()))  # a task each
    return stage(normalise(listed, f"{folder}/members"), "warc-archives")
