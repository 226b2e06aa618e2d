"""WARC archives: a writer with revisit records and a sequential reader.

Writing: every task writes its rows into archives of its own in the shared
folder, one gzip member for each record, and reports them in a manifest that
Spark commits. An archive has a new name at each attempt, and only archives in
the manifest are read, so a lost executor or a repeated task leaves at most an
unread file. Payloads stream through; a task holds one record at a time.

Reading: one pass over each archive in small chunks through an incremental
zlib decompressor; a record is framed by its Content-Length, must end where
its gzip member ends, and its block and payload digests are computed and
compared with the headers. Memory is one record and one chunk, whatever the
archive's size.

Defined results: a null payload counts as empty; a null id or URL leaves its
header out; of rows with equal payloads of at least ``min_bytes`` bytes those
with the smallest id are ``response`` (all rows that repeat that id) and the
others ``revisit``; a null id counts as larger than any id; extra columns are
not read, whatever their names; an empty table gives an archive-less manifest
and no records. A group of equal payloads may hold any share of the rows: it
is combined before the shuffle and dealt out over ``SALTS`` keys.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SALTS = 64                  # keys over which the rows of one payload are dealt
ROLL_BYTES = 64 << 20       # an archive is closed beyond this size
CHUNK = 64 << 10            # bytes read at a time
BATCH_BYTES = 8 << 20       # payload bytes in one batch of read records
LEVEL = 6                   # zlib level

WRITTEN = "archive string, records long, bytes long"
READ = ("archive string, offset long, record_type string, record_id string, target_uri string, refers_to string, "
        "payload_bytes long, payload_digest string, payload binary, digest_ok boolean")


class WarcError(ValueError):
    """An archive that is not framed as this module writes it."""


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, headers: dict[str, str | None], block: bytes, date: str) -> bytes:
    """One record as one gzip member."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Date: {date}"]
    for name, value in headers.items():
        if value is not None:
            lines.append(f"{name}: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value))
    lines += [f"WARC-Block-Digest: sha1:{base32_sha1(block)}", f"Content-Length: {len(block)}", "", ""]
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(lines).encode()) + z.compress(block) + z.compress(b"\r\n\r\n") + z.flush()


def page_record(page_id, url: str | None, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """A ``response`` with its payload, or a ``revisit`` that has the HTTP
    header alone (whose Content-Length keeps the size of the full payload)."""
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    head = {"WARC-Record-ID": None if page_id is None else f"<urn:page:{page_id}>", "WARC-Target-URI": url,
            "Content-Type": "application/http;msgtype=response", "WARC-Payload-Digest": f"sha1:{digest}"}
    if refers_to is None:
        return record("response", head, http + payload, date)
    head |= {"WARC-Refers-To": f"<urn:page:{refers_to}>",
             "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}
    return record("revisit", head, http, date)


@dataclass
class Record:
    offset: int
    headers: dict[str, str] = field(default_factory=dict)
    block: bytes = b""
    block_ok: bool = True


class _Member:
    """One gzip member, decompressed as it is asked for."""

    def __init__(self, stream: BinaryIO, ahead: bytes):
        self.stream, self.ahead, self.read_bytes = stream, ahead, 0
        self.z, self.have = zlib.decompressobj(31), bytearray()

    def _more(self) -> bool:
        if self.z.eof:
            return False
        data = self.ahead or self.stream.read(CHUNK)
        self.ahead = b""
        try:
            got = self.z.decompress(data, CHUNK)
        except zlib.error as e:
            raise WarcError(f"not a gzip member: {e}") from e
        if not data and not got and not self.z.eof:
            raise WarcError("the archive ends within a record")
        self.have += got
        left = self.z.unused_data if self.z.eof else self.z.unconsumed_tail
        self.read_bytes += len(data) - len(left)
        self.ahead = left
        return True

    def until(self, mark: bytes) -> bytes:
        start = 0
        while (at := self.have.find(mark, start)) < 0:
            start = max(0, len(self.have) - len(mark))
            if not self._more():
                raise WarcError("a record without the end of its header")
        out = bytes(self.have[:at])
        del self.have[:at + len(mark)]
        return out

    def exactly(self, n: int) -> bytes:
        parts, need = [], n
        while need:
            if not self.have and not self._more():
                raise WarcError(f"a block shorter than its Content-Length {n}")
            part = bytes(self.have[:need])
            del self.have[:len(part)]
            parts.append(part)
            need -= len(part)
        return b"".join(parts)

    def finish(self) -> None:
        while not self.z.eof:
            self._more()
        if self.have:
            raise WarcError("a gzip member longer than its record")


def read_records(stream: BinaryIO) -> Iterator[Record]:
    """The records of one archive, in order."""
    ahead, offset = b"", 0
    while True:
        if not ahead and not (ahead := stream.read(CHUNK)):
            return
        member, got = _Member(stream, ahead), Record(offset)
        lines = member.until(b"\r\n\r\n").decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise WarcError(f"no WARC record at byte {offset}")
        for line in lines[1:]:
            name, _, value = line.partition(":")
            got.headers[name.strip().lower()] = value.strip()
        if not (length := got.headers.get("content-length", "")).isdigit():
            raise WarcError(f"a record without Content-Length at byte {offset}")
        got.block = member.exactly(int(length))
        if member.exactly(4) != b"\r\n\r\n":
            raise WarcError(f"a record without its end mark at byte {offset}")
        member.finish()
        said = got.headers.get("warc-block-digest")
        got.block_ok = said is None or said == f"sha1:{base32_sha1(got.block)}"
        offset += member.read_bytes
        ahead = member.ahead
        yield got


def _payload(got: Record) -> tuple[bytes, int, bool]:
    """Payload, size of the full payload, and whether its digest holds (a
    revisit has no payload to compare)."""
    head, mark, body = got.block.partition(b"\r\n\r\n")
    if not mark or not got.headers.get("content-type", "").startswith("application/http"):
        head, body = b"", got.block
    said = re.search(rb"(?mi)^content-length:[ ]*([0-9]+)", head)
    if got.headers.get("warc-type") == "revisit":
        return b"", int(said[1]) if said else 0, True
    digest = got.headers.get("warc-payload-digest")
    ok = (digest is None or digest == f"sha1:{base32_sha1(body)}") and (said is None or int(said[1]) == len(body))
    return body, len(body), ok


def first_ids(df: DataFrame, id_col: str, digest: Column, salt: Column) -> DataFrame:
    """(digest, salt) → smallest id with that digest, for joins in which no
    digest's rows meet in one task."""
    part = df.groupBy(digest.alias("digest"), salt.alias("salt")).agg(F.min(id_col).alias("least"))
    whole = part.groupBy("digest").agg(F.min("least").alias("first_id"), F.collect_list("salt").alias("salts"))
    return whole.select("digest", F.explode("salts").alias("salt"), "first_id")


def write(df: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
          min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> str:
    """Write a record for each row into archives in ``folder``; returns the
    path of the manifest (Parquet: archive, records, bytes)."""
    rows = df.select(df[id_col].alias("id"), df[url_col].alias("url"),
                     F.coalesce(df[payload_col], F.lit("")).alias("payload"))
    salt = F.pmod(F.xxhash64("id", "url"), F.lit(SALTS)).cast("int")
    rows = rows.withColumns({"digest": F.sha1("payload"), "salt": salt})
    first = first_ids(rows.where(F.octet_length("payload") >= min_bytes).select("id", "digest", "salt"),
                      "id", F.col("digest"), F.col("salt"))
    rows = rows.join(first, ["digest", "salt"], "left").select(
        "id", "url", "payload", "digest",
        F.when(F.col("id").isNull() | (F.col("id") > F.col("first_id")), F.col("first_id")).alias("refers_to"))

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        disk, root = fs.FileSystem.from_uri(folder)
        out, name, records, size, done = None, "", 0, 0, []
        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in ("id", "url", "payload", "digest", "refers_to"))):
                if out is None:
                    name, records = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = disk.open_output_stream(posixpath.join(root, name), compression=None)
                    size = out.write(record("warcinfo", {"WARC-Filename": name, "Content-Type": "application/warc-fields"},
                                            b"format: WARC File Format 1.1\r\n", date))
                size += out.write(page_record(r[0], r[1], r[2].encode(), base64.b32encode(bytes.fromhex(r[3])).decode(),
                                              r[4], date))
                records += 1
                if size >= ROLL_BYTES:
                    out.close()
                    done.append((name, records, size))
                    out = None
        if out is not None:
            out.close()
            done.append((name, records, size))
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[0] for d in done], pa.string()), *(pa.array([d[k] for d in done], pa.int64()) for k in (1, 2))],
            names=["archive", "records", "bytes"])

    disk, root = fs.FileSystem.from_uri(folder)
    disk.create_dir(root, recursive=True)
    manifest = f"{folder}/manifest"
    rows.mapInArrow(archives, WRITTEN).write.parquet(manifest)
    return manifest


def read(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the archives in ``folder``'s manifest (``READ``), the
    warcinfo records left out; without ``payloads`` the payload column is
    null, though its digest has been verified all the same."""
    listed = spark.read.parquet(f"{folder}/manifest").select("archive")
    listed = listed.repartition(max(1, min(100_000, listed.count())))

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        disk, root = fs.FileSystem.from_uri(folder)
        schema = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()),
                            ("record_id", pa.string()), ("target_uri", pa.string()), ("refers_to", pa.string()),
                            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
                            ("digest_ok", pa.bool_())])
        bare = lambda x: x and x.removeprefix("<urn:page:").removesuffix(">")
        rows, held = [], 0
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with disk.open_input_stream(posixpath.join(root, name), compression=None) as stream:
                    try:
                        for got in read_records(stream):
                            h = got.headers
                            if h["warc-type"] == "warcinfo":
                                continue
                            body, size, ok = _payload(got)
                            rows.append((name, got.offset, h["warc-type"], bare(h.get("warc-record-id")), h.get("warc-target-uri"),
                                         bare(h.get("warc-refers-to")), size, h.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                                         body if payloads else None, ok and got.block_ok))
                            held += len(body) if payloads else 256
                            if held >= BATCH_BYTES:
                                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                                rows, held = [], 0
                    except WarcError as e:
                        raise WarcError(f"{name}: {e}") from e
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return listed.mapInArrow(records, READ)
