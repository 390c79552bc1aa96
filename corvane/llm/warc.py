"""WARC archives as a Python data source.

``WarcSource`` writes one WARC/1.1 file after another in each task and reads them in
partitions of whole files.  Payloads are stored as HTTP responses with a gzip body, so
that a file is plain WARC: the reader parses a record's headers first and, by its
length, steps over the blocks of records that a pushed-down predicate leaves out, or
whose payload nobody wants, without decoding them.  Files that end in ``.gz`` are read
as a stream.

Writers name files by task attempt; the driver lists those of successful tasks in a
manifest of the write, so that a lost executor or a repeated task leaves nothing that is
read.  Readers take the files of all manifests, so writes add up; one that overwrites
removes the manifests before it once its own is there.  Files are reached through
``pyarrow.fs`` by URI, on every node.

Record ids are ``urn:page:<id>``.  Defined cases: a null payload is empty; a null id has
the empty ``urn:page:``, read back as null; a null address has no header; line breaks in
an address are percent-encoded.  An empty table writes a manifest without files and reads
as an empty table.  Repeated rows are records of their own.

Archives of others: bodies in chunks are put together; a body whose chunks or gzip coding
are broken, or whose coding is unknown, is read as the bytes that stand there.  A record
without a proper length is left out with all up to the next line that begins a record, as
is what stands between records; a record that the end of a file cuts off is left out too,
and a broken ``.gz`` file is read up to the break.
"""

from __future__ import annotations

import base64
import contextlib
import gzip
import hashlib
import io
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, WriterCommitMessage

from .common import text_of, written

FORMAT = "corvane_warc"
SCHEMA = "record_id string, record_type string, target_uri string, payload_digest string, refers_to string, payload_length long, payload binary"
#: A task starts another file when its file has as many bytes.
FILE_BYTES = 64 << 20
#: Files are read together up to as many bytes.
PART_BYTES = 32 << 20
MANIFEST = "_manifest"
LEVEL = 3
#: A longer line is read in parts.
MOST_LINE = 1 << 20
#: Columns that predicates are pushed down on, and the header of each.
HEADERS = {"record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI", "refers_to": "WARC-Refers-To"}


def _files(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _clean(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record(row: dict) -> bytes:
    """The bytes of one record."""
    payload = row["payload"] or b""
    if row["record_type"] == "response":
        body = gzip.compress(payload, LEVEL, mtime=0)
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Encoding: gzip\r\nContent-Length: %d\r\n\r\n" % len(body) + body
    else:
        block = b"HTTP/1.1 200 OK\r\n\r\n"
    head = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", f"<{row['record_id']}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", row["target_uri"]),
        ("WARC-Payload-Digest", f"sha1:{row['payload_digest']}" if row["payload_digest"] else None),
        ("WARC-Refers-To", f"<{row['refers_to']}>" if row["refers_to"] is not None else None),
        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if row["record_type"] == "revisit" else None),
        ("X-Payload-Length", str(row["payload_length"])),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {_clean(v)}\r\n" for k, v in head if v is not None).encode() + b"\r\n" + block + b"\r\n\r\n"


class _Files(WriterCommitMessage):
    def __init__(self, files: list[tuple[str, int]]) -> None:
        self.files = files


def _manifests(system, path: str) -> list[str]:
    from pyarrow import fs

    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted(i.base_name for i in found if i.base_name.startswith(MANIFEST) and i.base_name.endswith(".json"))


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, uri: str, overwrite: bool = False) -> None:
        self.uri, self.overwrite = uri, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, path = _files(self.uri)
        system.create_dir(path, recursive=True)
        files, out, size = [], None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None:
                    name, size = f"part-{uuid.uuid4().hex}.warc", 0
                    out = system.open_output_stream(f"{path}/{name}")
                out.write(data := record(row))
                size += len(data)
                if size >= FILE_BYTES:
                    out.close()
                    files.append((name, size))
                    out = None
        if out is not None:
            out.close()
            files.append((name, size))
        return _Files(files)

    def commit(self, messages: list) -> None:
        system, path = _files(self.uri)
        system.create_dir(path, recursive=True)
        files = sorted(f for m in messages if m for f in m.files)
        before = _manifests(system, path) if self.overwrite else []
        with system.open_output_stream(f"{path}/{MANIFEST}-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps(files).encode())
        for name in before:
            system.delete_file(f"{path}/{name}")

    def abort(self, messages: list) -> None:
        system, path = _files(self.uri)
        for m in messages:
            for name, _ in m.files if m else []:
                system.delete_file(f"{path}/{name}")


class _Part(InputPartition):
    def __init__(self, names: list[str]) -> None:
        self.names = names


class _Unzipped(io.RawIOBase):
    """The members of a gzip file, up to a break."""

    def __init__(self, raw) -> None:
        self.raw, self.rest, self.one = raw, b"", None

    def readable(self) -> bool:
        return True

    def readinto(self, out) -> int:
        while True:
            self.rest = self.rest or self.raw.read(1 << 16)
            if not self.rest and self.one is None:
                return 0
            self.one = self.one or zlib.decompressobj(31)
            try:
                got = self.one.decompress(self.rest, len(out))
            except zlib.error:
                self.raw, self.rest, self.one = io.BytesIO(), b"", None
                return 0
            if not self.rest and not got:
                return 0  # cut off
            self.rest = self.one.unused_data if self.one.eof else self.one.unconsumed_tail
            self.one = None if self.one.eof else self.one
            if got:
                out[: len(got)] = got
                return len(got)


class _Stream:
    """A file to read in order, with steps over parts."""

    def __init__(self, raw, packed: bool) -> None:
        self.raw = io.BufferedReader(_Unzipped(raw) if packed else raw, 1 << 20)
        self.packed = packed

    def step(self, n: int) -> bool:
        """Step over ``n`` bytes; whether they were there."""
        if not self.packed and n > 0:
            # to the last of them, which shows by being read that the file has them
            self.raw.seek(n - 1, io.SEEK_CUR)
            n = 1
        while n > 0 and (got := len(self.raw.read(min(n, 1 << 20)))):
            n -= got
        return n == 0


def _bare(value: str | None) -> str | None:
    return value[1:-1] if value and value[:1] == "<" else value


class WarcReader(DataSourceReader):
    def __init__(self, uri: str, payload: bool) -> None:
        self.uri, self.payload, self.wanted = uri, payload, {}

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if name in HEADERS:
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[name] = self.wanted.get(name, values) & values
            else:
                yield f

    def partitions(self):
        from pyarrow import fs

        system, path = _files(self.uri)
        if manifests := _manifests(system, path):
            files = []
            for name in manifests:
                with system.open_input_stream(f"{path}/{name}") as f:
                    files += [tuple(x) for x in json.loads(f.read())]
        else:
            files = sorted((i.base_name, i.size) for i in system.get_file_info(fs.FileSelector(path)) if i.base_name.endswith((".warc", ".warc.gz")))
        parts, size = [[]], 0
        for name, n in files:
            if parts[-1] and size + n > PART_BYTES:
                parts, size = [*parts, []], 0
            parts[-1].append(name)
            size += n
        return [_Part(p) for p in parts]

    def read(self, partition):
        system, path = _files(self.uri)
        rows, held = [], 0
        for name in partition.names:
            with system.open_input_file(f"{path}/{name}") as f:
                for row in self.records(_Stream(f, name.endswith(".gz"))):
                    rows.append(row)
                    held += len(row["payload"] or b"")
                    if len(rows) >= 5000 or held > 16 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    def records(self, stream: _Stream) -> Iterator[dict]:
        f = stream.raw
        while line := f.readline(MOST_LINE):
            if not line.startswith(b"WARC/"):
                continue
            head = {}
            while line := f.readline(MOST_LINE).rstrip(b"\r\n"):
                k, _, v = line.decode("utf-8", "replace").partition(":")
                head[k.strip().lower()] = v.strip()
            length = _whole(head.get("content-length"))
            if length is None:
                continue
            row = {c: _bare(head.get(h.lower())) for c, h in HEADERS.items()}
            if any(row[c] not in values for c, values in self.wanted.items()):
                stream.step(length)
                continue
            row["payload_digest"] = (head.get("warc-payload-digest") or "").removeprefix("sha1:") or None
            row["payload_length"] = _whole(head.get("x-payload-length"))
            row["payload"] = None
            if self.payload and row["record_type"] != "revisit":
                block = f.read(length)
                if len(block) < length:
                    return
                row["payload"] = _payload(block, head.get("content-type", ""))
                row["payload_digest"] = base32(hashlib.sha1(row["payload"]).digest())
                row["payload_length"] = len(row["payload"])
            elif not stream.step(length):
                return
            yield row


def _whole(value: str | None) -> int | None:
    return int(value) if value and value.isascii() and value.isdigit() else None


def _payload(block: bytes, kind: str) -> bytes:
    """The decoded body of an HTTP block; other blocks are payload as they are."""
    if not kind.lower().startswith("application/http"):
        return block
    head, _, body = block.partition(b"\r\n\r\n")
    head = head.lower()
    if re.search(rb"^transfer-encoding:[ \t]*chunked", head, re.M):
        body = _joined_chunks(body)
    if re.search(rb"^content-encoding:[ \t]*(x-)?gzip", head, re.M):
        with contextlib.suppress(zlib.error):
            body = _unzipped(body)
    return body


def _joined_chunks(body: bytes) -> bytes:
    """The chunks of a body joined; the body itself if they are broken."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at, at + 1000)
        size = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]{1,15}", size):
            return body
        n = int(size, 16)
        if not n:
            return b"".join(parts)
        at = end + 2 + n
        if at > len(body):
            return body
        parts.append(body[end + 2 : at])
        if body[at : at + 2] != b"\r\n":
            return body
        at += 2


def _unzipped(body: bytes) -> bytes:
    """All members of a gzip body, whole."""
    out = []
    while body:
        one = zlib.decompressobj(31)
        out.append(one.decompress(body))
        if not one.eof:
            raise zlib.error("cut off")
        body = one.unused_data
    return b"".join(out)


_ARROW = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("payload_digest", pa.string()), ("refers_to", pa.string()), ("payload_length", pa.int64()), ("payload", pa.binary())])


class WarcSource(DataSource):
    """Options: ``path`` (a folder's URI); ``payload`` (read payloads, true by default)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], str(self.options.get("payload", "true")).lower() == "true")

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], overwrite)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format(FORMAT).option("payload", str(payload).lower()).load(path)


def write_warc(records: DataFrame, path: str, mode: str = "append") -> None:
    records.sparkSession.dataSource.register(WarcSource)
    records.select(*[c.split()[0] for c in SCHEMA.split(", ")]).write.format(FORMAT).mode(mode).save(path)


def archived(pages: DataFrame, id: str = "page_id", uri: str = "url", payload: str = "html", least: int = 0) -> DataFrame:
    """The records of pages: of equal payloads with ``least`` bytes or more, the smallest id is a response, others revisit it.

    The digest is carried as hex until a record is written; a null id never revisits and is never revisited
    unless all ids of its payload are null.
    """
    body = F.encode(text_of(payload), "UTF-8")
    rows = pages.select(F.col(id).cast("long").alias("id"), F.col(uri).cast("string").alias("uri"), body.alias("payload")).withColumn("sha", F.sha1("payload"))
    # written, so that payloads are joined between plain exchanges, of which a frequent payload's part can be split
    first = written(rows.groupBy(F.col("sha").alias("s")).agg(F.min("id").alias("first")))
    rows = rows.join(first, F.col("sha") == F.col("s"))
    n = F.octet_length("payload").cast("long")
    revisit = (n >= least) & (F.col("id") != F.col("first"))
    revisit = F.coalesce(revisit, F.lit(False))
    urn = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(c.cast("string"), F.lit("")))
    return rows.select(
        urn(F.col("id")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.col("uri").alias("target_uri"),
        _base32_of_hex(F.col("sha")).alias("payload_digest"),
        F.when(revisit, urn(F.col("first"))).alias("refers_to"),
        n.alias("payload_length"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def _base32_of_hex(sha):
    """Base 32 of 40 hex digits: each 10 digits are 8 characters."""
    parts = [F.lpad(F.conv(F.substring(sha, k, 10), 16, 32), 8, "0") for k in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")

