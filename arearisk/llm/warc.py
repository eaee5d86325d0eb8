"""WARC records in ZIP packages, read back by range requests.

A package is a ZIP file with two stored members: `archive/data.warc.gz`, one gzip
member per record, and `indexes/index.cdx`, one line per record with its offset
and length in the archive. The reader fetches the end of the file, parses the
central directory (with the ZIP64 fields where sizes need them), finds where the
members' bytes begin, and reads records by range, without unpacking anything.

Records with equal payloads are written once: the page with the smallest id is
the response, the others are revisits of it. Packages are written by the tasks
straight to shared storage under names that no other attempt uses; only those of
finished tasks are listed in the manifest, which is a table.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arearisk.llm.common import quoted
from arearisk.scratch import materialize, scratch_path

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdx"

#: Bytes of records after which a task begins another package.
PACKAGE_BYTES = 256 << 20


def open_store(uri: str) -> tuple:
    """File system and path of a URI or a local path."""
    from pyarrow import fs

    if uri.startswith("file:"):
        uri = "/" + uri[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def digest(payload: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, name: str, refers_to: int | None) -> bytes:
    """One WARC record; with `refers_to` a revisit that has the HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    kind = "revisit" if refers_to is not None else "response"
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'none:' + name if page_id is None else page_id}>",
             "WARC-Date: 2000-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest(payload)}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        lines.insert(3, "WARC-Target-URI: " + "".join(c if c > " " else f"%{ord(c):02X}" for c in url))
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Fields of one WARC record; the payload of a response is checked against its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(line.split(b":")[1]) for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:"))
    named = fields["warc-payload-digest"].removeprefix("sha1:")
    response = fields["warc-type"] == "response"
    if response and (len(payload) != size or digest(payload) != named):
        raise ValueError(f"payload of {fields['warc-record-id']} does not agree with its header")
    number = fields["warc-record-id"][len("<urn:page:"):-1]
    refers = fields.get("warc-refers-to")
    return {"page_id": None if number.startswith("none:") else int(number), "record_type": fields["warc-type"],
            "url": fields.get("warc-target-uri"), "payload_bytes": size, "payload_digest": named,
            "refers_to": int(refers[len("<urn:page:"):-1]) if refers else None, "payload": payload if response else None}


class PackageWriter:
    """Writes records to one ZIP package as they come; the index is kept until the end."""

    def __init__(self, uri: str, level: int):
        store, path = open_store(uri)
        self.uri, self.level, self.offset, self.lines = uri, level, 0, []
        store.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.sink = store.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.sink, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(zipfile.ZipInfo(ARCHIVE), "w", force_zip64=True)

    def add(self, data: bytes) -> None:
        packed = zlib.compress(data, self.level, 31)
        self.member.write(packed)
        self.lines.append(f"{self.offset} {len(packed)}")
        self.offset += len(packed)

    def close(self) -> tuple[str, int, int]:
        self.member.close()
        with self.zip.open(zipfile.ZipInfo(INDEX), "w", force_zip64=True) as index:
            index.write("\n".join(self.lines).encode())
        self.zip.close()
        size = self.sink.tell()
        self.sink.close()
        return self.uri, len(self.lines), size


class Package:
    """Reads a ZIP package by ranges of an open random-access file."""

    def __init__(self, source, size: int):
        self.source, self.size = source, size
        self.members = self._directory()

    def range(self, start: int, length: int) -> bytes:
        self.source.seek(start)
        data = self.source.read(length)
        if len(data) != length:
            raise ValueError("the package ends early")
        return data

    def _directory(self) -> dict[str, tuple[int, int]]:
        """Where each stored member's bytes begin and how many there are, by name."""
        tail_size = min(self.size, 22 + 65_535 + 20)
        tail = self.range(self.size - tail_size, tail_size)
        at = tail.rfind(b"PK\x05\x06")
        if at < 0:
            raise ValueError("not a ZIP package: no end of central directory")
        count, length, start = struct.unpack("<HII", tail[at + 10:at + 20])
        where = self.size - tail_size + at
        if where >= 20 and (locator := self.range(where - 20, 20))[:4] == b"PK\x06\x07":
            end64 = self.range(struct.unpack("<Q", locator[8:16])[0], 56)
            if end64[:4] != b"PK\x06\x06":
                raise ValueError("broken ZIP64 end of central directory")
            count, length, start = struct.unpack("<QQQ", end64[32:56])
        table, pos, members = self.range(start, length), 0, {}
        for _ in range(count):
            if table[pos:pos + 4] != b"PK\x01\x02":
                raise ValueError("broken central directory")
            flags, method = struct.unpack("<HH", table[pos + 8:pos + 12])
            packed, plain, n_name, n_extra, n_note = struct.unpack("<IIHHH", table[pos + 20:pos + 34])
            local = struct.unpack("<I", table[pos + 42:pos + 46])[0]
            name = table[pos + 46:pos + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
            extra = table[pos + 46 + n_name:pos + 46 + n_name + n_extra]
            packed, plain, local = _wide(extra, packed, plain, local)
            if method == 0:
                members[name] = (local, plain)
            pos += 46 + n_name + n_extra + n_note
        return members

    def locate(self, name: str) -> tuple[int, int]:
        """Start and length of a member's bytes; the local header's own lengths say where they begin."""
        if name not in self.members:
            raise ValueError(f"no stored member {name}")
        local, length = self.members[name]
        head = self.range(local, 30)
        if head[:4] != b"PK\x03\x04":
            raise ValueError("broken local header")
        n_name, n_extra = struct.unpack("<HH", head[26:30])
        return local + 30 + n_name + n_extra, length

    def index(self) -> list[tuple[int, int]]:
        """Offset and length of every record in the archive."""
        start, length = self.locate(INDEX)
        return [tuple(map(int, line.split())) for line in self.range(start, length).decode().splitlines()]

    def records(self) -> Iterator[dict]:
        begin, length = self.locate(ARCHIVE)
        for offset, n in self.index():
            if offset + n > length:
                raise ValueError("the index points beyond the archive")
            yield parse_record(zlib.decompress(self.range(begin + offset, n), 31))


def _wide(extra: bytes, packed: int, plain: int, local: int) -> tuple[int, int, int]:
    """Replace saturated 32-bit fields by those of the ZIP64 extra field, which has them in a set order."""
    pos = 0
    while pos + 4 <= len(extra):
        kind, n = struct.unpack("<HH", extra[pos:pos + 4])
        if kind == 1:
            wide = iter(struct.unpack(f"<{n // 8}Q", extra[pos + 4:pos + 4 + n // 8 * 8]))
            plain = next(wide) if plain == 0xFFFFFFFF else plain
            packed = next(wide) if packed == 0xFFFFFFFF else packed
            local = next(wide) if local == 0xFFFFFFFF else local
        pos += 4 + n
    return packed, plain, local


def with_roles(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """`page_id`, `url`, `html` and `refers_to`: the smallest id with the same payload, NULL for a response."""
    rows = pages.select(quoted(id_col).cast("long").alias("page_id"), quoted(url_col).alias("url"),
                        F.coalesce(quoted(html_col), F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.unhex(F.sha1(F.col("html").cast("binary"))))
    rows = rows.withColumn("size", F.octet_length("html"))
    firsts = materialize(
        rows.filter(F.col("size") >= min_bytes).groupBy("sha", "size").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1 AND first IS NOT NULL"), "payloads").select(F.col("sha").alias("f_sha"), F.col("size").alias("f_size"), "first")
    out = rows.join(firsts, (F.col("sha") == F.col("f_sha")) & (F.col("size") == F.col("f_size")), "left")
    return out.select("page_id", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))


def write_packages(pages: DataFrame, folder: str | None = None, min_bytes: int = 0, level: int = 1, **columns: str) -> DataFrame:
    """Write a record per page; returns the manifest: `path`, `records`, `bytes` of every package, stored.

    A NULL payload is empty; a NULL url is left out; a page without an id is a revisit if another page with an
    id has its payload, else a response; a repeated id has several records, all responses if it is the smallest
    of its payload. An empty table writes no package. Other columns are not read.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "packages")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        task, out, serial, done = context.partitionId(), None, 0, []
        for b in batches:
            for page_id, url, html, refers in zip(*[b.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to")]):
                if out is None:
                    out = PackageWriter(f"{folder}/part-{task:06d}-{uuid.uuid4().hex}.wacz", level)
                out.add(record(page_id, url, html, f"{task}-{serial}", refers))
                serial += 1
                if out.offset >= PACKAGE_BYTES:
                    done.append(out.close())
                    out = None
        if out is not None:
            done.append(out.close())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], ["path", "records", "bytes"])

    rows = with_roles(pages, min_bytes, **columns).withColumn("html", F.col("html").cast("binary"))
    return materialize(rows.mapInArrow(run, "path string, records long, bytes long"), "manifest")


def read_packages(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """Records of all packages that the manifest lists, one task per few packages."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "record_type", "url", "payload_bytes", "payload_digest", "refers_to", "payload"]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
        for b in batches:
            for path in b.column("path").to_pylist():
                store, name = open_store(path)
                with store.open_input_file(name) as source:
                    held, size = [], 0
                    for r in Package(source, source.size()).records():
                        size += r["payload_bytes"]
                        held.append(r if payloads else r | {"payload": None})
                        if size > 8 << 20:
                            yield _batch(held, names, kinds)
                            held, size = [], 0
                    if held:
                        yield _batch(held, names, kinds)

    spread = manifest.select("path").repartition(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path")
    return spread.mapInArrow(run, "page_id long, record_type string, url string, payload_bytes long, payload_digest string, "
                                  "refers_to long, payload binary")


def _batch(held: list[dict], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in held], k) for n, k in zip(names, kinds)], names)
