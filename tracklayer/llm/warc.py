"""WARC archives: a writer with revisit records, and a reader that salvages what damage leaves.

Writing: one gzip member for each record, files of bounded size in the shared folder, each named at random. A task reports
the files it closed, and that report is written by Spark's own commit: what lost or repeated tasks leave behind is in no
report and never read. Records with equal payloads of some size are stored once; the others revisit that record. Which one
is settled by a maximum for each digest, combined map-side, so a payload that a third of all pages share is no hot group.

Reading: a file is read in small steps, and a record must pass every check: gzip CRC, version line, length, closing lines,
block and payload digest. After a failed check the reader looks for the next offset where a valid member, or a valid record
after a version line, begins. The bytes between are logged as a gap with the reason, and reading goes on behind it.

Defined results: a null payload is empty; a null URL gives a record without target; control characters in URLs are
percent-encoded; pages with a repeated largest id are all responses; a null id is null again after reading. An empty table
gives no file. Other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklayer.llm.common import file_system, stored
from tracklayer.session import work_path

FILE_BYTES = 16 << 20
REVISIT_BYTES = 1000
MOST_TASKS = 4096
_STEP = 1 << 16
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HEAD = re.compile(rb"WARC/1\.[01]\r\n(.*?)\r\n\r\n", re.S)
_HTTP_LENGTH = re.compile(rb"(?im)^content-length:\s*(\d+)\s*$")


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def format_record(record_id: str, url: str | None, payload: bytes, refers_to: str | None, date: str) -> bytes:
    """A response with its payload, or a revisit with the HTTP head alone."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if refers_to is None:
        block += payload
    else:
        fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", refers_to)]
    fields += [("WARC-Payload-Digest", _sha1(payload)), ("WARC-Block-Digest", _sha1(block))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def with_revisits(pages: DataFrame, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Adds refers_to: for a payload of at least `least_bytes` the largest id with an equal one, null on that page itself."""
    pages = pages.withColumn("digest", F.sha1("payload"))
    firsts = (
        pages.where(F.length("payload") >= least_bytes)
        .groupBy("digest")
        .agg(F.max("id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 and first is not null")
        .select("digest", "first")
    )
    refers = F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first"))
    return pages.join(firsts, "digest", "left").select("id", "url", "payload", refers.alias("refers_to"))


def write_warc(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", folder: str | None = None, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Archives of all pages; returns one row for each file: path, records, bytes."""
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    records = with_revisits(pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload")))
    records = records.select(F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"), "url", "payload", F.col("refers_to").cast("string").alias("refers_to"))
    folder = folder or work_path(pages.sparkSession, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(folder)
        fs.create_dir(root, recursive=True)
        out, path, count, size, done = None, "", 0, 0, []
        for batch in batches:
            for name, url, payload, refers in zip(*(batch.column(i) for i in range(4)), strict=True):
                refers = refers.as_py()
                record = format_record(f"<urn:page:{name.as_py()}>", url.as_py(), payload.as_py(), None if refers is None else f"<urn:page:{refers}>", date)
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                member = packer.compress(record) + packer.flush()
                if out is None:
                    path, count, size = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(path, compression=None)
                out.write(member)
                count, size = count + 1, size + len(member)
                if size >= FILE_BYTES:
                    out.close()
                    out = done.append((path, count, size))
        if out is not None:
            out.close()
            done.append((path, count, size))
        yield pa.RecordBatch.from_pylist([{"path": p.rsplit("/", 1)[1], "records": n, "bytes": b} for p, n, b in done], pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    files = records.mapInArrow(write, "path string, records long, bytes long")
    return stored(files.select(F.concat(F.lit(folder + "/"), "path").alias("path"), "records", "bytes"), "warc-files")


class Damage(Exception):
    """Why a member or record failed its checks."""


class Salvage:
    """Records and gaps of one archive, gzip members or plain records, in file order."""

    def __init__(self, file: pa.NativeFile):
        self.file, self.size = file, file.size()

    def _at(self, offset: int, length: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(min(length, self.size - offset))

    def _member(self, offset: int) -> tuple[bytes, int]:
        unpack, parts, at = zlib.decompressobj(31), [], offset
        while not unpack.eof:
            piece = self._at(at, _STEP)
            if not piece:
                raise Damage("cut short")
            try:
                parts.append(unpack.decompress(piece))
            except zlib.error as e:
                raise Damage("not a valid gzip member") from e
            at += len(piece)
        return b"".join(parts), at - len(unpack.unused_data) - offset

    def _plain(self, offset: int) -> tuple[bytes, int]:
        data = b""
        while not (head := _HEAD.match(data)):
            piece = self._at(offset + len(data), _STEP)
            if not piece or not b"WARC/1.".startswith(data[:7]) and not data.startswith(b"WARC/1."):
                raise Damage("no record header")
            data += piece
        length = head.end() + _length(head[1]) + 4
        if offset + length > self.size:
            raise Damage("cut short")
        return self._at(offset, length), length

    def _valid(self, offset: int) -> tuple[list[dict], int]:
        start = self._at(offset, 3)
        data, length = self._member(offset) if start == b"\x1f\x8b\x08" else self._plain(offset)
        records, at = [], 0
        while at < len(data):
            record, used = parse_record(data, at)
            records.append(record)
            at += used
        if not records:
            raise Damage("empty member")
        return [r | {"offset": offset, "length": length} for r in records], length

    def _candidates(self, offset: int) -> Iterator[int]:
        """Offsets where a member or a version line may begin."""
        start, tail = offset, b""
        while start < self.size:
            piece = self._at(start, _STEP)
            data, base = tail + piece, start - len(tail)
            for m in re.finditer(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n", data):
                if base + m.start() >= offset and m.end() > len(tail):
                    yield base + m.start()
            start, tail = start + len(piece), data[-9:]

    def __iter__(self) -> Iterator[dict]:
        at = 0
        while at < self.size:
            try:
                records, length = self._valid(at)
            except Damage as e:
                next_at = self.size
                for offset in self._candidates(at + 1):
                    try:
                        self._valid(offset)
                    except Damage:
                        continue
                    next_at = offset
                    break
                yield {"kind": "gap", "offset": at, "length": next_at - at, "reason": str(e)}
                at = next_at
            else:
                yield from records
                at += length


def _length(head: bytes) -> int:
    found = re.search(rb"(?im)^content-length:[ \t]*(\d+)[ \t\r]*$", head)
    if not found:
        raise Damage("no length")
    return int(found[1])


def parse_record(data: bytes, at: int) -> tuple[dict, int]:
    """The record that begins at `at`, all checks passed, and its length."""
    head = _HEAD.match(data, at)
    if not head:
        raise Damage("no version line or header")
    end = head.end() + _length(head[1])
    if data[end : end + 4] != b"\r\n\r\n":
        raise Damage("wrong length")
    fields = {}
    for line in head[1].decode("utf-8", "replace").split("\r\n"):
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    block = data[head.end() : end]
    if fields.get("warc-block-digest", _sha1(block)) != _sha1(block):
        raise Damage("block digest differs")
    http, _, payload = block.partition(b"\r\n\r\n")
    kind, digest = fields.get("warc-type", ""), fields.get("warc-payload-digest")
    if kind == "revisit":
        stated = _HTTP_LENGTH.search(http)
        size = int(stated[1]) if stated else None
        payload = None
    else:
        size = len(payload)
        if digest not in (None, computed := _sha1(payload)):
            raise Damage("payload digest differs")
        digest = computed
    record = {"kind": "record", "record_id": fields.get("warc-record-id"), "record_type": kind, "url": fields.get("warc-target-uri"), "refers_to": fields.get("warc-refers-to"), "payload": payload, "payload_bytes": size}
    return record | {"payload_digest": base64.b32decode(digest[5:]).hex() if digest else None}, end + 4 - at


_SCHEMA = {
    "path": pa.string(),
    "kind": pa.string(),
    "offset": pa.int64(),
    "length": pa.int64(),
    "reason": pa.string(),
    "record_id": pa.string(),
    "record_type": pa.string(),
    "url": pa.string(),
    "refers_to": pa.string(),
    "payload_bytes": pa.int64(),
    "payload_digest": pa.string(),
    "payload": pa.binary(),
}


def read_warc(files: DataFrame, payload: bool = True) -> DataFrame:
    """Records and gaps (`kind`) of the archives in `files.path`; payloads are verified even where they are not returned."""
    schema = pa.schema([(k, t) for k, t in _SCHEMA.items() if payload or k != "payload"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                fs, name = file_system(path)
                rows, held = [], 0
                with fs.open_input_file(name) as file:
                    for row in Salvage(file):
                        rows.append({"path": path} | {k: v for k, v in row.items() if payload or k != "payload"})
                        held += len(row.get("payload") or b"")
                        if held > 8 << 20 or len(rows) >= 2000:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    names = {pa.string(): "string", pa.int64(): "long", pa.binary(): "binary"}
    tasks = max(1, min(files.count(), MOST_TASKS))
    return files.select("path").repartition(tasks).mapInArrow(read, ", ".join(f"{f.name} {names[f.type]}" for f in schema))
