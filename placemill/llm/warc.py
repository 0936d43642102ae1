"""WARC archives: written record by record, read back in sequence and verified.

A record is one gzip member. Rows with a payload that another row of a larger id holds,
too, become revisit records without a payload. Tasks write whole files into a shared folder; a
manifest lists the files of the tasks that counted, so that a file left by a lost or
repeated task is never read.

The reader takes a file from front to back in small pieces: it decompresses one member
as far as it needs, frames the block by Content-Length and checks the digests of block and
payload. What it holds at a time is a piece of the file and one payload.

Both sides reach the folder through ``pyarrow.fs``, by its URI or absolute path.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placemill.llm.shared import stored
from placemill.operators.spread import spread_join
from placemill.runtime import broadcast_if_small

# Fixed values of the format.
VERSION = b"WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http;msgtype=response"
GZIP = 31  # window bits of zlib that stand for gzip

ROW_ID = "urn:x-row"
CHUNK = 1 << 18
MAX_HEAD = 1 << 20
MAX_TASKS = 50_000
_SENT = 4 << 20  # bytes of payload in one batch of rows

MANIFEST = "path string, records long, bytes long"
RECORDS = (
    "path string, offset long, record_type string, record_id string, id string, "
    "target_uri string, refers_to string, payload_bytes long, payload_digest string, "
    "payload binary, damage string"
)


class Damaged(Exception):
    """An archive that does not hold what it declares."""


def _base32(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def _row_uri(key: str | None) -> str:
    return ROW_ID if key is None else f"{ROW_ID}:{quote(key, safe='')}"


def _key_of(uri: str | None) -> str | None:
    plain = (uri or "").strip("<>")
    return unquote(plain[len(ROW_ID) + 1 :]) if plain.startswith(ROW_ID + ":") else None


def _one_line(value: str) -> str:
    """A header value without blanks and control characters, which become %XX."""
    return "".join(quote(c) if c <= " " or c == "\x7f" else c for c in value)


def record_bytes(fields: list[tuple[str, str]], block: list[bytes]) -> bytes:
    """One WARC record as one gzip member."""
    digest = hashlib.sha1()
    for part in block:
        digest.update(part)
    fields = [
        *fields,
        ("WARC-Block-Digest", _base32(digest.digest())),
        ("Content-Length", str(sum(len(part) for part in block))),
    ]
    head = b"".join(f"{name}: {value}\r\n".encode() for name, value in fields)
    packer = zlib.compressobj(6, zlib.DEFLATED, GZIP)
    out = [packer.compress(VERSION + b"\r\n" + head + b"\r\n")]
    out += [packer.compress(part) for part in block]
    return b"".join([*out, packer.compress(b"\r\n\r\n"), packer.flush()])


def page_record(
    key: str | None, url: str | None, payload: bytes, original: str | None, date: str
) -> bytes:
    """A response with its payload, or a revisit of the row ``original`` without it."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    fields = [
        ("WARC-Type", "response" if original is None else "revisit"),
        ("WARC-Record-ID", f"<{_row_uri(key)}>"),
        ("WARC-Date", date),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", _one_line(url)))
    if original is not None:
        fields.append(("WARC-Refers-To", f"<{_row_uri(original)}>"))
        fields.append(("WARC-Profile", SAME_PAYLOAD))
    fields.append(("WARC-Payload-Digest", _base32(hashlib.sha1(payload).digest())))
    fields.append(("Content-Type", HTTP))
    return record_bytes(fields, [http] if original is not None else [http, payload])


def with_originals(pages: DataFrame, id_column: str, payload_column: str, least: int) -> DataFrame:
    """``pages`` with ``original``: the largest id among rows of equal payload, else null.

    Only payloads of at least ``least`` bytes count. Digests and ids are grouped, map side
    first; payloads move only if the repeated digests are too many for a broadcast, and then a
    hot digest is split by the join.
    """
    size = F.octet_length(payload_column).cast("long")
    keyed = pages.withColumns(
        {"size": size, "digest": F.when(size >= least, F.sha2(payload_column, 256))}
    )
    groups = (
        keyed.where(F.col("digest").isNotNull())
        .groupBy("digest", "size")
        .agg(F.max(id_column).alias("original"), F.count(F.lit(1)).alias("rows"))
        .where((F.col("rows") > 1) & F.col("original").isNotNull())
        .drop("rows")
    )
    groups = broadcast_if_small(stored(groups, "originals"))
    joined = spread_join(keyed, groups, ["digest", "size"], "left")
    later = F.col(id_column).isNull() | (F.col(id_column) < F.col("original"))
    return joined.withColumn("original", F.when(later, F.col("original"))).drop("digest", "size")


def write_archives(
    pages: DataFrame,
    folder: str,
    *,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
    least_revisit: int = 1000,
    archive_bytes: int = 256 << 20,
    date: str | None = None,
) -> DataFrame:
    """Writes a record for every row; returns the manifest (path, records, bytes), written.

    Of rows with equal payloads of at least ``least_revisit`` bytes, those with the largest
    id are responses and the others revisits of it; shorter ones are responses. Each task
    fills files of about ``archive_bytes`` and begins each with a warcinfo record.

    A null payload is empty. A null id is written as such and is never revisited while another
    row of the same payload has an id. Rows that repeat an id are records of their own; those
    that share the largest id of their payload are all responses. A null URL is left out;
    blanks and control characters in URLs are percent-encoded. Other columns are left out.
    No rows: no files and an empty manifest. ``date`` is the record date, by default now.
    """
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    payload = F.coalesce(F.col(payload_column).cast("string"), F.lit("")).cast("binary")
    chosen = pages.select(
        F.col(id_column).alias("id"),
        F.col(url_column).cast("string").alias("url"),
        payload.alias("payload"),
    )
    ready = with_originals(chosen, "id", "payload", least_revisit).select(
        F.col("id").cast("string"), "url", "payload", F.col("original").cast("string")
    )
    folder = folder.rstrip("/")

    def run(batches):
        target, root = fs.FileSystem.from_uri(folder)
        target.create_dir(root, recursive=True)
        task = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        done: list[tuple[str, int, int]] = []
        out = None
        records = size = 0

        def close():
            if out is not None:
                out.close()
                done.append((f"{folder}/{name}", records, size))

        name = ""
        for batch in batches:
            for key, url, body, original in zip(
                *(column.to_pylist() for column in batch.columns), strict=True
            ):
                if out is None or size >= archive_bytes:
                    close()
                    name = f"{task}-{len(done):04d}.warc.gz"
                    out = target.open_output_stream(f"{root}/{name}", compression=None)
                    about = [
                        ("WARC-Type", "warcinfo"),
                        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                        ("WARC-Date", date),
                        ("WARC-Filename", name),
                        ("Content-Type", "application/warc-fields"),
                    ]
                    first = record_bytes(about, [b"format: WARC File Format 1.1\r\n"])
                    out.write(first)
                    records, size = 0, len(first)
                member = page_record(key, url, body, original, date)
                out.write(member)
                records, size = records + 1, size + len(member)
        close()
        columns = list(zip(*done, strict=True)) or [[], [], []]
        kinds = (pa.string(), pa.int64(), pa.int64())
        yield pa.record_batch(
            [pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)],
            ["path", "records", "bytes"],
        )

    return stored(ready.mapInArrow(run, MANIFEST), "manifest")


class _File:
    """A compressed file read in pieces, with the place of the next byte."""

    def __init__(self, stream):
        self.stream, self.kept, self.place = stream, b"", 0

    def piece(self) -> bytes:
        data, self.kept = self.kept or self.stream.read(CHUNK), b""
        self.place += len(data)
        return data

    def give_back(self, data: bytes) -> None:
        self.kept, self.place = data, self.place - len(data)


class _Member:
    """One gzip member, decompressed no further than it is asked for."""

    def __init__(self, file: _File):
        self.file, self.inflate, self.ready = file, zlib.decompressobj(GZIP), bytearray()

    def _more(self) -> bool:
        if self.inflate.eof:
            return False
        data = self.inflate.unconsumed_tail or self.file.piece()
        try:
            found = self.inflate.decompress(data, CHUNK)
        except zlib.error as error:
            raise Damaged(f"not a gzip member: {error}") from error
        if not data and not found and not self.inflate.eof:
            raise Damaged("the file ends inside a record")
        self.ready += found
        if self.inflate.eof:
            self.file.give_back(self.inflate.unused_data)
        return True

    def take(self, size: int) -> bytes:
        """The next ``size`` bytes, fewer only at the end of the member."""
        while len(self.ready) < size and self._more():
            pass
        out = bytes(self.ready[:size])
        del self.ready[:size]
        return out

    def head(self, limit: int = MAX_HEAD) -> bytes:
        """The bytes up to an empty line, without it."""
        at = self.ready.find(b"\r\n\r\n")
        while at < 0:
            before = max(0, len(self.ready) - 3)
            if len(self.ready) > limit or not self._more():
                raise Damaged("a head without an end")
            at = self.ready.find(b"\r\n\r\n", before)
        return self.take(at + 4)[:-4]


def _fields(head: bytes) -> tuple[bytes, dict[str, str]]:
    first, *lines = head.split(b"\r\n")
    pairs = (line.decode("utf-8", "replace").partition(":") for line in lines)
    return first, {name.strip().lower(): value.strip() for name, _, value in pairs}


def _length(fields: dict[str, str], what: str) -> int:
    value = fields.get("content-length", "")
    if not (value.isascii() and value.isdigit()):
        raise Damaged(f"no Content-Length of {what}")
    return int(value)


class _Block:
    """The block of a record: ``length`` bytes of its member, digested as they pass."""

    def __init__(self, member: _Member, length: int):
        self.member, self.left, self.digest = member, length, hashlib.sha1()

    def _passed(self, data: bytes) -> bytes:
        self.left -= len(data)
        self.digest.update(data)
        return data

    def http_fields(self) -> dict[str, str]:
        head = self.member.head(min(MAX_HEAD, self.left))
        if len(head) + 4 > self.left:
            raise Damaged("the HTTP head goes beyond the block")
        self._passed(head + b"\r\n\r\n")
        return _fields(head)[1]

    def rest(self) -> bytes:
        parts = []
        while self.left:
            data = self.member.take(min(self.left, CHUNK))
            if not data:
                raise Damaged("the block is shorter than its Content-Length")
            parts.append(self._passed(data))
        return b"".join(parts)


def _record(member: _Member) -> dict:
    """One record of a member, checked against its lengths and digests."""
    first, fields = _fields(member.head())
    if not first.startswith(b"WARC/"):
        raise Damaged("not a WARC record")
    block = _Block(member, _length(fields, "the block"))
    kind, http = fields.get("warc-type"), None
    if fields.get("content-type", "").startswith("application/http"):
        http = block.http_fields()
    payload = block.rest()
    if member.take(5) != b"\r\n\r\n":
        raise Damaged("no record end after the block")
    declared = fields.get("warc-block-digest")
    if declared is not None and declared != _base32(block.digest.digest()):
        raise Damaged("the block does not have the digest of the record")
    size, digest = len(payload), _base32(hashlib.sha1(payload).digest())
    if http is not None:
        said = fields.get("warc-payload-digest")
        if kind == "revisit":
            if payload:
                raise Damaged("a revisit with a payload")
            size, digest = _length(http, "the payload"), said
        elif said is not None and said != digest:
            raise Damaged("the payload does not have the digest of the record")
        elif "content-length" in http and _length(http, "the payload") != size:
            raise Damaged("the payload does not have the length of the HTTP head")
    code = (digest or "").removeprefix("sha1:")
    target = fields.get("warc-refers-to")
    return {
        "record_type": kind,
        "record_id": fields.get("warc-record-id"),
        "id": _key_of(fields.get("warc-record-id")),
        "target_uri": fields.get("warc-target-uri"),
        "refers_to": _key_of(target) or target,
        "payload_bytes": size,
        "payload_digest": base64.b32decode(code).hex() if code else None,
        "payload": payload,
        "damage": None,
    }


def read_records(stream) -> Iterator[dict]:
    """The records of one open archive, front to back; the last may report damage."""
    file = _File(stream)
    while True:
        offset = file.place
        data = file.piece()
        if not data:
            return
        file.give_back(data)
        try:
            yield {"offset": offset, **_record(_Member(file))}
        except Damaged as error:
            yield {"offset": offset, "damage": str(error)}
            return


def archives_in(spark: SparkSession, folder: str) -> DataFrame:
    """(path) of all archives below a folder; their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return files.option("pathGlobFilter", "*.warc.gz").load(folder).select("path")


def read_archives(archives: DataFrame, *, strict: bool = True) -> DataFrame:
    """All records of the archives named in ``path``, in sequence within each file.

    One row a record, warcinfo included: place, type, ids, URI, length and digest of the
    payload, and the payload (of a revisit: empty, with length and digest of the original's).
    A record whose framing or digests are wrong, or a file that ends early, raises if
    ``strict``; else it is a row with ``damage`` set, and the rest of its file, where no
    record can be found any more, is not read. No archives: no rows. A null path is skipped.
    """
    paths = archives.where(F.col("path").isNotNull()).select("path")
    names = [part.split()[0] for part in RECORDS.split(", ")]
    kinds = {"offset": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}

    def rows_of(records: list[dict]) -> pa.RecordBatch:
        return pa.record_batch(
            [pa.array([r.get(n) for r in records], kinds.get(n, pa.string())) for n in names], names
        )

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                source, place = fs.FileSystem.from_uri(path)
                with source.open_input_stream(place, compression=None) as stream:
                    for record in read_records(stream):
                        if strict and record["damage"] is not None:
                            raise Damaged(f"{path} at {record['offset']}: {record['damage']}")
                        held.append({"path": path, **record})
                        size += len(record.get("payload") or b"")
                        if size > _SENT:
                            yield rows_of(held)
                            held, size = [], 0
        if held:
            yield rows_of(held)

    # A file is one unit of work. The names are few bytes, so without a number of partitions
    # adaptive execution would put all of them into one task.
    tasks = min(max(1, paths.count()), MAX_TASKS)
    return paths.repartition(tasks).mapInArrow(run, RECORDS)
