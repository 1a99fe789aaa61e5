"""WARC archives of pages: written in segments with chunked bodies, read back and rejoined.

Every page becomes one record, compressed as a gzip member of its own. Of pages with
equal payloads the one with the smallest id is a ``response``, the others are
``revisit`` records that name it. Bodies are sent in chunked transfer framing. A record
block above ``segment_bytes`` is split: the first segment keeps the record's type, the
rest are ``continuation`` records that name the first and their number, the last also
the total length. A reader takes the segments of a record from any archives, groups
them by the record they continue, orders them, checks their number and total length, and
decodes the framing.

Archives are files of bounded size in a shared folder. A task writes under a name of its
own attempt and renames at the end, so a repeated task replaces its files.

Defined results: a null payload is an empty one, and empty payloads are equal payloads
like any others. Null ids come after all others and make a response only where a
payload has no other page; ``refers_to`` is null then. Of repeated rows with the smallest
id one is the response. An empty table makes no archive. Extra columns are not
written. A damaged archive raises, rather than giving fewer pages.
"""

from __future__ import annotations

import base64
import hashlib
import io
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.runtime import materialise, own_columns, prepare, slices
from eventmart.llm.token_shards import rename

VERSION = b"WARC/1.1"
# Blocks above this are segmented; a good part of real pages is.
SEGMENT_BYTES = 4 << 10
CHUNK_BYTES = 8 << 10
ARCHIVE_BYTES = 256 << 20
LEVEL = 1
READ_BYTES = 1 << 20

# Field names of the standard.
RECORD_ID, TYPE, LENGTH, TARGET = "WARC-Record-ID", "WARC-Type", "Content-Length", "WARC-Target-URI"
DIGEST, BLOCK_DIGEST, REFERS = "WARC-Payload-Digest", "WARC-Block-Digest", "WARC-Refers-To"
SEGMENT, ORIGIN, TOTAL = "WARC-Segment-Number", "WARC-Segment-Origin-ID", "WARC-Segment-Total-Length"
DATE, PROFILE = "WARC-Date", "WARC-Profile"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WRITTEN_AT = "1970-01-01T00:00:00Z"  # the tables have no moment of capture
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"

NARROW = "record_id string, page_id string, record_type string, payload_bytes long, payload_digest string, refers string"
READ = NARROW + ", origin string, segment int, total long, block binary"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def chunked(data: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing of a body."""
    parts = []
    for i in range(0, len(data), size):
        piece = data[i : i + size]
        parts += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(data: bytes) -> bytes:
    """The body inside chunked framing, whose last chunk must be there."""
    parts, at = [], 0
    while True:
        line = data.find(b"\r\n", at)
        if line < 0:
            raise ValueError("a chunk's size is missing")
        size = int(data[at:line].split(b";")[0], 16)
        at = line + 2
        if size == 0:
            return b"".join(parts)
        if data[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk is shorter than it says")
        parts.append(data[at : at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes:
    """The decoded body of an HTTP response."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        raise ValueError("an HTTP response has no end of its head")
    framed = any(
        line.lower().replace(b" ", b"") == b"transfer-encoding:chunked" for line in head.split(b"\r\n")[1:]
    )
    return unchunked(body) if framed else body


@dataclass
class Record:
    fields: dict[str, str]
    block: bytes = b""

    def encoded(self) -> bytes:
        fields = self.fields | {DATE: WRITTEN_AT, BLOCK_DIGEST: "sha1:" + base32_sha1(self.block), LENGTH: str(len(self.block))}
        head = b"".join(f"{k}: {v}\r\n".encode() for k, v in fields.items())
        plain = b"".join([VERSION, b"\r\n", head, b"\r\n", self.block, b"\r\n\r\n"])
        pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)  # 31: a gzip member
        return pack.compress(plain) + pack.flush()


def segments(record: Record, segment_bytes: int = SEGMENT_BYTES) -> Iterator[Record]:
    """The record itself, or its segments if its block is long."""
    block = record.block
    if len(block) <= segment_bytes:
        yield record
        return
    own = record.fields[RECORD_ID]
    count = -(-len(block) // segment_bytes)
    for number in range(1, count + 1):
        piece = block[(number - 1) * segment_bytes : number * segment_bytes]
        if number == 1:
            yield Record(record.fields | {SEGMENT: "1"}, piece)
            continue
        fields = {TYPE: "continuation", RECORD_ID: f"{own[:-1]}:{number}>", ORIGIN: own, SEGMENT: str(number)}
        if TARGET in record.fields:
            fields[TARGET] = record.fields[TARGET]
        if number == count:
            fields[TOTAL] = str(len(block))
        yield Record(fields, piece)


def _uri(url: str | None) -> str:
    """A URL on one line."""
    return "".join((url or "about:blank").split()) or "about:blank"


def _quoted(page_id) -> str:
    """An id inside a record's name, where colons and line ends mean something else; empty for null."""
    return "" if page_id is None else "=" + quote(str(page_id), safe="")


def page_record(page_id, url: str | None, payload: bytes, digest: str, record_type: str, refers: str | None, place: str) -> Record:
    own = _quoted(page_id)
    record_id = f"<urn:page:{own}:{digest}>" if record_type == "response" else f"<urn:revisit:{own}:{place}>"
    fields = {TYPE: record_type, RECORD_ID: record_id, TARGET: _uri(url), DIGEST: "sha1:" + digest}
    if record_type == "response":
        return Record(fields, HTTP_HEAD + chunked(payload))
    return Record(fields | {REFERS: f"<urn:page:{_quoted(refers)}:{digest}>", PROFILE: SAME_PAYLOAD})


@lru_cache(maxsize=8)
def _filesystem(root: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(root)


class _Inflated(io.RawIOBase):
    """The plain bytes of a file of gzip members, read in blocks."""

    def __init__(self, source):
        self._source, self._left, self._unpack = source, b"", zlib.decompressobj(31)

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        while True:
            if not self._left:
                self._left = self._source.read(READ_BYTES)
                if not self._left:
                    if not self._unpack.eof and self._started:
                        raise ValueError("the archive ends inside a record")
                    return 0
            if self._unpack.eof:
                self._unpack = zlib.decompressobj(31)
            self._started = True
            plain = self._unpack.decompress(self._left, len(into))
            self._left = self._unpack.unused_data if self._unpack.eof else self._unpack.unconsumed_tail
            if plain:
                into[: len(plain)] = plain
                return len(plain)

    _started = False


def records(source) -> Iterator[Record]:
    """The records of an open archive, blocks checked against their lengths and digests."""
    plain = io.BufferedReader(_Inflated(source), READ_BYTES)
    while line := plain.readline():
        if line.rstrip() != VERSION:
            raise ValueError(f"no record begins with {line[:40]!r}")
        fields = {}
        while (line := plain.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            fields[name] = value.strip()
        length = int(fields[LENGTH])
        block = plain.read(length)
        if len(block) != length or plain.read(4) != b"\r\n\r\n":
            raise ValueError(f"{fields[RECORD_ID]} is cut off")
        if fields.get(BLOCK_DIGEST, "") != "sha1:" + base32_sha1(block):
            raise ValueError(f"{fields[RECORD_ID]} is damaged")
        yield Record(fields, block)


@dataclass
class _Writer:
    """Archives of one task; a new one begins when the last is large enough."""

    root: str
    task: int
    attempt: int
    done: list[dict] = field(default_factory=list)
    _out = None

    def _open(self) -> None:
        self._fs, folder = _filesystem(self.root)
        name = f"pages-{self.task:06d}-{len(self.done):04d}.warc.gz"
        self._name, self._path, self._hidden = name, f"{folder}/{name}", f"{folder}/.{name}.{self.attempt}"
        self._out, self._size, self._records = self._fs.open_output_stream(self._hidden), 0, 0
        self._put(Record({TYPE: "warcinfo", RECORD_ID: f"<urn:archive:{name}>"}, b"format: WARC File Format 1.1\r\n"))

    def _put(self, record: Record) -> None:
        data = record.encoded()
        self._out.write(data)
        self._size += len(data)
        self._records += 1

    def add(self, record: Record, segment_bytes: int) -> None:
        if self._out is None:
            self._open()
        for part in segments(record, segment_bytes):
            self._put(part)
        if self._size >= ARCHIVE_BYTES:
            self.close()

    def close(self) -> None:
        if self._out is None:
            return
        self._out.close()
        rename(self._fs, self._hidden, self._path)
        self.done.append({"path": self._name, "n_records": self._records, "n_bytes": self._size})
        self._out = None


def _payload(text: Column) -> Column:
    return F.encode(F.coalesce(text, F.lit("")), "UTF-8")


def decided(pages: DataFrame, key: str, html: str) -> DataFrame:
    """``pages`` with ``_digest`` (SHA-1), ``_response`` and ``_refers`` (the response's id)."""
    digest, least, n, n_least, mine, same = own_columns(pages, "_digest", "_least", "_n", "_n_least", "_same_digest", "_place")
    narrow = materialise(
        pages.select(F.col(key).alias("id"), F.unhex(F.sha1(_payload(F.col(html)))).alias("digest"))
        .groupBy("digest", "id")
        .agg(F.count("*").alias("copies")),
        "page-digests",
    )
    # Only payloads that come again need a decision; nulls are no smallest id unless alone.
    repeated = narrow.groupBy("digest").agg(F.sum("copies").alias("n"), F.min("id").alias("least")).where("n > 1")
    shared = materialise(
        repeated.join(narrow.withColumnRenamed("digest", "_d"), F.col("digest") == F.col("_d"))
        .where(F.col("id").eqNullSafe(F.col("least")))
        .select("digest", "least", F.col("copies").alias("n_least")),
        "page-shared",
    ).select(F.col("digest").alias(mine), F.col("least").alias(least), F.col("n_least").alias(n_least))
    told = pages.withColumn(digest, F.unhex(F.sha1(_payload(F.col(html))))).join(
        shared, F.col(digest) == F.col(mine), "left"
    )
    first = F.col(mine).isNull() | F.col(key).eqNullSafe(F.col(least))
    told = told.withColumn("_response", first)
    if not shared.where(F.col(n_least) > 1).isEmpty():
        # Repeated rows of a response: the first stays one, the others revisit it.
        tied = F.coalesce(F.col("_response") & (F.col(n_least) > 1), F.lit(False))
        order = Window.partitionBy(digest).orderBy(key)
        told = told.where(~tied).unionByName(
            told.where(tied).withColumn(same, F.row_number().over(order)).withColumn("_response", F.col(same) == 1).drop(same)
        )
    return told.select(
        *pages.columns,
        F.col(digest).alias("_digest"),
        "_response",
        F.when(~F.col("_response"), F.col(least)).alias("_refers"),
    )


def write(pages: DataFrame, key: str, url: str, html: str, root: str, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Writes archives of all pages below ``root`` (an existing folder); returns a row an archive."""
    prepare(pages.sparkSession)
    narrow = pages.select(F.col(key).alias("id"), F.col(url).alias("url"), F.col(html).alias("html"))
    rows = decided(narrow, "id", "html").select(
        F.col("id").cast("string").alias("id"), "url", _payload(F.col("html")).alias("payload"), "_digest", "_response",
        F.col("_refers").cast("string").alias("refers"),
    )

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        writer = _Writer(root, context.partitionId(), context.taskAttemptId())
        at = 0
        for batch in slices(batches):
            for row in batch.to_pylist():
                digest = base64.b32encode(row["_digest"]).decode()
                kind = "response" if row["_response"] else "revisit"
                place = f"{context.partitionId()}.{at}"
                writer.add(
                    page_record(row["id"], row["url"], row["payload"], digest, kind, row["refers"], place), segment_bytes
                )
                at += 1
        writer.close()
        yield pa.RecordBatch.from_pylist(
            writer.done, schema=pa.schema([("path", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())])
        )

    return materialise(rows.mapInArrow(written, "path string, n_records long, n_bytes long"), "warc-manifest")


def _page_of(record_id: str) -> str | None:
    """The page's id inside one of our record names."""
    quoted = record_id[1:-1].split(":")[2]
    return unquote(quoted[1:]) if quoted else None


_ARROW_READ = pa.schema(
    [
        ("record_id", pa.string()),
        ("page_id", pa.string()),
        ("record_type", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("refers", pa.string()),
        ("origin", pa.string()),
        ("segment", pa.int32()),
        ("total", pa.int64()),
        ("block", pa.binary()),
    ]
)


def _described(fields: dict[str, str], payload: bytes) -> dict:
    """What a whole response says, its payload held against its digest."""
    digest = base32_sha1(payload)
    if fields[DIGEST] != "sha1:" + digest:
        raise ValueError(f"the payload of {fields[RECORD_ID]} does not have its digest")
    return {"payload_bytes": len(payload), "payload_digest": digest}


def _row(record: Record) -> dict:
    fields = record.fields
    row = {"record_id": fields[RECORD_ID], "record_type": fields[TYPE]}
    if fields[TYPE] == "continuation":
        total = int(fields[TOTAL]) if TOTAL in fields else None
        return row | {"origin": fields[ORIGIN], "segment": int(fields[SEGMENT]), "total": total, "block": record.block}
    row["page_id"] = _page_of(fields[RECORD_ID])
    if fields[TYPE] == "revisit":
        return row | {"refers": fields[REFERS], "payload_digest": fields[DIGEST].removeprefix("sha1:")}
    if SEGMENT in fields:
        digest = fields[DIGEST].removeprefix("sha1:")
        return row | {"payload_digest": digest, "origin": fields[RECORD_ID], "segment": 1, "block": record.block}
    return row | _described(fields, http_payload(record.block))


def _read(archives: DataFrame, root: str) -> DataFrame:
    """Whole records described, segments with their blocks."""

    def loaded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = _filesystem(root)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with fs.open_input_file(f"{folder}/{name}") as source:
                    for record in records(source):
                        if record.fields[TYPE] == "warcinfo":
                            continue
                        rows.append(_row(record))
                        held += len(rows[-1].get("block", b""))
                        if len(rows) >= 4_096 or held >= 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW_READ)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=_ARROW_READ)

    spark = archives.sparkSession
    width = max(1, min(archives.count(), 100_000))
    return archives.select("path").repartition(width).mapInArrow(loaded, READ)


def _rejoined(parts: DataFrame) -> DataFrame:
    """Segmented records put together again, one row a record."""
    ordered = parts.groupBy("origin").agg(
        F.array_sort(F.collect_list(F.struct("segment", "block"))).alias("parts"),
        F.max("total").alias("total"),
        F.max("page_id").alias("page_id"),
        F.max("payload_digest").alias("payload_digest"),
    )

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 16):
            rows = []
            for row in batch.to_pylist():
                numbers = [part["segment"] for part in row["parts"]]
                block = b"".join(part["block"] for part in row["parts"])
                if numbers != list(range(1, len(numbers) + 1)) or len(block) != row["total"]:
                    raise ValueError(f"segments of {row['origin']} are missing: {numbers}, {len(block)} of {row['total']} bytes")
                fields = {RECORD_ID: row["origin"], DIGEST: "sha1:" + row["payload_digest"]}
                rows.append(
                    {"record_id": row["origin"], "page_id": row["page_id"], "record_type": "response", "refers": None}
                    | _described(fields, http_payload(block))
                )
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([_ARROW_READ.field(i) for i in range(6)]))

    return ordered.mapInArrow(joined, NARROW)


def read(archives: DataFrame, root: str, key_type: str = "long") -> DataFrame:
    """``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type`` and ``refers_to`` of every page."""
    prepare(archives.sparkSession)
    found = materialise(_read(archives, root), "warc-records")
    names = [name.split()[0] for name in NARROW.split(", ")]
    whole = found.where("origin is null").select(names).unionByName(_rejoined(found.where("origin is not null")))
    whole = materialise(whole, "warc-pages")
    responses = whole.where("record_type = 'response'").select(
        F.col("record_id").alias("_target"), F.col("payload_bytes").alias("_bytes"), F.col("page_id").alias("_page")
    )
    revisits = whole.where("record_type = 'revisit'")
    # Responses that are named at all, so that a common payload's revisits find a small table.
    named = responses.join(revisits.select("refers").distinct(), F.col("_target") == F.col("refers"), "left_semi")
    resolved = revisits.join(named, F.col("refers") == F.col("_target"), "left")
    final = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return (
        whole.where("record_type = 'response'")
        .withColumn("refers_to", F.lit(None).cast("string"))
        .select(*final)
        .unionByName(resolved.withColumn("payload_bytes", F.col("_bytes")).withColumn("refers_to", F.col("_page")).select(*final))
        .withColumns({"page_id": F.col("page_id").cast(key_type), "refers_to": F.col("refers_to").cast(key_type)})
    )
