"""WARC archives: one compressed member per record, revisits of equal payloads, and a reader that salvages.

The reader checks every record: the member's own checksum, version line, headers, length, the two line ends behind the
block, and the digests the headers name. When a check fails it searches for the next place where a member or a
version line begins and a whole record can be read, goes on there, and reports the bytes between as a
quarantined gap. Records of a member that is sound itself but fails a check are quarantined with that member.

Files are written under names of their own attempt and returned in a manifest; only returned names count, so that lost
executors and repeated attempts leave nothing but files nobody refers to.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almoner.llm.token_files import _open
from almoner.session import materialize

# fixed values: what the format prescribes
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MEMBER = b"\x1f\x8b\x08"
_BEGIN = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
_BEGIN_SIZE = 10

_BLOCK = 4 << 20
_CHUNK = 1 << 15
_HEADERS = 1 << 20  # bytes of headers at most
_FLUSH = 8 << 20
_ID = re.compile(r"<urn:page:(-?[0-9]*)>")
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")
_MANIFEST = "path string, records long, bytes long"


# --- writing


def _head(status: str, size: int) -> bytes:
    return f"HTTP/1.1 {status}\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()


def record_id(key: int | None) -> str:
    return f"<urn:page:{'' if key is None else key}>"


def pack_record(headers: list[tuple[str, str]], block: bytes, level: int = 6) -> bytes:
    """One record as a member of its own."""
    lines = [*headers, ("WARC-Block-Digest", "sha256:" + hashlib.sha256(block).hexdigest()), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in lines) + "\r\n"
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    return pack.compress(head.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n") + pack.flush()


def first_holders(rows: DataFrame, salts: int) -> DataFrame:
    """(digest, salt, first): the smallest id of every payload that several rows have, once per salt."""
    groups = rows.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("held")).where("held > 1")
    return groups.select("digest", "first", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))


def write_warc(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    date: str = "2024-01-01T00:00:00Z",
    min_bytes: int = 100,
    salts: int = 16,
    level: int = 6,
    file_bytes: int = 1 << 30,
) -> DataFrame:
    """Write one record per row below `folder`; returns the manifest (path, records, bytes).

    Of the rows whose payloads are equal and have at least min_bytes bytes, the one with the smallest id is a response and
    the others are revisits that refer to it and hold no payload; all other rows are responses. Rows that
    repeat the smallest id are responses too. Null payloads are empty ones; null ids come after all others, and among null
    ids alone all are responses. Blanks and control characters of a URL are percent-encoded, a null URL is left out. An
    empty table gives an empty manifest; other columns are ignored.

    Payloads are grouped by sha256 with partial minima; the holders' ids go back to the rows on (digest, salt), so a
    payload that many rows share is met in `salts` places, and the payload of a revisit stays behind. A task holds
    one record at a time and begins a new file after file_bytes. `folder` must be reachable from all executors through
    pyarrow.fs.
    """
    payload = F.coalesce(F.col(payload_col).cast("string").cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload")
    ).withColumns({"digest": F.sha2("payload", 256), "size": F.octet_length("payload").cast("long")})
    holders = first_holders(rows.where(F.col("size") >= min_bytes).select("page_id", "digest"), salts)
    salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).cast("int")
    held = rows.withColumn("salt", salt).join(holders, ["digest", "salt"], "left")
    # a null id is not the smallest of a group that has one
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    ready = held.select(
        "page_id", "url", F.when(~again, F.col("payload")).alias("payload"), "digest", "size", F.when(again, F.col("first")).alias("first")
    )
    store, path = _open(folder)
    store.create_dir(path, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to, at = _open(folder)
        part, out, name, records, size = TaskContext.get().partitionId(), None, "", 0, 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "records": [records], "bytes": [size]})

        for batch in batches:
            for k in range(batch.num_rows):
                key, url, body, digest, length, first = (c[k].as_py() for c in batch.columns)
                headers = [("WARC-Type", "response" if first is None else "revisit"), ("WARC-Record-ID", record_id(key)), ("WARC-Date", date)]
                if url is not None:
                    headers.append(("WARC-Target-URI", _UNSAFE.sub(lambda m: f"%{ord(m.group()):02X}", url)))
                headers.append(("WARC-Payload-Digest", f"sha256:{digest}"))
                if first is not None:
                    headers += [("WARC-Profile", REVISIT), ("WARC-Refers-To", record_id(first))]
                headers.append(("Content-Type", "application/http;msgtype=response"))
                if out is None:
                    name, records, size = f"part-{part:06d}-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = to.open_output_stream(f"{at}/{name}", compression=None)
                packed = pack_record(headers, _head("200 OK", length) + (body or b""), level)
                out.write(packed)
                records, size = records + 1, size + len(packed)
                if size >= file_bytes:
                    out.close()
                    yield row()
                    out = None
        if out is not None:
            out.close()
            yield row()

    return materialize(ready.mapInArrow(run, _MANIFEST))


# --- reading


class Damaged(Exception):
    """A check failed; `end` is where reading can go on if the member around the record is sound."""

    def __init__(self, reason: str, end: int | None = None):
        super().__init__(reason)
        self.reason, self.end = reason, end


@dataclass
class Record:
    """A checked record: its place in the file, headers by lower-case name, and block."""

    start: int
    end: int
    headers: dict[str, str]
    block: bytes
    parts: tuple[bytes, bytes] = field(init=False)

    def __post_init__(self) -> None:
        http = self.headers.get("content-type", "").lower().startswith("application/http")
        head, gap, rest = self.block.partition(b"\r\n\r\n") if http else (b"", b"", self.block)
        self.parts = (head, rest) if gap or not http else (self.block, b"")

    @property
    def payload(self) -> bytes:
        return self.parts[1]

    def payload_bytes(self) -> int:
        """Size of the full payload; a revisit's is the length that its HTTP headers name."""
        if self.headers["warc-type"] == "revisit":
            named = re.search(rb"(?im)^content-length:[ \t]*([0-9]+)[ \t]*\r?$", self.parts[0])
            if named:
                return int(named[1])
        return len(self.payload)

    def payload_digest(self) -> str:
        """sha256 of the full payload in hex; a revisit's is the one its header names."""
        if self.headers["warc-type"] == "revisit":
            return self.headers.get("warc-payload-digest", "").rpartition(":")[2].lower()
        return hashlib.sha256(self.payload).hexdigest()


def _agrees(named: str, data: bytes) -> bool:
    """Whether a labelled digest is that of `data`; kinds not known here are not checked."""
    kind, _, value = named.partition(":")
    kind = kind.strip().lower().replace("-", "")
    if kind not in ("md5", "sha1", "sha256", "sha512"):
        return True
    digest = hashlib.new(kind, data, usedforsecurity=False)
    return value.strip().lower() == digest.hexdigest() or value.strip().rstrip("=") == base64.b32encode(digest.digest()).decode().rstrip("=")


def _headers(raw: bytes) -> dict[str, str]:
    """Headers by lower-case name; folded lines are joined to the one before."""
    out: dict[str, str] = {}
    name = ""
    for line in raw.decode("utf-8", "surrogateescape").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
            continue
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise Damaged("header line")
        name = name.strip().lower()
        out[name] = value.strip()
    return out


def _record(data: bytes, at: int, start: int, end: int) -> tuple[Record, int]:
    """The record at data[at:], which came from the file's bytes start to end, and where it ends in `data`."""
    if not VERSION.match(data, at):
        raise Damaged("version line")
    stop = data.find(b"\r\n\r\n", at, at + _HEADERS)
    if stop < 0:
        raise Damaged("headers without end")
    headers = _headers(data[at:stop])
    length = headers.get("content-length", "")
    if not (length.isascii() and length.isdigit()) or "warc-type" not in headers:
        raise Damaged("headers")
    begin, last = stop + 4, stop + 4 + int(length)
    if data[last : last + 4] != b"\r\n\r\n":
        raise Damaged("length")
    record = Record(start, end, headers, bytes(data[begin:last]))
    if not _agrees(headers.get("warc-block-digest", ""), record.block):
        raise Damaged("block digest")
    full = headers["warc-type"] != "revisit" and "warc-segment-number" not in headers
    if full and not _agrees(headers.get("warc-payload-digest", ""), record.payload):
        raise Damaged("payload digest")
    return record, last + 4


class SalvageReader:
    """Records and gaps of one file, in order; a block and a record are held at a time."""

    def __init__(self, path: str):
        store, own = _open(path)
        self.file = store.open_input_file(own)
        self.size = self.file.size()
        self.first, self.block = 0, b""

    def read(self, at: int, size: int) -> bytes:
        """Up to `size` bytes at `at`, through a block that is kept."""
        at_end = min(self.size, at + size)
        if not (self.first <= at and at_end <= self.first + len(self.block)):
            self.first, self.block = at, self.file.read_at(max(_BLOCK, size), at)
        return self.block[at - self.first : at_end - self.first]

    def _member(self, start: int) -> list[Record]:
        """All records of the member at `start`."""
        unpack, parts, at, begun = zlib.decompressobj(31), [], start, False
        while not unpack.eof:
            chunk = self.read(at, _CHUNK)
            if not chunk:
                raise Damaged("member cut off")
            try:
                parts.append(unpack.decompress(chunk))
            except zlib.error:
                raise Damaged("member") from None
            at += len(chunk)
            if not begun and sum(map(len, parts)) >= 5:
                begun = True
                if not b"".join(parts).startswith(b"WARC/"):
                    raise Damaged("member without version line")
        end = at - len(unpack.unused_data)
        data, place, out = b"".join(parts), 0, []
        try:
            while place < len(data) or not out:
                record, place = _record(data, place, start, end)
                out.append(record)
        except Damaged as fault:
            raise Damaged(fault.reason, end) from None
        return out

    def _plain(self, start: int) -> list[Record]:
        """The uncompressed record at `start`."""
        head = self.read(start, _CHUNK)
        if b"\r\n\r\n" not in head:
            head = self.read(start, _HEADERS)
        stop = head.find(b"\r\n\r\n")
        if stop < 0:
            raise Damaged("headers without end")
        length = _headers(head[:stop]).get("content-length", "")
        if not (length.isascii() and length.isdigit()):
            raise Damaged("headers")
        end = start + stop + 4 + int(length) + 4
        if end > self.size:
            raise Damaged("record cut off")
        return [_record(self.read(start, end - start), 0, start, end)[0]]

    def records_at(self, start: int) -> list[Record]:
        """The records that begin at `start`, all checks passed."""
        begin = self.read(start, _BEGIN_SIZE)
        if begin.startswith(_MEMBER):
            return self._member(start)
        if VERSION.match(begin):
            return self._plain(start)
        raise Damaged("no record begins here")

    def next_begin(self, start: int) -> int:
        """The first place from `start` on where a member or a version line may begin; the file's end if none."""
        at = start
        while at < self.size:
            data = self.read(at, _BLOCK)
            found = _BEGIN.search(data)
            if found:
                return at + found.start()
            if at + len(data) >= self.size:
                break
            at += len(data) - _BEGIN_SIZE + 1
        return self.size

    def __iter__(self) -> Iterator[Record | tuple[int, int, str]]:
        """Records, and (start, end, reason) of the gaps between them."""
        at, gap = 0, None
        while at < self.size:
            try:
                found = self.records_at(at)
            except Damaged as fault:
                gap = gap or (at, fault.reason)
                # a sound member is left whole; elsewhere the next record may begin inside
                at = fault.end if fault.end is not None else self.next_begin(at + 1)
                continue
            if gap:
                yield gap[0], at, gap[1]
                gap = None
            yield from found
            at = found[-1].end
        if gap:
            yield gap[0], self.size, gap[1]

    def close(self) -> None:
        self.file.close()


_FIELDS = pa.schema(
    [
        ("path", pa.string()),
        ("start", pa.int64()),
        ("end", pa.int64()),
        ("quarantined", pa.string()),
        ("record_type", pa.string()),
        ("record_id", pa.string()),
        ("refers_to", pa.string()),
        ("url", pa.string()),
        ("date", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload", pa.binary()),
    ]
)


def read_warc(files: DataFrame, path_col: str = "path", with_payload: bool = True) -> DataFrame:
    """One row per record and per quarantined gap of the files named in `files`.

    path, start and end say where a row's bytes lie; `quarantined` is the failed check of a gap and null for records.
    Records have record_type, record_id, refers_to, url, date, payload_bytes, payload_digest and payload, of which a
    revisit has the size and digest of the full payload and no bytes; payload is left out by with_payload=False. Gaps
    and records together cover every byte of a file. Records may share a member. Null paths and empty files give no row, a
    path named twice is read twice, a missing file is an error. Each file is read by one task as a stream.
    """
    names = [n for n in _FIELDS.names if with_payload or n != "payload"]
    schema = pa.schema([_FIELDS.field(n) for n in names])
    paths = files.select(F.col(path_col).cast("string").alias("path")).where("path is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                reader = SalvageReader(path)
                for item in reader:
                    if isinstance(item, tuple):
                        rows.append((path, *item, *[None] * (len(names) - 4)))
                        continue
                    head = item.headers
                    row = (
                        path, item.start, item.end, None, head["warc-type"], head.get("warc-record-id"),
                        head.get("warc-refers-to"), head.get("warc-target-uri"), head.get("warc-date"),
                        item.payload_bytes(), item.payload_digest(),
                    )
                    rows.append((*row, item.payload) if with_payload else row)
                    held += 500 + (len(item.payload) if with_payload else 0)
                    if held >= _FLUSH:
                        yield _batch(rows)
                        rows, held = [], 0
                reader.close()
        if rows:
            yield _batch(rows)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    kinds = {pa.string(): "string", pa.int64(): "long", pa.binary(): "binary"}
    spread = paths.repartition(max(1, paths.count()))  # one row per file
    return spread.mapInArrow(run, ", ".join(f"`{f.name}` {kinds[f.type]}" for f in schema))


def page_of(column: str) -> Column:
    """The page id in a record id that write_warc made; null for others."""
    return F.expr(f"try_cast(regexp_extract(`{column}`, '{_ID.pattern}', 1) AS long)")


def archive_pages(pages: DataFrame, folder: str, **options: object) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every page, read back from its archives."""
    records = read_warc(write_warc(pages, folder, **options), with_payload=False).where("quarantined is null")
    return records.select(
        page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page_of("refers_to").alias("refers_to")
    )
