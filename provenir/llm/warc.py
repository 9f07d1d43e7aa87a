"""WARC archives: a writer, and a sequential reader that never holds more than one record."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import shared_dir
from .common import staged

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END, CHUNK = b"\r\n\r\n", 1 << 16


class WarcError(ValueError):
    """A record that is cut off, misframed or whose digest does not match."""


def digest(data: bytes) -> str:
    """Base32 of SHA-1, upper case, without a prefix."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(headers: dict[str, str], block: bytes) -> bytes:
    """One gzip member that holds one WARC/1.1 record."""
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers.items() if v is not None)
    head = f"WARC/1.1\r\n{lines}WARC-Block-Digest: sha1:{digest(block)}\r\nContent-Length: {len(block)}\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + END) + packer.flush()


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes

    @property
    def http(self) -> tuple[dict[str, str], bytes]:
        """HTTP header fields (lower-case names) and payload of an HTTP block; of any other block, nothing and the block."""
        if not self.block.startswith(b"HTTP/"):
            return {}, self.block
        head, _, payload = self.block.partition(END)
        return _fields(head.split(b"\r\n")[1:]), payload

    def holds(self, claim: str) -> bool:
        """Whether the payload has the digest claimed, as it stands or with its chunks put together."""
        name = claim.partition(":")[0].lower()
        fields, payload = self.http
        if name not in DIGESTS or _agrees(claim, hashlib.new(name, payload, usedforsecurity=False).digest()):
            return True
        whole = _unchunked(payload) if fields.get("transfer-encoding", "").lower() == "chunked" else None
        return whole is not None and _agrees(claim, hashlib.new(name, whole, usedforsecurity=False).digest())


def _fields(lines: list[bytes]) -> dict[str, str]:
    pairs = (line.decode("utf-8", "replace").partition(":") for line in lines if line)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


#: Bytes that a header may have before its end is given up, and that are inflated at once.
LONGEST_HEADER = 1 << 20


class _Framing:
    """Cuts plain bytes into records by their Content-Length, as they come; hashes blocks on the way."""

    def __init__(self, largest: int):
        self._largest, self._held, self._headers = largest, bytearray(), None

    @property
    def between(self) -> bool:
        return self._headers is None and not self._held

    def feed(self, data: bytes) -> Iterator[Record]:
        while data or self._complete():
            if self._headers is None:
                data = self._header(data)
            else:
                room = self._length + len(END) - len(self._held)
                part, data = data[:room], data[room:]
                self._hash.update(part[: max(0, self._length - len(self._held))])
                self._held += part
            if self._complete():
                yield self._record()

    def _complete(self) -> bool:
        return self._headers is not None and len(self._held) == self._length + len(END)

    def _header(self, data: bytes) -> bytes:
        looked = max(0, len(self._held) - len(END) + 1)
        self._held += data
        at = self._held.find(END, looked)
        if not self._held[:5] == b"WARC/"[: len(self._held)]:
            raise WarcError("no WARC header")
        if at < 0:
            if len(self._held) > LONGEST_HEADER:
                raise WarcError("a header without an end")
            return b""
        version, *lines = bytes(self._held[:at]).split(b"\r\n")
        rest = bytes(self._held[at + len(END) :])
        headers = _fields(lines)
        try:
            self._length = int(headers["content-length"])
        except (KeyError, ValueError) as e:
            raise WarcError("no content length") from e
        if not 0 <= self._length <= self._largest:
            raise WarcError(f"a block of {self._length} bytes; {self._largest} are the most that is taken")
        self._headers, self._held = headers, bytearray()
        name = (headers.get("warc-block-digest") or "").partition(":")[0].lower()
        self._hash = hashlib.new(name if name in DIGESTS else "sha1", usedforsecurity=False)
        return rest

    def _record(self) -> Record:
        block, tail = bytes(self._held[: self._length]), bytes(self._held[self._length :])
        headers, self._headers, self._held = self._headers, None, bytearray()
        if tail != END:
            raise WarcError("the block does not end where its length says")
        found = Record(headers, block)
        if not _agrees(headers.get("warc-block-digest"), self._hash.digest()):
            raise WarcError("a block digest differs")
        claim = headers.get("warc-payload-digest")
        if claim and headers.get("warc-type") in ("response", "resource") and "warc-truncated" not in headers and not found.holds(claim):
            raise WarcError("a payload digest differs")
        return found


#: Digests that are verified; others are taken as they are.
DIGESTS = {"md5", "sha1", "sha256", "sha512"}


def _agrees(claim: str | None, found: bytes) -> bool:
    """Whether a claim `name:value` (base32 or hexadecimal) is what was found; unknown names and no claim are."""
    name, _, value = (claim or "").partition(":")
    if name.lower() not in DIGESTS:
        return True
    return value.lower() == found.hex() or value.upper().rstrip("=") == base64.b32encode(found).decode().rstrip("=")


def _unchunked(data: bytes) -> bytes | None:
    """A chunked HTTP body put together; None if it is none."""
    out, at = [], 0
    while True:
        end = data.find(b"\r\n", at)
        try:
            size = int(data[at:end].split(b";")[0], 16) if end > at else -1
        except ValueError:
            size = -1
        if size < 0:
            return None
        if size == 0:
            return b"".join(out)
        out.append(data[end + 2 : end + 2 + size])
        at = end + 2 + size + 2


def read_records(chunks: Iterable[bytes], largest: int = 1 << 31) -> Iterator[Record]:
    """Records of an archive given as successive chunks of its bytes, in order.

    Gzip members are inflated 64 KB at a time and framed by Content-Length as they come; a member may hold one record or
    many, and an archive that is not compressed is read as well. Never more than a record is held, and none
    of more than `largest` bytes. Raises WarcError for members that end inside a record, bytes that are not framed by the
    length, and block or payload digests that differ. No bytes are no record.
    """
    member, framing, plain = None, _Framing(largest), None
    for chunk in chunks:
        if plain is None and chunk:
            plain = chunk[:1] == b"W"
        if plain:
            yield from framing.feed(chunk)
            continue
        while chunk:
            member = member or zlib.decompressobj(31)
            try:
                data = member.decompress(chunk, CHUNK)
                while data:
                    yield from framing.feed(data)
                    data = member.decompress(member.unconsumed_tail, CHUNK) if not member.eof else b""
            except zlib.error as e:
                raise WarcError(f"not a gzip member: {e}") from e
            chunk = b""
            if member.eof:
                if not framing.between:
                    raise WarcError("a member ends inside a record")
                chunk, member = member.unused_data, None
    if member is not None or not framing.between:
        raise WarcError("the archive ends inside a record")


OWN_NAME = re.compile(r"<urn:page:(-?\d*)>")


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_id(name: str | None) -> int | None:
    """The page that one of our own names stands for; None for names of others."""
    found = OWN_NAME.fullmatch(name or "")
    return int(found[1]) if found and found[1] else None


def page_record(page_id: int | None, url: str | None, payload: bytes, original: int | None, is_revisit: bool, date: str, size: int | None = None, sha1: bytes | None = None) -> bytes:
    """A response with its payload, or a revisit that names the page whose response holds it.

    A revisit needs no payload if the `size` and `sha1` of it are given.
    """
    size = len(payload) if size is None else size
    said = base64.b32encode(sha1).decode() if sha1 else digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    headers = {
        "WARC-Type": "revisit" if is_revisit else "response",
        "WARC-Record-ID": _name(page_id),
        "WARC-Date": date,
        "WARC-Target-URI": " ".join((url or "").split()) or None,
        "WARC-Payload-Digest": f"sha1:{said}",
        "Content-Type": "application/http; msgtype=response",
        "WARC-Profile": PROFILE if is_revisit else None,
        "WARC-Refers-To": _name(original) if is_revisit else None,
    }
    return record(headers, http if is_revisit else http + payload)


def _place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it; one without a scheme is on the (shared) local file system."""
    return fs.FileSystem.from_uri(path) if re.match(r"[a-z][a-z0-9+.-]*:/", path) else (fs.LocalFileSystem(), path)


class _Archive:
    """One .warc.gz file: written aside as records come, and put in its place when it is whole."""

    def __init__(self, folder: str, date: str):
        self.path = f"{folder}/pages-{uuid.uuid4().hex}.warc.gz"
        self._store, self._at = _place(self.path)
        self._out = self._store.open_output_stream(f"{self._at}.part", compression=None)
        self.records, self.bytes = 0, 0
        name = self.path.rpartition("/")[2]
        self.add(record({"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>", "WARC-Date": date, "WARC-Filename": name, "Content-Type": "application/warc-fields"}, b"software: provenir\r\nformat: WARC File Format 1.1\r\n"))

    def add(self, data: bytes) -> None:
        self._out.write(data)
        self.records += 1
        self.bytes += len(data)

    def close(self) -> pa.RecordBatch:
        self._out.close()
        self._store.move(f"{self._at}.part", self._at)
        return pa.RecordBatch.from_arrays([pa.array([self.path]), pa.array([self.records], pa.int64()), pa.array([self.bytes], pa.int64())], names=["path", "records", "bytes"])


def _written(folder: str, date: str, archive_bytes: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = None
        for batch in batches:
            columns = (batch.column(n).to_pylist() for n in ("page_id", "url", "original", "is_revisit", "bytes", "key"))
            for page_id, url, original, again, size, key, payload in zip(*columns, batch.column("payload")):
                archive = archive or _Archive(folder, date)
                archive.add(page_record(page_id, url, payload.as_py() or b"", original, again, date, size, bytes.fromhex(key)))
                if archive.bytes >= archive_bytes:
                    yield archive.close()
                    archive = None
        if archive:
            yield archive.close()

    return run


#: Over how many places the pages of one payload are dealt.
SALTS = 8


def write_archives(pages: DataFrame, folder: str | None = None, date: str = "2024-01-01T00:00:00Z", archive_bytes: int = 16 << 20, least_bytes: int = 0) -> DataFrame:
    """Writes .warc.gz files of about `archive_bytes` with a record per page below `folder`; returns path, records and bytes of each.

    `pages` has page_id, url and html. Of pages with equal payloads of `least_bytes` or more, that with the largest
    page_id becomes a response and the others revisit it. A null html is an empty payload; a null url leaves the
    target out; a null page_id sorts first and is kept as such; rows that share page_id and payload are all responses if
    their page_id is the largest. A very long page is a record like any other. Other columns are ignored, whatever their
    names; an empty table gives no archive.

    A file is written aside and renamed when it is whole, and only files that the result names count, so tasks that are
    lost or run twice leave nothing that is read. `folder` (by default one of its own in the shared folder) must be one that
    pyarrow's file systems reach from the executors. Payloads are dealt out by page, never by what they hold; which page
    a payload is kept by is found from hashes alone.
    """
    spark = pages.sparkSession
    folder = folder or f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    store, at = _place(folder)
    store.create_dir(at, recursive=True)
    rows = pages.select("page_id", "url", F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    keyed = rows.withColumn("key", F.sha1("payload")).withColumn("bytes", F.octet_length("payload").cast("long"))
    thin = keyed.filter(F.col("bytes") >= least_bytes).select("page_id", "key", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int").alias("_salt"))
    shared = thin.groupBy("key").agg(F.max("page_id").alias("original"), F.count("*").alias("_n")).filter("_n > 1")
    dealt = shared.select("key", "original", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    again = thin.join(dealt, ["key", "_salt"]).filter(~F.col("page_id").eqNullSafe(F.col("original"))).select("page_id", "key", "original").distinct()
    one = F.coalesce("page_id", F.xxhash64("key"))
    told = again.select(one.alias("_one"), F.col("page_id").isNull().alias("_none"), F.col("key").alias("_key"), "original", F.lit(True).alias("_again"))
    same = (F.col("_at") == F.col("_one")) & (F.col("page_id").isNull() == F.col("_none")) & (F.col("key") == F.col("_key"))
    joined = keyed.withColumn("_at", one).join(told, same, "left")
    is_revisit = F.coalesce("_again", F.lit(False))
    ready = joined.select("page_id", "url", F.when(~is_revisit, F.col("payload")).alias("payload"), "original", is_revisit.alias("is_revisit"), "bytes", "key")
    return staged(ready.mapInArrow(_written(folder, date, archive_bytes), "path string, records long, bytes long"), "archives")


_ROW = "page_id long, record_id string, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, refers_to_id string, payload binary"
_KINDS = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
_NAMES = [c.split()[0] for c in _ROW.split(", ")]


def _row(found: Record) -> tuple:
    h = found.headers
    kind = h.get("warc-type")
    http, payload = found.http
    again = kind == "revisit"
    size = (int(http["content-length"]) if http.get("content-length", "").isdigit() else None) if again else len(payload)
    claim = h.get("warc-payload-digest", "").partition(":")[2] or (None if again else digest(payload))
    other = h.get("warc-refers-to")
    return _page_id(h.get("warc-record-id")), h.get("warc-record-id"), h.get("warc-target-uri"), kind, claim, size, _page_id(other), other, None if again else payload


def _chunks_of(path: str) -> Iterator[bytes]:
    store, at = _place(path)
    with store.open_input_stream(at, compression=None) as source:
        while chunk := source.read(CHUNK):
            yield chunk


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for archive in batch.column(0):
            if pa.types.is_string(archive.type):
                chunks = _chunks_of(archive.as_py())
            else:
                view = memoryview(archive.as_buffer())
                chunks = (bytes(view[i : i + CHUNK]) for i in range(0, len(view), CHUNK))
            rows: list[tuple] = []
            held = 0
            for found in read_records(chunks):
                rows.append(_row(found))
                held += len(found.block)
                if len(rows) >= 256 or held >= 1 << 24:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _KINDS)], names=_NAMES)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _KINDS)], names=_NAMES)


def read_archives(archives: DataFrame) -> DataFrame:
    """The records of `archives`, each read sequentially: `path` (string: WARC files, compressed or not, that pyarrow's file
    systems reach) or else `content` (binary: the bytes of such files, as binaryFile reads them).

    Returns per record of any type: page_id and refers_to (of records that `write_archives` made, else null), record_id and
    refers_to_id (as they stand), url, record_type, payload_digest (as claimed, else computed; bare), payload_bytes (of the full
    payload, for revisits too where they tell it) and payload (null for revisits; the block of records that hold no HTTP).
    Archives are spread over tasks, one archive a task at a time; damage raises WarcError (`read_records`).
    """
    if "path" in archives.columns:
        listed = archives.select("path")
        return listed.repartition(max(1, min(10_000, listed.count()))).mapInArrow(_read, _ROW)
    return archives.select("content").mapInArrow(_read, _ROW)


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Writes the archives of `pages` to the shared folder and reads the pages back from the files."""
    return read_archives(write_archives(pages, **options)).filter(F.col("record_type").isin("response", "revisit"))
