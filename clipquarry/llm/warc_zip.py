"""WARC records in ZIP packages, read by ranges.

A package holds *stored* (uncompressed) members, so that a byte of a member is a byte of the package: archives below
``archive/`` of gzip members, one per record, and indexes below ``indexes/`` (plain or gzip'd), one line per record with
archive, offset and length. The writer makes one of each; the reader takes any number, and other members, compressed or
not, are left alone. The writer streams; sizes follow the data in data descriptors, and the
central directory uses ZIP64 fields where a number needs them. The reader takes the end record (or its
ZIP64 form), the central directory, the local header of the index, and then ranges of the archive; no member is
ever extracted.

Equal payloads: the digests are grouped (map-side first) and only groups with more than one record are joined
back, so that a payload with a third of all records is a skewed join key that AQE splits, never a group in
one task."""

from __future__ import annotations

import gzip
import hashlib
import json
import re
import struct
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipquarry.llm.common import spread, store
from clipquarry.llm.files import create, open_file, read_range
from clipquarry.session import scratch_path

ARCHIVES, INDEXES = "archive/", "indexes/"
ARCHIVE, LISTING = f"{ARCHIVES}data.warc.gz", f"{INDEXES}index.cdxj"
LEAST_BYTES = 100  # of payloads that may be revisited
PACKAGE_BYTES = 256 << 20
# Fixed values of the formats.
END, END64, LOCATOR64, CENTRAL, LOCAL, DESCRIPTOR = (
    b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04", b"PK\x07\x08",
)
MAX16, MAX32 = 0xFFFF, 0xFFFFFFFF
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = datetime(2000, 1, 1, tzinfo=timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


class PackageWriter:
    """Streams stored members into a ZIP; every size and offset is written as ZIP64 where ``zip64`` says so or
    32 bits do not hold it."""

    def __init__(self, out, zip64: bool = False) -> None:
        self.out, self.at, self.members, self.zip64 = out, 0, [], zip64

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        raw = name.encode()
        self.members.append([raw, self.at, 0, 0])
        # flag bits: sizes follow the data, names are UTF-8; the ZIP64 field makes the sizes that follow 64-bit
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        self._put(LOCAL + struct.pack("<HHHHHIIIHH", 45, 0x808, 0, 0, 33, 0, MAX32, MAX32, len(raw), len(extra)) + raw + extra)

    def add(self, data: bytes) -> None:
        member = self.members[-1]
        member[2], member[3] = zlib.crc32(data, member[2]), member[3] + len(data)
        self._put(data)

    def end(self) -> None:
        _, _, crc, size = self.members[-1]
        self._put(DESCRIPTOR + struct.pack("<IQQ", crc, size, size))

    def close(self) -> None:
        start = self.at
        for raw, offset, crc, size in self.members:
            big = lambda n: self.zip64 or n >= MAX32
            wide = [n for n in (size, size, offset) if big(n)]
            extra = struct.pack(f"<HH{len(wide)}Q", 1, 8 * len(wide), *wide) if wide else b""
            low = [MAX32 if big(n) else n for n in (size, size, offset)]
            self._put(
                CENTRAL
                + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 0x808, 0, 0, 33, crc, low[0], low[1], len(raw), len(extra), 0, 0, 0, 0, low[2])
                + raw + extra
            )
        size, n = self.at - start, len(self.members)
        if self.zip64 or start >= MAX32 or size >= MAX32 or n >= MAX16:
            end64 = self.at
            self._put(END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, n, n, size, start))
            self._put(LOCATOR64 + struct.pack("<IQI", 0, end64, 1))
            n, size, start = MAX16, MAX32, MAX32
        self._put(END + struct.pack("<HHHHIIH", 0, 0, n, n, size, start, 0))


def directory(file: pa.NativeFile, below: tuple[str, ...] = ("",)) -> dict[str, tuple[int, int, int]]:
    """Of each member whose name begins with one of ``below``, which has to be a stored one, its first byte in the package, its
    size and its CRC, from the end record, its ZIP64 form where there is one, the central directory and the local
    headers."""
    total = file.size()
    tail_at = max(0, total - 22 - MAX16)
    tail = read_range(file, tail_at, total - tail_at)
    at = tail.rfind(END)
    while at >= 0 and (len(tail) < at + 22 or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("no end record: not a ZIP package, or a cut one")
    n, size, start = struct.unpack_from("<HII", tail, at + 10)
    if MAX16 == n or MAX32 in (size, start):
        if at < 20 or tail[at - 20:at - 16] != LOCATOR64:
            raise ValueError("no ZIP64 locator before the end record")
        (end64,) = struct.unpack_from("<Q", tail, at - 12)
        record = read_range(file, end64, 56)
        if record[:4] != END64:
            raise ValueError("no ZIP64 end record where its locator says")
        n, size, start = struct.unpack_from("<QQQ", record, 32)
    listing, at, members = read_range(file, start, size), 0, {}
    for _ in range(n):
        if listing[at:at + 4] != CENTRAL:
            raise ValueError("the central directory ends early")
        method, = struct.unpack_from("<H", listing, at + 10)
        crc, packed, plain, names, extras, comments = struct.unpack_from("<IIIHHH", listing, at + 16)
        (offset,) = struct.unpack_from("<I", listing, at + 42)
        name = listing[at + 46:at + 46 + names].decode()
        extra, at = listing[at + 46 + names:at + 46 + names + extras], at + 46 + names + extras + comments
        while len(extra) >= 4:
            kind, length = struct.unpack_from("<HH", extra)
            if kind == 1:
                wide = iter(struct.unpack_from(f"<{length // 8}Q", extra, 4))
                plain = next(wide) if plain == MAX32 else plain
                packed = next(wide) if packed == MAX32 else packed
                offset = next(wide) if offset == MAX32 else offset
            extra = extra[4 + length:]
        if not name.startswith(below) or name.endswith("/"):
            continue
        if method:
            raise ValueError(f"{name} is compressed; only stored members can be read by ranges")
        header = read_range(file, offset, 30)
        if header[:4] != LOCAL:
            raise ValueError(f"no local header of {name} where the directory says")
        own, more = struct.unpack_from("<HH", header, 26)
        members[name] = (offset + 30 + own + more, packed, crc)
    return members


def _record(kind: str, page: int | None, url: str | None, digest: str, payload: bytes, size: int, refers: int | None) -> bytes:
    """One record as a gzip member. A revisit keeps the HTTP headers, whose Content-Length is the full payload's."""
    name = lambda p: f"urn:page:{'' if p is None else p}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    target = "" if url is None else "".join(c if " " < c < "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)
    block = http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{name(page)}>", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha256:{digest}",
        *([f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: <{name(refers)}>"] if kind == "revisit" else []),
        "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}",
    ]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 1, mtime=0)


def parse_record(data: bytes) -> dict:
    """The fields of one gzip'd record: ``type``, ``page_id``, ``url``, ``digest``, ``refers_to``, ``length`` and
    ``payload`` (empty for a revisit)."""
    head, _, rest = zlib.decompress(data, 31).partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError("not a WARC record")
    fields = dict(x.split(":", 1) for x in lines[1:])
    fields = {k.lower(): v.strip() for k, v in fields.items()}
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    sizes = (int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    number = lambda x: int(n) if re.fullmatch("-?[0-9]+", n := x.strip("<>").rpartition(":")[2]) else None
    return {
        "type": fields["warc-type"], "page_id": number(fields["warc-record-id"]), "url": fields.get("warc-target-uri"),
        "digest": fields.get("warc-payload-digest"), "length": next(sizes, len(payload)), "payload": payload,
        "refers_to": number(fields["warc-refers-to"]) if "warc-refers-to" in fields else None,
    }


def write_packages(
    pages: DataFrame,
    *,
    folder: str | None = None,
    least_bytes: int = LEAST_BYTES,
    package_bytes: int = PACKAGE_BYTES,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """Writes a record per row and returns the manifest: ``package``, ``records``. Of equal payloads of at least
    ``least_bytes`` bytes the record with the smallest id is the response, others revisit it; a repeated
    smallest id has a response for each of its rows, and where all ids are null all are responses. Null
    HTML is an empty payload, null urls are empty. Other columns are not read."""
    folder = folder or scratch_path(pages.sparkSession, "packages")
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.encode(F.coalesce(F.col(html), F.lit("")), "utf-8").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    groups = (
        rows.where(F.length("payload") >= least_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select(F.col("digest").alias("_digest"), "first")
    )
    joined = rows.join(store(groups, "equal_payloads"), F.col("digest") == F.col("_digest"), "left").drop("_digest")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package, name, listing, offset = None, None, [], 0

        def close() -> pa.RecordBatch:
            package.end()
            package.begin(LISTING)
            for line in listing:
                package.add(line)
            package.end()
            package.close()
            package.out.close()
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(listing)])], ["package", "records"])

        for batch in batches:
            for page, link, payload, digest, first in zip(*(c.to_pylist() for c in batch.columns)):
                if package is None:
                    name, out = create(folder, ".zip")
                    package, listing, offset = PackageWriter(out), [], 0
                    package.begin(ARCHIVE)
                again = first is not None and page != first
                record = _record(
                    "revisit" if again else "response", page, link, digest,
                    b"" if again else payload, len(payload), first if again else None,
                )
                package.add(record)
                line = {"url": link, "digest": f"sha256:{digest}", "filename": ARCHIVE.split("/")[1], "offset": offset, "length": len(record)}
                listing.append(f"{'' if page is None else page} {DATE} {json.dumps(line)}\n".encode())
                offset += len(record)
                if offset >= package_bytes:
                    yield close()
                    package = None
        if package is not None:
            yield close()

    ready = joined.select("page_id", "url", "payload", "digest", "first")
    return store(ready.mapInArrow(write, "package string, records long"), "packages")


def read_index(file: pa.NativeFile) -> list[dict]:
    """The lines of all of a package's indexes, each with its ``archive``, in the order of archive and offset."""
    lines = []
    for name, (start, size, crc) in sorted(directory(file, (INDEXES,)).items()):
        data = read_range(file, start, size)
        if zlib.crc32(data) != crc:
            raise ValueError(f"{name} is damaged")
        data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
        for x in filter(None, data.split(b"\n")):
            line = json.loads(x.split(b" ", 2)[2])
            archive = ARCHIVES + line["filename"] if "filename" in line else ARCHIVE
            lines.append(line | {"archive": archive, "offset": int(line["offset"]), "length": int(line["length"])})
    return sorted(lines, key=lambda line: (line["archive"], line["offset"]))


def read_packages(manifest: DataFrame, *, step_bytes: int = 8 << 20) -> DataFrame:
    """One row per record: ``page_id``, ``url``, ``record_type``, ``refers_to``, ``payload_digest``,
    ``payload_bytes`` (both of the full payload, for revisits too) and ``payload`` (null for revisits). Neighbouring records are
    read in ranges of about ``step_bytes``. A SHA-256 of a response is computed anew and compared; records of other writers
    that give none get it. Their ids are null where they do not end in a number. All records of all archives that an
    index names are read; an index that names a missing archive is an error."""
    names = ["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def ranges(lines: list[dict]) -> Iterator[list[dict]]:
        held, size = [], 0
        for line in lines:
            if held and (line["archive"] != held[-1]["archive"] or line["offset"] != held[-1]["offset"] + held[-1]["length"]):
                yield held
                held, size = [], 0
            held.append(line)
            size += line["length"]
            if size >= step_bytes:
                yield held
                held, size = [], 0
        if held:
            yield held

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                with open_file(uri) as file:
                    archives, lines = directory(file, (ARCHIVES,)), read_index(file)
                    for part in ranges(lines):
                        if part[0]["archive"] not in archives:
                            raise ValueError(f"{uri}: the index names {part[0]['archive']}, which is not in the package")
                        start = archives[part[0]["archive"]][0]
                        first, last = part[0]["offset"], part[-1]["offset"] + part[-1]["length"]
                        data, rows = read_range(file, start + first, last - first), []
                        for line in part:
                            at = line["offset"] - first
                            r = parse_record(data[at:at + line["length"]])
                            again, own = r["type"] == "revisit", hashlib.sha256(r["payload"]).hexdigest()
                            kind, _, digest = (r["digest"] or "").partition(":")
                            if kind == "sha256" and not again and own != digest:
                                raise ValueError(f"{uri}: the payload of page {r['page_id']} is damaged")
                            if kind != "sha256":  # of another kind, or none: that of a revisit is not known
                                digest = None if again else own
                            rows.append((
                                r["page_id"], line.get("url"), r["type"], r["refers_to"], digest, r["length"],
                                None if again else r["payload"],
                            ))
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    schema = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"
    return spread(manifest.select("package"), "package").mapInArrow(read, schema)
