"""WARC records in ZIP-packaged archives (operator 4).

Writing: every task packs its records into archives of bounded size. An archive
is a ZIP file whose members are stored, not compressed by ZIP:
``archive/data.warc.gz`` (one gzip member a record), ``indexes/index.cdxj`` (a
line for each record with its offset and length inside that member) and
``datapackage.json``. Sizes and offsets also go into ZIP64 fields, so archives
and members over 4 GiB read the same way. Names carry a random part; only
archives of successful tasks get into the manifest that Spark commits.

Reading: the end-of-central-directory record, its ZIP64 locator and record and
the central directory are parsed from the end of the file; stored members are
then read where they lie, by ranges: the index whole, records one at a time.
Nothing is extracted.

Duplicates: of records with equal payloads (SHA-256) of at least
``MIN_REVISIT`` bytes, those with the smallest page id are responses and the
others revisit it. The smallest id of each digest comes from a pre-aggregated
sum over the pages' digests; no group of copies is ever gathered.

Edge cases: a null payload is empty. A null URL is left out of the record.
Pages with a null id are responses unless a page with an id holds the same
payload. Repeated rows of the smallest id are all responses. An empty table
makes no archive and gives no rows. A very long payload is one record, written and read
whole; ZIP64 lengths leave it no limit.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostelry.llm import files
from hostelry.llm.common import materialize, only, partitions, scratch, text_chunks

MIN_REVISIT = 100
#: An archive is closed once its records take this many bytes.
ARCHIVE_BYTES = 64 << 20
#: Bytes at the end of a file in which the end record is looked for: its length and the longest comment.
_TAIL = 22 + 0xFFFF
#: Fixed values of the ZIP format: signatures and the mark for "see the ZIP64 field".
LOCAL, CENTRAL, END, END64, LOCATOR64, SEE64 = 0x04034B50, 0x02014B50, 0x06054B50, 0x06064B50, 0x07064B50, 0xFFFFFFFF
WARC_DATE = "1970-01-01T00:00:00Z"


# --- WARC records

def warc_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record: a response with the payload behind HTTP headers, or a
    revisit with the HTTP headers alone."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    name = "null" if page_id is None else str(page_id)
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:page:{name}>"), ("WARC-Date", WARC_DATE),
            ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    if url is not None:
        head.append(("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=%~")))
    if revisit:
        head += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of an uncompressed record."""
    def headers(lines: list[bytes]) -> dict[str, str]:
        return {k.decode().lower(): v.strip().decode() for k, _, v in (x.partition(b":") for x in lines)}
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not version.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    fields = headers(lines)
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, headers(http.split(b"\r\n")[1:]), payload


def _page(urn: str) -> int | None:
    name = urn.removeprefix("<urn:page:").removesuffix(">")
    return None if name == "null" else int(name)


# --- ZIP packages

class ZipPackage:
    """Writes stored members one after the other. Sizes are known only once a
    member has been written, so they follow it in a ZIP64 data descriptor and
    stand in the central directory."""

    def __init__(self, f):
        self.f, self.at, self.done = f, 0, []

    def _put(self, data: bytes) -> None:
        self.f.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        self.name, self.start, self.crc, self.size = name.encode(), self.at, 0, 0
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        self._put(struct.pack("<IHHHHHIIIHH", LOCAL, 45, 0x0808, 0, 0, 0x21, 0, SEE64, SEE64, len(self.name), len(extra)) + self.name + extra)

    def write(self, data: bytes) -> int:
        """Append to the member; returns the offset inside it."""
        at = self.size
        self.crc, self.size = zlib.crc32(data, self.crc), self.size + len(data)
        self._put(data)
        return at

    def end(self) -> None:
        self._put(struct.pack("<IIQQ", 0x08074B50, self.crc, self.size, self.size))
        self.done.append((self.name, self.crc, self.size, self.start))

    def close(self) -> None:
        start = self.at
        for name, crc, size, offset in self.done:
            extra = struct.pack("<HHQQQ", 1, 24, size, size, offset)
            self._put(struct.pack("<IHHHHHHIIIHHHHHII", CENTRAL, 45, 45, 0x0808, 0, 0, 0x21, crc, SEE64, SEE64,
                                  len(name), len(extra), 0, 0, 0, 0, SEE64) + name + extra)
        size, n, end64 = self.at - start, len(self.done), self.at
        self._put(struct.pack("<IQHHIIQQQQ", END64, 44, 45, 45, 0, 0, n, n, size, start))
        self._put(struct.pack("<IIQI", LOCATOR64, 0, end64, 1))
        self._put(struct.pack("<IHHHHIIH", END, 0, 0, 0xFFFF, 0xFFFF, SEE64, SEE64, 0))
        self.f.close()


def zip_members(f, size: int) -> dict[str, tuple[int, int]]:
    """name -> (offset of the data, length) of the stored members, from the
    central directory, ZIP64 or not."""
    tail_at = max(0, size - _TAIL)
    tail = files.read_range(f, tail_at, size - tail_at)
    at = tail.rfind(struct.pack("<I", END))
    if at < 0:
        raise ValueError("no end of central directory")
    n, length, start = struct.unpack_from("<HII", tail, at + 10)
    if SEE64 in (length, start) or n == 0xFFFF:
        locator = files.read_range(f, tail_at + at - 20, 20)
        mark, _, end64, _ = struct.unpack("<IIQI", locator)
        if mark != LOCATOR64:
            raise ValueError("no ZIP64 locator")
        mark, *_, n, length, start = struct.unpack("<IQHHIIQQQQ", files.read_range(f, end64, 56))
        if mark != END64:
            raise ValueError("no ZIP64 end of central directory")
    directory, at, out = files.read_range(f, start, length), 0, {}
    for _ in range(n):
        mark, _, _, _, method, _, _, _, packed, plain, name_n, extra_n, note_n, _, _, _, offset = struct.unpack_from("<IHHHHHHIIIHHHHHII", directory, at)
        if mark != CENTRAL:
            raise ValueError("broken central directory")
        name = directory[at + 46:at + 46 + name_n].decode()
        extra = directory[at + 46 + name_n:at + 46 + name_n + extra_n]
        while len(extra) >= 4:
            kind, k = struct.unpack_from("<HH", extra)
            if kind == 1:  # the fields that read SEE64 follow in this order
                wide = list(struct.unpack(f"<{k // 8}Q", extra[4:4 + k // 8 * 8]))
                plain = wide.pop(0) if plain == SEE64 else plain
                packed = wide.pop(0) if packed == SEE64 else packed
                offset = wide.pop(0) if offset == SEE64 else offset
            extra = extra[4 + k:]
        if method != 0:
            raise ValueError(f"{name} is not stored")
        mark, name_here, extra_here = struct.unpack("<I22xHH", files.read_range(f, offset, 30))
        if mark != LOCAL:
            raise ValueError("broken local header")
        out[name] = (offset + 30 + name_here + extra_here, plain)
        at += 46 + name_n + extra_n + note_n
    return out


class ArchiveWriter:
    """One package of WARC records."""

    def __init__(self, uri: str):
        self.uri, self.zip, self.index, self.n = uri, ZipPackage(files.create(uri)), io.BytesIO(), 0
        self.zip.begin("archive/data.warc.gz")

    def add(self, record: bytes, entry: dict) -> None:
        packed = gzip.compress(record, compresslevel=1, mtime=0)
        at = self.zip.write(packed)
        self.index.write(json.dumps(entry | {"offset": at, "length": len(packed)}, separators=(",", ":")).encode() + b"\n")
        self.n += 1

    def close(self) -> None:
        self.zip.end()
        self.zip.begin("indexes/index.cdxj")
        self.zip.write(self.index.getvalue())
        self.zip.end()
        self.zip.begin("datapackage.json")
        self.zip.write(json.dumps({"profile": "data-package", "resources": [{"path": "archive/data.warc.gz", "records": self.n}, {"path": "indexes/index.cdxj"}]}).encode())
        self.zip.end()
        self.zip.close()


def read_archive(uri: str) -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
    """Every record of an archive, range by range in the order of its index."""
    size = files.size(uri)
    with files.open_ranged(uri) as f:
        members = zip_members(f, size)
        start, _ = members["archive/data.warc.gz"]
        at, length = members["indexes/index.cdxj"]
        for line in files.read_range(f, at, length).splitlines():
            entry = json.loads(line)
            yield parse_record(gzip.decompress(files.read_range(f, start + entry["offset"], entry["length"])))


# --- Spark jobs

def revisits(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, digest, refers_to): refers_to is null for responses."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    digested = pages.withColumn("digest", F.sha2(payload, 256))
    long = F.octet_length(payload) >= MIN_REVISIT
    first = digested.filter(long).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    first = first.filter("copies > 1 and first is not null").select("digest", "first")
    return (digested.join(first, "digest", "left")
            .withColumn("refers_to", F.when(F.col("first").eqNullSafe(F.col("page_id")), None).otherwise(F.col("first"))).drop("first"))


def write_warc(pages: DataFrame, folder: str) -> DataFrame:
    """Write archives below ``folder``; returns the manifest (uri, n_records)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, done = None, []
        for part, raw in text_chunks(batches, "html"):
            for page_id, url, payload, digest, refers_to in zip(
                    part.column(0).to_pylist(), part.column(1).to_pylist(), raw, part.column(3).to_pylist(), part.column(4).to_pylist(), strict=True):
                if writer is None:
                    writer = ArchiveWriter(f"{folder}/{uuid.uuid4().hex}.wacz")
                entry = {"url": url, "digest": f"sha256:{digest}", "type": "response" if refers_to is None else "revisit"}
                writer.add(warc_record(page_id, url, payload, digest, refers_to), entry)
                if writer.zip.size >= ARCHIVE_BYTES:
                    writer.close()
                    done.append(writer)
                    writer = None
        if writer is not None:
            writer.close()
            done.append(writer)
        yield pa.RecordBatch.from_arrays([pa.array([w.uri for w in done], pa.string()), pa.array([w.n for w in done], pa.int64())], ["uri", "n_records"])
    rows = revisits(only(pages, "page_id", "url", "html")).select("page_id", "url", "html", "digest", "refers_to")
    return materialize(rows.mapInArrow(run, "uri string, n_records long"), "warc-manifest")


def read_warc(manifest: DataFrame) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) of
    every record. The payload of a response is hashed anew; one whose digest
    differs from its header is an error."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                              ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"])
        for b in batches:
            for uri in b.column(0).to_pylist():
                rows = []
                for head, http, payload in read_archive(uri):
                    kind, digest = head["warc-type"], head["warc-payload-digest"].removeprefix("sha256:")
                    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"{uri}: payload of {head['warc-record-id']} does not match its digest")
                    refers_to = head.get("warc-refers-to")
                    rows.append((_page(head["warc-record-id"]), head.get("warc-target-uri"), int(http["content-length"]), digest, kind, refers_to and _page(refers_to)))
                    if len(rows) == 10_000:
                        yield batch(rows)
                        rows = []
                yield batch(rows)
    # a number given keeps these small rows, each a whole archive of work, in partitions of their own
    return manifest.select("uri").repartition(partitions(manifest.sparkSession), "uri").mapInArrow(
        run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long")


def warc_round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read them back."""
    return read_warc(write_warc(pages, scratch(pages.sparkSession, "warc")))
