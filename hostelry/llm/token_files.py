"""Token-id files (operator 10): frequency-ranked ids in a byte-aligned
variable-length code with separate control bytes, decoded by table lookup.

Ids are counted over the whole corpus and replaced by their rank, so the 256
most frequent take one byte and most others two. A file holds blocks; a block
is the control bytes (2 bits a value: its length in bytes less one, four values
a byte, the first in the lowest bits), then the data bytes, little-endian. A
decoder looks the four lengths up in a 256-row table and gathers all values of
a block at once.

File layout, little-endian: blocks; then the trailer: rank table (uint32 id of
each rank), per document its key (int64), a byte that is 1 if the key is null,
its number of ids (int64); per block its offset, values and data bytes (int64
each); then the tail: counts of ranks, documents and blocks (int64 each) and
the 8 bytes ``MAGIC``. Readers seek to the tail first. Files are written in
ascending key order, one for each range of keys; names carry a random part, and
only the files of successful tasks get into the manifest that Spark commits, so
a task that is run again leaves at most an unlisted file.

Edge cases: a null text is empty, its document holds the end id alone. Null
keys come first. Repeated keys keep all their rows, in order of content. An
empty table gives no rows. A very long text is encoded alone, whole, and spans blocks.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hostelry.llm import files
from hostelry.llm.bpe import ENCODE_BYTES, encoder
from hostelry.llm.common import materialize, only, partitions, scratch, text_parts, texts

MAGIC = b"RANKSVB1"
#: Values of a block: bounds what a reader holds.
BLOCK = 1 << 20
_LENGTHS = np.array([[(c >> s & 3) + 1 for s in (0, 2, 4, 6)] for c in range(256)], np.int64)


def svb_encode(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of uint32 values."""
    values = values.astype(np.uint32)
    lens = 1 + (values > 0xFF).astype(np.int64) + (values > 0xFFFF) + (values > 0xFFFFFF)
    padded = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    padded[:len(values)] = lens - 1
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    raw = values.astype("<u4").view(np.uint8).reshape(-1, 4)
    return control.tobytes(), raw[np.arange(4) < lens[:, None]].tobytes()


def svb_decode(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n values of a block, by table lookup."""
    lens = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    ends = np.cumsum(lens)
    starts = ends - lens
    raw = np.frombuffer(data + b"\0\0\0", np.uint8).astype(np.uint32)
    out = raw[starts]
    for k in range(1, int(lens.max(initial=1))):
        out |= np.where(lens > k, raw[starts + k], 0).astype(np.uint32) << np.uint32(8 * k)
    return out


class TokenFileWriter:
    """Appends documents to one file."""

    def __init__(self, uri: str, ids_by_rank: np.ndarray):
        self.file, self.at = files.create(uri), 0
        self.ids_by_rank = ids_by_rank.astype("<u4")
        self.rank = np.zeros(int(ids_by_rank.max(initial=0)) + 1, np.uint32)
        self.rank[ids_by_rank] = np.arange(len(ids_by_rank), dtype=np.uint32)
        self.keys: list[int | None] = []
        self.counts: list[int] = []
        self.blocks: list[tuple[int, int, int]] = []
        self.pending: list[np.ndarray] = []
        self.held = 0

    def add(self, keys: list[int | None], counts: list[int], ids: np.ndarray) -> None:
        """Documents in order, their ids one after the other."""
        self.keys += keys
        self.counts += counts
        self.pending.append(ids)
        self.held += len(ids)
        if self.held >= BLOCK:
            self._flush()

    def _flush(self) -> None:
        ranks = self.rank[np.concatenate(self.pending)] if self.pending else np.empty(0, np.uint32)
        for i in range(0, len(ranks), BLOCK):
            own = ranks[i:i + BLOCK]
            control, data = svb_encode(own)
            self.blocks.append((self.at, len(own), len(data)))
            self.file.write(control + data)
            self.at += len(control) + len(data)
        self.pending, self.held = [], 0

    def close(self) -> None:
        self._flush()
        for x in (self.ids_by_rank,
                  np.array([k or 0 for k in self.keys], "<i8"), np.array([k is None for k in self.keys], np.uint8),
                  np.array(self.counts, "<i8"), np.array(self.blocks, "<i8"),
                  np.array([len(self.ids_by_rank), len(self.keys), len(self.blocks)], "<i8")):
            self.file.write(x.tobytes())
        self.file.write(MAGIC)
        self.file.close()


def read_token_file(uri: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """(key, ids as uint32) of each document, block by block."""
    size = files.size(uri)
    with files.open_ranged(uri) as f:
        tail = files.read_range(f, size - 32, 32)
        if tail[24:] != MAGIC:
            raise ValueError(f"{uri} is not a token file")
        ranks, docs, blocks = np.frombuffer(tail[:24], "<i8").tolist()
        length = 4 * ranks + 17 * docs + 24 * blocks
        raw, at = files.read_range(f, size - 32 - length, length), 0

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(raw, kind, n, at)
            at += out.nbytes
            return out
        ids_by_rank, keys, null, counts = take("<u4", ranks), take("<i8", docs), take("u1", docs), take("<i8", docs)
        index = take("<i8", 3 * blocks).reshape(-1, 3).tolist()
        held, i = np.empty(0, np.uint32), 0
        for k in range(docs):
            need = int(counts[k])
            if len(held) < need:
                parts, have = [held], len(held)
                while have < need:
                    start, n, data = index[i]
                    control = -(-n // 4)
                    block = files.read_range(f, start, control + data)
                    parts.append(ids_by_rank[svb_decode(block[:control], block[control:], n)])
                    have, i = have + n, i + 1
                held = np.concatenate(parts)
            yield (None if null[k] else int(keys[k])), held[:need]
            held = held[need:]


def flat_ids(column: pa.Array, widths: pa.Array) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Runs of rows with ids of one width: their rows, ids and counts."""
    width = widths.to_numpy()
    cuts = [0, *(np.flatnonzero(np.diff(width)) + 1).tolist(), len(width)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            part = column.slice(a, b - a)
            ends = np.frombuffer(part.buffers()[1], np.int32)[part.offset:part.offset + b - a + 1].astype(np.int64)
            raw = np.frombuffer(part.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
            yield slice(a, b), raw.view(f"<u{width[a]}") if len(raw) else np.empty(0, np.uint32), np.diff(ends) // width[a]


def encoded_ids(docs: DataFrame, path: str, end_id: int, key: str, text: str) -> DataFrame:
    """(key, ids: bytes of little-endian ids as narrow as the vocabulary allows, wide: their width)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        width = 2 if len(enc.lengths) <= 1 << 16 else 4
        for part in text_parts(batches, text, ENCODE_BYTES):
            ids, counts = enc.encode(texts(part, text))
            ends = np.cumsum(counts)
            with_end = np.insert(ids, ends, end_id).astype(f"<u{width}")
            offsets = np.concatenate([[0], width * (ends + np.arange(1, len(ends) + 1))]).astype(np.int32)
            col = pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(with_end.tobytes())])
            yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), col, pa.array([width] * len(counts), pa.int32())], ["key", "ids", "width"])
    return only(docs, key, text).mapInArrow(run, "key long, ids binary, width int")


def id_frequencies(encoded: DataFrame) -> DataFrame:
    """(id, n) over all rows; at most one row an id leaves each task."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for b in batches:
            for _, ids, _ in flat_ids(b.column(0), b.column(1)):
                got = np.bincount(ids, minlength=len(total))
                got[:len(total)] += total
                total = got
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["id", "n"])
    return encoded.select("ids", "width").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_token_files(docs: DataFrame, path: str, folder: str, end_id: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the files; returns the manifest (part, uri, n_docs, n_ids, start:
    ids in all files before). The rank table, one row for each id of the
    vocabulary, goes through the driver."""
    encoded = materialize(encoded_ids(docs, path, end_id, key, text), "token-ids")
    ranked = id_frequencies(encoded).orderBy(F.desc("n"), "id").select("id").toPandas()["id"].to_numpy()
    ids_by_rank = ranked.astype(np.uint32)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        writer = None
        for b in batches:
            if writer is None and len(b):
                uri = f"{folder}/part-{part:06d}-{uuid.uuid4().hex[:12]}.ids"
                writer = TokenFileWriter(uri, ids_by_rank)
            keys = b.column(0).to_pylist()
            for rows, ids, counts in flat_ids(b.column(1), b.column(2)):
                writer.add(keys[rows], counts.tolist(), ids)
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([uri]), pa.array([len(writer.keys)], pa.int64()), pa.array([sum(writer.counts)], pa.int64())],
                ["part", "uri", "n_docs", "n_ids"])
    manifest = materialize(
        encoded.repartitionByRange("key").sortWithinPartitions("key", F.xxhash64("ids"))
        .mapInArrow(write, "part long, uri string, n_docs long, n_ids long"), "token-manifest")
    # one row a file: a running sum over the manifest alone
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_token_files(manifest: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of each document, from the files."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rows = []
                for k, ids in read_token_file(uri):
                    rows.append((k, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    start += len(ids)
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["key", "start", "n_tokens", "ids_crc32"])
    # a number given keeps these small rows, each a whole file of work, in partitions of their own
    one_each = manifest.select("uri", "start").repartition(partitions(manifest.sparkSession), "uri")
    return one_each.mapInArrow(run, "key long, start long, n_tokens long, ids_crc32 long").withColumnRenamed("key", key)


def token_files(docs: DataFrame, path: str, end_id: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write ``docs`` as token-id files in the shared folder and read them back."""
    manifest = write_token_files(docs, path, scratch(docs.sparkSession, "token-files"), end_id, key, text)
    return read_token_files(manifest, key)
