"""Helpers shared by the operators: words, stable hashes, Arrow batches, scratch tables.

A *word* is a maximal run of bytes other than 0x20 and 0x09-0x0D, which is
what ``bytes.split()`` returns. Hashes are xxh64 (seed 0), so every executor
and every rerun agrees.
"""

from __future__ import annotations

import contextlib
import ctypes
import io
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from contextvars import ContextVar
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import hostelry
from hostelry.llm import files
from hostelry.session import ensure_checkpoint_dir

#: Bytes of text handled at once inside a task; a longer document is handled alone.
CHUNK_BYTES = 1 << 20
#: The same where a task sums up what it has handled at once before it sends that on.
SUMMED_BYTES = 4 << 20
#: Words remembered by a worker's hash table before it starts anew; it is emptied after each task.
WORD_CACHE = 250_000
#: Whether Spark removes the shuffle files of a query at its end; by default they wait for a garbage collection of the driver.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_MULT = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class WordHashes(dict):
    """word (bytes) -> 64-bit hash, remembered up to ``WORD_CACHE`` words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_HASHES = WordHashes()


def hash_words(words: list[bytes]) -> np.ndarray:
    """uint64 hash of each word."""
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the whole 64-bit value."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive word hashes, by doubling: the
    hash of a run of a+b words combines those of its first a and last b."""
    count = len(words) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    power, have, out, out_len = mix(words + _MULT), 1, None, 0
    width = n
    while width:
        if width & 1:
            if out is None:
                out, out_len = power[:count], have
            else:
                tail = power[out_len:out_len + count]
                out, out_len = mix(out * _MULT + tail), out_len + have
        width >>= 1
        if width:
            power = mix(power[:-have] * _MULT + power[have:])
            have *= 2
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def row_chunks(lengths: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose lengths sum to at most ``limit`` (one row at least)."""
    start, n = 0, len(lengths)
    ends = np.cumsum(lengths)
    while start < n:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield start, stop
        start = stop


def release_memory() -> None:
    """Forget words and give freed memory back to the system: workers live on between tasks
    and stages, and an executor has several."""
    _HASHES.clear()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not a GNU C library
        ctypes.CDLL(None).malloc_trim(0)


def text_parts(batches: Iterable[pa.RecordBatch], column: str = "text",
               limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with a bounded number of text bytes, so memory
    does not depend on rows per batch."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(column))
        lengths = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        for a, b in row_chunks(lengths, limit):
            yield batch.slice(a, b - a)
    release_memory()


def texts(part: pa.RecordBatch, column: str = "text") -> pa.Array:
    """The column as large_string; null: empty."""
    return pc.fill_null(part.column(part.schema.get_field_index(column)).cast(pa.large_string()), "")


def text_chunks(batches: Iterable[pa.RecordBatch], column: str = "text",
                limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """``text_parts`` with the UTF-8 of the column (null: empty)."""
    for part in text_parts(batches, column, limit):
        yield part, texts(part, column).cast(pa.large_binary()).to_pylist()


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder of ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later steps restart
    from the files when an executor is lost, and the plan does not grow. The
    write's own shuffle files, which nothing reads again, go with its end."""
    spark = df.sparkSession
    path = scratch(spark, name)
    if (tables := _ON_THE_WAY.get()) is not None:
        tables.append(path)
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def settled(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """``materialize`` of what ``make`` returns; the tables that ``make`` materialized on the way
    are removed then. None of these may be read by anything but that result."""
    outer = _ON_THE_WAY.set(tables := [])
    try:
        df = make()
    finally:
        _ON_THE_WAY.reset(outer)
    out = materialize(df, name)
    for path in tables:
        files.remove(path)
    return out


_ON_THE_WAY: ContextVar[list[str] | None] = ContextVar("on_the_way", default=None)


def ship(spark: SparkSession) -> SparkSession:
    """Give the workers this package: a zip of its sources in the shared
    folder, added once per application (as ``--py-files`` would)."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        root = Path(hostelry.__file__).parent
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w") as z:
            for source in sorted(root.rglob("*.py")):
                z.write(source, Path("hostelry") / source.relative_to(root))
        uri = f"{scratch(spark, 'code')}/hostelry.zip"
        with files.create(uri) as f:
            f.write(packed.getvalue())
        sc.addPyFile(uri)
        _SHIPPED.add(sc.applicationId)
    return spark


_SHIPPED: set[str] = set()


def partitions(spark: SparkSession) -> int:
    """Number of shuffle partitions the session asks for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def only(df: DataFrame, *names: str) -> DataFrame:
    """Just these columns, found by exact name, so that extra columns of the
    caller (also ones named like an operator's own) never interfere."""
    return df.select(*[F.col(f"`{n}`") for n in names])
