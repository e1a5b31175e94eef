"""Files in the shared folder, opened from tasks by URI."""

from __future__ import annotations

import contextlib
import os
import shutil
from typing import BinaryIO
from urllib.parse import unquote, urlparse


def _local(uri: str) -> str | None:
    parsed = urlparse(uri)
    return unquote(parsed.path) if parsed.scheme in ("", "file") else None


def create(uri: str) -> BinaryIO:
    """A new file for writing, its folder made first. Other schemes than file:
    go through pyarrow's file systems (HDFS, S3, GCS)."""
    if path := _local(uri):
        os.makedirs(os.path.dirname(path), exist_ok=True)
        return open(path, "xb")
    from pyarrow import fs
    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    return system.open_output_stream(path)


def open_ranged(uri: str) -> BinaryIO:
    """A seekable file for range reads."""
    if path := _local(uri):
        return open(path, "rb")
    from pyarrow import fs
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def size(uri: str) -> int:
    if path := _local(uri):
        return os.path.getsize(path)
    from pyarrow import fs
    system, path = fs.FileSystem.from_uri(uri)
    return system.get_file_info(path).size


def remove(uri: str) -> None:
    """A folder with all it holds goes; what cannot be removed stays."""
    if path := _local(uri):
        shutil.rmtree(path, ignore_errors=True)
        return
    from pyarrow import fs
    system, path = fs.FileSystem.from_uri(uri)
    with contextlib.suppress(OSError):
        system.delete_dir(path)


def read_range(f: BinaryIO, start: int, length: int) -> bytes:
    f.seek(start)
    data = f.read(length)
    if len(data) != length:
        raise EOFError(f"{length} bytes wanted at {start}, {len(data)} found")
    return data
