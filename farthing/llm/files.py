"""Binary files in the shared folder, written and read inside tasks.

A task writes under a name of its own attempt and reports it as a row; only reported
names are ever read. A lost or repeated attempt leaves a file that nobody reads.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyarrow.fs as pafs


def put(folder: str, label: str, data: bytes) -> str:
    """Write one file; its full name."""
    fs, root = pafs.FileSystem.from_uri(folder)
    fs.create_dir(root, recursive=True)
    name = f"{label}-{uuid.uuid4().hex}"
    with fs.open_output_stream(f"{root}/{name}") as out:
        out.write(data)
    return f"{folder}/{name}"


class Writer:
    """A file that grows; ``name`` is valid after ``close``."""

    def __init__(self, folder: str, label: str):
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        own = f"{label}-{uuid.uuid4().hex}"
        self.name, self.bytes = f"{folder}/{own}", 0
        self._out = fs.open_output_stream(f"{root}/{own}")

    def write(self, data: bytes) -> int:
        """Append; the offset where ``data`` starts."""
        at = self.bytes
        self._out.write(data)
        self.bytes += len(data)
        return at

    def close(self) -> None:
        self._out.close()


def get(name: str) -> bytes:
    fs, path = pafs.FileSystem.from_uri(name)
    with fs.open_input_stream(path) as source:
        return source.read()


def opened(name: str) -> tuple[Callable[[int, int], bytes], int]:
    """A reader of any place of a file (offset, number of bytes), and the file's size."""
    fs, path = pafs.FileSystem.from_uri(name)
    source = fs.open_input_file(path)
    return lambda at, n: source.read_at(n, at), source.size()
