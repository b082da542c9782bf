"""Files of our own formats, below the folder that all executors share.

Spark has no writer for arbitrary binary files. Tasks write under a name that no
other attempt uses and return it; only names that reached the committed manifest
count, so what a lost attempt leaves behind is never read.
"""

from __future__ import annotations

import re
import uuid

import pyarrow.fs as pafs


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI and the path inside it."""
    if not re.match(r"\w+:", path):
        return pafs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path)


def attempt_name(folder: str, partition: int, suffix: str) -> str:
    return f"{folder}/part-{partition:06d}-{uuid.uuid4().hex}{suffix}"


def create(path: str):
    """An output stream; the folder is made where the store has folders."""
    store, inside = open_store(path)
    store.create_dir(inside.rsplit("/", 1)[0], recursive=True)
    return store.open_output_stream(inside)


def open_for_reading(path: str):
    """A seekable input."""
    store, inside = open_store(path)
    return store.open_input_file(inside)
