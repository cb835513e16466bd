"""Files in the shared folder, opened by URI from any task."""

from __future__ import annotations

import uuid

import pyarrow as pa
import pyarrow.fs as pafs


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """The store behind a URI or an absolute path, and the path within it."""
    if "://" in uri or uri.startswith("file:"):
        if uri.startswith("file:") and not uri.startswith("file://"):
            uri = f"file://{uri.removeprefix('file:')}"
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


def new_name(partition: int, number: int, suffix: str) -> str:
    """Attempts never write to one file: a file counts once a manifest row names it."""
    return f"part-{partition:05d}-{number:04d}-{uuid.uuid4().hex[:12]}{suffix}"


def create(folder: str, name: str) -> tuple[str, pa.NativeFile]:
    store, path = open_store(folder)
    store.create_dir(path, recursive=True)
    return f"{folder}/{name}", store.open_output_stream(f"{path}/{name}", compression=None)


def open_file(uri: str) -> pa.NativeFile:
    store, path = open_store(uri)
    return store.open_input_file(path)
