"""Files that tasks write and read in the shared folder.

Tasks address files by URI through pyarrow's file systems.  A task attempt
writes under a name of its own and reports it in its output rows; only names in
the committed rows (the manifest) count, so a retried or speculative attempt
leaves at most an unreferenced file.
"""

from __future__ import annotations

import uuid

from pyarrow import fs as pafs


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return pafs.FileSystem.from_uri(uri)


def new_name(folder: str, suffix: str) -> str:
    """A file name no other task attempt uses; the folder exists afterwards."""
    fs, path = open_fs(folder)
    fs.create_dir(path, recursive=True)
    return f"{folder.rstrip('/')}/{uuid.uuid4().hex}{suffix}"


def writer(uri: str):
    fs, path = open_fs(uri)
    return fs.open_output_stream(path, compression=None)


def random_reader(uri: str):
    fs, path = open_fs(uri)
    return fs.open_input_file(path)


def stream_reader(uri: str, compression: str | None = None):
    fs, path = open_fs(uri)
    return fs.open_input_stream(path, compression=compression, buffer_size=1 << 20)
