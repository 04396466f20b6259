"""Files that tasks write into and read from the shared folder.

A task writes under a name of its own (a fresh uuid) and returns that name as a
row. The row reaches a table only through Spark's own commit, so files of
failed, repeated or speculative attempts are never read; a retry needs no clean-up.
Folders are URIs (``file:``, ``hdfs:``, ``s3:``) and open through pyarrow.
"""

from __future__ import annotations

import uuid


def _place(uri: str):
    from pyarrow import fs

    if uri.startswith("file:/"):
        return fs.LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/")
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def own_name(prefix: str) -> str:
    return f"{prefix}-{uuid.uuid4().hex}"


def open_out(folder: str, name: str):
    system, path = _place(folder)
    system.create_dir(path, recursive=True)
    return system.open_output_stream(f"{path}/{name}", compression=None)


def open_in(folder: str, name: str):
    """A random-access file."""
    system, path = _place(folder)
    return system.open_input_file(f"{path}/{name}")
