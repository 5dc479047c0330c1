"""Binary files in shared storage, written and read inside tasks through Arrow's file systems.

A URI such as ``file:///shared/x``, ``hdfs://...`` or ``s3://...`` (or a plain
absolute path on a mounted folder) names a file. A task writes each file under
a name of its own attempt; only files whose names reach the stored manifest are
ever read, so a retried or speculative task leaves at most an unread file.
"""
from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyarrow import fs


def resolve(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI."""
    if "://" not in uri and uri.startswith("file:/"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


def new_name(folder: str, suffix: str) -> str:
    """A name no other task or attempt uses."""
    return f"{folder}/{uuid.uuid4().hex}{suffix}"


@contextlib.contextmanager
def writing(uri: str) -> Iterator:
    """An output stream; its folder is made first."""
    system, path = resolve(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    with system.open_output_stream(path, compression=None) as out:
        yield out


@contextlib.contextmanager
def reading(uri: str) -> Iterator:
    """An input file with sequential and random reads."""
    system, path = resolve(uri)
    with system.open_input_file(path) as source:
        yield source
