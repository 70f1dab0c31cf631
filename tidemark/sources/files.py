"""Raw files as streams of bytes, opened by the task that reads them."""

from __future__ import annotations

import io
from typing import Any

import pyarrow.fs as pafs

#: Stores that tasks open themselves. Files of any other are fetched by Spark, whole (2 GB at most).
STREAMED = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "gs": "gs"}


class StorageError(Exception):
    """The store failed to deliver, which says nothing about the file: the task fails and is tried again."""


class _Stored(io.RawIOBase):
    """Read errors of the store apart from those of what is read."""

    def __init__(self, stream: Any):
        self._stream = stream

    def readable(self) -> bool:
        return True

    def readinto(self, into: Any) -> int:
        try:
            piece = self._stream.read(len(into))
        except OSError as error:
            raise StorageError(str(error)) from error
        into[: len(piece)] = piece
        return len(piece)


def scheme_of(path: str) -> str:
    head, found, _ = path.partition(":/")
    return head if found else ""


def open_file(path: str) -> io.BufferedReader:
    """The bytes of a file of a store in ``STREAMED``, in order and never all at once."""
    scheme = scheme_of(path)
    rest = path[len(scheme) + 1:] if scheme else path
    try:
        if scheme in ("", "file"):
            stream = pafs.LocalFileSystem().open_input_stream("/" + rest.lstrip("/"), compression=None)
        else:
            host, _, inner = rest.removeprefix("//").partition("/")
            files, base = pafs.FileSystem.from_uri(f"{STREAMED[scheme]}://{host}/")
            stream = files.open_input_stream(f"{base.rstrip('/')}/{inner}", compression=None)
    except OSError as error:
        raise StorageError(str(error)) from error
    return io.BufferedReader(_Stored(stream), 1 << 20)
