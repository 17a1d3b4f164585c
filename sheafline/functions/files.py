"""Files that tasks write and read one by one, in any store that pyarrow opens by path or URI."""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager
from urllib.parse import quote, unquote, urlparse

from pyarrow import fs


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path there."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), unquote(urlparse(path).path)
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def exists(path: str) -> bool:
    store, name = opened(path)
    return store.get_file_info(name).type != fs.FileType.NotFound


@contextmanager
def whole(path: str):
    """A file to write that gets its name when it is complete: a lost or repeated task leaves no half file, and writing
    the same file again replaces it."""
    store, name = opened(path)
    store.create_dir(os.path.dirname(name), recursive=True)
    part = os.path.join(os.path.dirname(name), f".{os.path.basename(name)}.{uuid.uuid4().hex}")
    with store.open_output_stream(part, compression=None) as out:
        yield out
    store.move(part, name)


def read(path: str) -> bytes:
    store, name = opened(path)
    with store.open_input_stream(name, compression=None) as source:
        return source.read()


def file_name(text: str) -> str:
    """A dataset's name as one step of a path."""
    return quote(text, safe=" ()+,=@~")
