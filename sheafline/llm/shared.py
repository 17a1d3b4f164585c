"""Tables and files in the folder that all executors share (`spark.checkpoint.dir`)."""

from __future__ import annotations

import os
import tempfile
import uuid
from urllib.parse import unquote, urlparse

import numpy as np
from pyarrow import fs
from pyspark.sql import DataFrame

from ..functions.session import new_path


def store(df: DataFrame, label: str) -> DataFrame:
    """Writes `df` as Parquet to the shared folder and reads it back: later steps neither repeat the work nor lose
    it with an executor."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path there. `file:/x` and plain paths are the local one."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), unquote(urlparse(path).path)
    return fs.FileSystem.from_uri(path)


def put(path: str, *parts: bytes | memoryview) -> None:
    """Writes a whole file under another name, then renames it: a task that is lost or runs twice leaves no half file."""
    store_, name = filesystem(path)
    store_.create_dir(os.path.dirname(name), recursive=True)
    part = f"{name}.{uuid.uuid4().hex}"
    with store_.open_output_stream(part, compression=None) as out:
        for data in parts:
            out.write(data)
    store_.move(part, name)


_copies: dict[str, str] = {}


def mapped(path: str, dtype: str) -> np.ndarray:
    """A file of numbers, memory-mapped. A file in a store that cannot be mapped is first copied to the worker's
    own temporary folder, once per worker process."""
    store_, name = filesystem(path)
    if not isinstance(store_, fs.LocalFileSystem):
        if path not in _copies:
            _copies[path] = os.path.join(tempfile.mkdtemp(), "part")
            fs.copy_files(name, _copies[path], source_filesystem=store_, destination_filesystem=fs.LocalFileSystem())
        name = _copies[path]
    if not os.path.getsize(name):
        return np.zeros(0, dtype=dtype)
    return np.memmap(name, dtype=dtype, mode="r")
