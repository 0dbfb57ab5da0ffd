"""Files of an own format in the shared folder. Tasks write them by URI: a mounted path, HDFS, S3 or GCS.

A task gives every file a name of its own and returns it in its rows. Only the rows of tasks that
succeeded reach the manifest, so what a lost or repeated task left behind is never read."""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs


def resolve(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a URI or a path, with Hadoop's names of stores."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    scheme, rest = uri.split(":", 1)
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{ {'s3a': 's3', 's3n': 's3'}.get(scheme, scheme)}:{rest}")


def create(folder: str, suffix: str) -> tuple[str, pa.NativeFile]:
    """A new file below ``folder`` that no other task attempt writes: its URI and an open stream."""
    uri = f"{folder.rstrip('/')}/{uuid.uuid4().hex}{suffix}"
    system, path = resolve(uri)
    if isinstance(system, fs.LocalFileSystem):
        system.create_dir(os.path.dirname(path), recursive=True)
    return uri, system.open_output_stream(path)


def open_file(uri: str) -> pa.NativeFile:
    system, path = resolve(uri)
    return system.open_input_file(path)


def read_range(file: pa.NativeFile, start: int, size: int) -> bytes:
    """``size`` bytes from ``start`` on; less is an error."""
    data = file.read_at(size, start)
    if len(data) != size:
        raise ValueError(f"{size} bytes from {start} on: the file ends after {len(data)}")
    return data


def read_numbers(folder: str, column: str) -> np.ndarray:
    """A column of whole numbers of all Parquet files in a folder; none where there is no such folder."""
    system, path = resolve(folder)
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    files = [f.path for f in found if f.is_file and f.path.endswith(".parquet")]
    parts = [pq.read_table(f, columns=[column], filesystem=system)[column].to_numpy() for f in files]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)
