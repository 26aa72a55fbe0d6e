"""Helpers shared by the operators: reading tables, fixed folds, numpy columns, shared files."""

from __future__ import annotations

import atexit
import functools
import mmap
import os
import tempfile
import uuid
import zipfile

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str | Column, folds: int) -> Column:
    """Remainder of the CRC-32 of a key as text; -1 for a null key."""
    column = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % folds, F.lit(-1))


def held_out(key: str | Column, folds: int, remainder: int) -> Column:
    return fold(key, folds) == remainder


def texts_of(column: pa.Array) -> list[str]:
    """Texts of an Arrow column; a null counts as empty."""
    return ["" if t is None else t for t in column.to_pylist()]


def free_name(taken, wanted: str) -> str:
    """``wanted``, with underscores in front until no column is called so."""
    lower = {c.lower() for c in taken}
    while wanted.lower() in lower:
        wanted = "_" + wanted
    return wanted


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64): spreads any integer over all bits."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x += np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


# ------------------------------------------------------------------ shared files

def _opened(uri: str):
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def is_local(uri: str) -> bool:
    return "://" not in uri or uri.startswith("file:")


def local_path(uri: str) -> str:
    return _opened(uri)[1]


def new_file(folder: str, suffix: str) -> str:
    """A path that no other attempt of a task uses."""
    return f"{folder}/{uuid.uuid4().hex}{suffix}"


def write_file(uri: str, chunks) -> int:
    """Write chunks to a new file of the shared folder; returns its size.

    The name is new for each attempt, and readers learn names only from the rows that the
    finished attempt returned, so a repeated or lost attempt leaves at most an unread file.
    """
    system, path = _opened(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    size = 0
    with system.open_output_stream(path) as out:
        for chunk in chunks:
            out.write(chunk)
            size += len(chunk)
    return size


def open_file(uri: str):
    system, path = _opened(uri)
    return system.open_input_file(path)


def mapped(uri: str) -> memoryview:
    """The file as mapped memory.

    A mounted shared folder is mapped where it is.  From another store the file is copied to
    the worker's own disk, mapped, and its name removed at once, so nothing stays behind.
    """
    if is_local(uri):
        with open(local_path(uri), "rb") as f:
            return memoryview(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))
    with tempfile.TemporaryFile() as copy, open_file(uri) as source:
        while block := source.read(1 << 22):
            copy.write(block)
        copy.flush()
        return memoryview(mmap.mmap(copy.fileno(), 0, access=mmap.ACCESS_READ))


# ------------------------------------------------------------------ the library itself

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, as ``--py-files`` would; once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(_archive_folder(), "statlake.zip")
    if not os.path.exists(path):
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
            for top, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        file = os.path.join(top, name)
                        out.write(file, os.path.relpath(file, os.path.dirname(package)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


@functools.cache
def _archive_folder() -> str:
    """Holds the archive on the driver while it runs; Spark itself serves it to the executors."""
    folder = tempfile.TemporaryDirectory(prefix="statlake-code-")
    atexit.register(folder.cleanup)
    return folder.name
