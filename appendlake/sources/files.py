"""Byte access from inside tasks, for local paths and for any URI pyarrow can open."""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow.fs as pafs
from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


# Schemes as pyarrow names them, and where a mounted volume lies for tasks.
ALIASES = {"s3a": "s3", "s3n": "s3"}
MOUNTS = {"dbfs": "/dbfs"}
KNOWN = ("hdfs", "viewfs", "s3", "gs", "gcs", "abfs", "abfss")


def open_file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and the path inside it.

    A URI may have one slash after its scheme, as Hadoop writes it, or two and an
    authority. ``file:`` and the schemes of mounted volumes are local paths; a scheme
    that nothing here can open is an error, not a relative path.
    """
    found = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):(/.*)", path, re.DOTALL)
    if not found:
        return pafs.LocalFileSystem(), path
    scheme, rest = found[1].lower(), found[2]
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + (re.sub("^//[^/]*", "", rest) if rest.startswith("//") else rest).lstrip("/")
    if scheme in MOUNTS:
        return pafs.LocalFileSystem(), f"{MOUNTS[scheme]}/{rest.lstrip('/')}"
    scheme = ALIASES.get(scheme, scheme)
    if scheme not in KNOWN:
        raise ValueError(f"no file system for the scheme of {path!r}")
    # With one slash there is no authority: the cluster's default one is meant.
    authority = "" if rest.startswith("//") else "//default" if scheme in ("hdfs", "viewfs") else "//"
    return pafs.FileSystem.from_uri(f"{scheme}:{authority}{rest}")


def literal(path: str) -> str:
    """A path as Spark's readers take it, with the characters of a glob made plain."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def create_once(spark: SparkSession, path: str) -> bool:
    """Make an empty file; false if it is there already, however many try at the same time."""
    fs, inner = open_file_system(path)
    if isinstance(fs, pafs.LocalFileSystem):
        os.makedirs(os.path.dirname(inner), exist_ok=True)
        try:
            os.close(os.open(inner, os.O_CREAT | os.O_EXCL | os.O_WRONLY))
        except FileExistsError:
            return False
        return True
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        store.create(place, False).close()
    except Py4JJavaError:
        if not store.exists(place):
            raise
        return False
    return True


def read_blocks(path: str, start: int, end: int, block_bytes: int) -> Iterator[bytes]:
    """The bytes ``[start, end)`` in blocks; fewer bytes than asked for is an error."""
    fs, inner = open_file_system(path)
    with fs.open_input_file(inner) as source:
        source.seek(start)
        while start < end:
            block = source.read(min(block_bytes, end - start))
            if not block:
                raise EOFError(f"{path} ends at {start}, before {end}")
            start += len(block)
            yield block


def copy_bytes(source: str, target: str, start: int, end: int, block_bytes: int) -> int:
    """Copy ``[start, end)`` to a new file that appears under its name only when whole; the CRC-32 of the bytes.

    A second attempt of the same task writes its own hidden file and finds an equal one
    in place, so retries and speculative tasks are harmless. A target of another length
    is another range's: it is never replaced.
    """
    fs, inner = open_file_system(target)
    folder, _, name = inner.rpartition("/")
    fs.create_dir(folder, recursive=True)
    hidden, crc = f"{folder}/.{name}.{uuid.uuid4().hex}", 0
    try:
        with fs.open_output_stream(hidden) as sink:
            for block in read_blocks(source, start, end, block_bytes):
                sink.write(block)
                crc = zlib.crc32(block, crc)
        there = fs.get_file_info(inner)
        if there.type != pafs.FileType.NotFound and there.size != end - start:
            raise FileExistsError(f"{target} has {there.size} bytes, not {end - start}")
        fs.move(hidden, inner)
        return crc
    except BaseException:
        if fs.get_file_info(hidden).type != pafs.FileType.NotFound:
            fs.delete_file(hidden)
        raise
