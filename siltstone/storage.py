"""Paths: Hadoop FileSystem calls on the driver, Arrow file systems inside tasks."""

from __future__ import annotations

import posixpath
import uuid
from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession


class Storage:
    """Metadata operations on whichever file system a path belongs to."""

    def __init__(self, spark: SparkSession):
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()

    def _open(self, path: str):
        target = self._hadoop.Path(path)
        return target.getFileSystem(self._conf), target

    def exists(self, path: str) -> bool:
        fs, target = self._open(path)
        return fs.exists(target)

    def qualified(self, path: str) -> str:
        """The path with the scheme that listings give it."""
        fs, target = self._open(path)
        return fs.makeQualified(target).toString()

    def is_dir(self, path: str) -> bool:
        fs, target = self._open(path)
        return fs.exists(target) and fs.getFileStatus(target).isDirectory()

    def matches(self, pattern: str) -> list[str]:
        """Sorted paths that a glob matches (names one directory level deep per ``*``)."""
        fs, target = self._open(pattern)
        found = fs.globStatus(target)
        return sorted(status.getPath().toString() for status in found or [])

    def mkdirs(self, path: str) -> None:
        fs, target = self._open(path)
        fs.mkdirs(target)

    def delete(self, path: str) -> None:
        fs, target = self._open(path)
        fs.delete(target, True)

    def delete_on_exit(self, path: str) -> None:
        # FileSystem.deleteOnExit ignores paths that do not exist yet
        fs, target = self._open(path)
        fs.mkdirs(target.getParent())
        fs.mkdirs(target)
        fs.deleteOnExit(target)
        fs.delete(target, True)

    def read_text(self, path: str) -> str | None:
        """A small text file; None where there is none."""
        fs, target = self._open(path)
        if not fs.exists(target):
            return None
        stream = fs.open(target)
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        """Replace a small text file: readers see the old text or the new one where the file system renames atomically."""
        fs, target = self._open(path)
        _, made = self._open(f"{path}.{uuid.uuid4().hex[:12]}")
        stream = fs.create(made, True)
        stream.write(bytearray(text.encode("utf-8")))
        stream.close()
        if fs.exists(target):
            fs.delete(target, False)
        self.rename(made.toString(), path)

    def rename(self, source: str, target: str) -> None:
        fs, src = self._open(source)
        _, dst = self._open(target)
        if not fs.rename(src, dst):
            raise OSError(f"could not rename {source} to {target}")


def arrow_path(uri: str):
    """(file system, path) for a URI as Spark reports it; usable on executors."""
    from pyarrow import fs

    scheme = urlparse(uri).scheme
    if scheme in ("", "file"):
        return fs.LocalFileSystem(), uri.removeprefix("file:").replace("///", "/", 1)
    if scheme in ("s3a", "s3n"):
        uri = "s3" + uri[len(scheme):]
    return fs.FileSystem.from_uri(uri)


def file_name(path: str) -> str:
    return unquote(posixpath.basename(path.rstrip("/")))
