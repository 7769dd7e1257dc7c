"""Archives: members are unpacked by executors into a shared folder, then scanned.

A zip member is a row of its own, so members of one large archive unpack in
parallel. Tar and gzip streams are sequential: one task per archive. Copies go
in blocks; no member is held in memory.
"""

from __future__ import annotations

import posixpath
import re
import shutil
import tarfile
import zipfile
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.user import one_task_each
from siltstone.session import materialise
from siltstone.sources.files import list_files
from siltstone.storage import arrow_path, file_name

BLOCK = 8 << 20
# Fixed value: bytes of a zip archive without members, which is its closing record alone.
EMPTY_ZIP = 22

MEMBERS = "archive string, member string, whole boolean"
UNPACKED = "archive string, member string, path string, length long"


def glob_regex(pattern: str) -> str:
    """A glob as a regular expression; ``**/`` also matches no folder at all, ``{a,b}`` either."""
    out = ""
    for token in re.findall(r"\*\*/|\*\*|\*|\?|\[[^\]]*\]|\{[^{}]*\}|[^*?\[{]+|\[|\{", pattern):
        if token.startswith("{") and token.endswith("}"):
            out += "(?:" + "|".join(glob_regex(part)[1:-1] for part in token[1:-1].split(",")) + ")"
            continue
        out += {"**/": "(?:.*/)?", "**": ".*", "*": "[^/]*", "?": "[^/]"}.get(token) or (
            token if token.startswith("[") and token.endswith("]") else re.escape(token)
        )
    return f"^{out}$"


def kind_of(archive: str) -> str:
    name = archive.lower()
    for suffix, kind in ((".zip", "zip"), (".tar.gz", "tar"), (".tgz", "tar"), (".tar", "tar"), (".gz", "gz")):
        if name.endswith(suffix):
            return kind
    raise ValueError(f"unsupported archive type: {archive}")


def safe_member(member: str) -> str:
    """The member path, refused when it would leave the folder it is unpacked to."""
    plain = posixpath.normpath(member.replace("\\", "/"))
    if plain.startswith(("/", "../")) or plain == "..":
        raise ValueError(f"path traversal detected: {member}")
    return plain


def list_members(archives: DataFrame) -> DataFrame:
    """(archive, member, whole): zip members one by one, other archives as a whole."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for archive in batch["path"]:
                if kind_of(archive) != "zip":
                    rows.append((archive, None, True))
                    continue
                fs, name = arrow_path(archive)
                if fs.get_file_info(name).size <= EMPTY_ZIP:
                    continue
                with fs.open_input_file(name) as handle, zipfile.ZipFile(handle) as content:
                    rows += [(archive, i.filename, False) for i in content.infolist() if not i.is_dir()]
            yield pd.DataFrame(rows, columns=["archive", "member", "whole"])

    return archives.select("path").mapInPandas(run, MEMBERS)


def unpack(archives: DataFrame, target: str, pattern: str = "**/*") -> DataFrame:
    """Copy matching members below ``target``; (archive, member, path, length) of each.

    Target paths follow from archive and member names, and a member appears under
    its name only once complete, so a repeated task writes the same files.
    """
    wanted = glob_regex(pattern)
    listed = list_members(one_task_each(archives.select("path")))
    members = materialise(listed.filter(F.col("whole") | F.col("member").rlike(wanted)), "members")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for archive, member in zip(batch["archive"], batch["member"]):
                rows += _copy(archive, member, target, wanted)
            yield pd.DataFrame(rows, columns=["archive", "member", "path", "length"])

    # written, so that using the result does not copy again
    return materialise(one_task_each(members).mapInPandas(run, UNPACKED), "unpacked")


def _copy(archive: str, member: str | None, target: str, wanted: str) -> list[tuple]:
    fs, name = arrow_path(archive)
    folder = f"{target}/{folder_name(archive)}"
    kind = kind_of(archive)
    if kind == "zip":
        with fs.open_input_file(name) as handle, zipfile.ZipFile(handle) as content, content.open(member) as source:
            return [(archive, member, *_store(source, folder, member))]
    if kind == "gz":
        inner = file_name(archive)[:-3]
        if not re.search(wanted, inner):
            return []
        with fs.open_input_stream(name, compression="gzip") as source:
            return [(archive, inner, *_store(source, folder, inner))]
    rows = []
    compression = None if archive.lower().endswith(".tar") else "gzip"
    with fs.open_input_stream(name, compression=compression) as handle, tarfile.open(fileobj=handle, mode="r|") as content:
        for entry in content:
            safe_member(entry.name)
            if entry.isfile() and re.search(wanted, entry.name.removeprefix("./")):
                rows.append((archive, entry.name, *_store(content.extractfile(entry), folder, entry.name)))
    return rows


def folder_name(archive: str) -> str:
    """A folder name per archive path: readable, and distinct for equal names elsewhere."""
    import hashlib

    plain = archive.removeprefix("file:")
    return re.sub(r"\W", "_", file_name(archive)) + "_" + hashlib.sha256(plain.encode()).hexdigest()[:8]


def _store(source, folder: str, member: str) -> tuple[str, int]:
    import uuid

    path = f"{folder}/{safe_member(member)}"
    fs, name = arrow_path(path)
    fs.create_dir(posixpath.dirname(name), recursive=True)
    # a leading dot keeps unfinished copies out of scans
    partial = f"{posixpath.dirname(name)}/.{posixpath.basename(name)}.{uuid.uuid4().hex[:8]}"
    with fs.open_output_stream(partial) as sink:
        shutil.copyfileobj(source, sink, BLOCK)
        length = sink.tell()
    fs.move(partial, name)
    return path, length


def archive_files(spark: SparkSession, archives: Iterable[str]) -> DataFrame:
    found = list_files(spark, archives)
    if found.isEmpty():
        raise ValueError(f"no archives match {list(archives)}")
    return found
