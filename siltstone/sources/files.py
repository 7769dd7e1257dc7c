"""File listings as DataFrames."""

from __future__ import annotations

import codecs
import posixpath
import re
from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from multiprocessing.pool import ThreadPool
from urllib.parse import urlparse

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.text import base_name
from siltstone.storage import Storage, arrow_path

# A listing task only returns file attributes, so thousands of splits share one task.
LISTING_TASKS = 2048
HEAD_BYTES = 1 << 16
# A record that has not ended by then has a quote that is never closed; no header is this long.
LONGEST_HEAD = 1 << 24
# Jobs of one task that read heads at the same time.
HEAD_JOBS = 32
# Schemes that Python workers can open without a Hadoop client.
DIRECT_SCHEMES = ("", "file", "s3", "s3a", "s3n", "gs")


_SPECIAL = re.compile(r"[\\\[\]{}*?]")


def literal(path: str) -> str:
    """A listed path as a reader takes it: characters that a glob would interpret are escaped."""
    return _SPECIAL.sub(r"\\\g<0>", path)


def split_pattern(path: str) -> tuple[str, str | None]:
    """``dir/**/x/*.csv`` as (folder, glob below any number of folders); other paths unchanged."""
    if "**" not in path:
        return path, None
    folder, _, rest = path.partition("**")
    folder = folder.rstrip("/") if folder.strip("/") else folder[:1] or "."
    return folder, rest.strip("/") or None


def read_target(spark: SparkSession, paths: Iterable[str]) -> tuple[list[str], str | None]:
    """Load paths and the common file-name filter for a reader.

    Hadoop globs have no ``**``. Where all paths ask for the same names below their folders, a recursive
    listing with a name filter is exact; otherwise a pattern stands for one glob per depth that occurs.
    """
    paths = list(paths)
    split = [split_pattern(p) for p in paths]
    rests = {rest for _, rest in split}
    if len(rests) == 1 and (only := rests.pop()) and "/" not in only:
        return [folder for folder, _ in split], only
    targets: list[str] = []
    for folder, rest in split:
        targets += [folder] if rest is None else _depths(spark, folder, rest)
    return list(dict.fromkeys(targets)), None


def _depths(spark: SparkSession, folder: str, rest: str) -> list[str]:
    """Globs without ``**`` that match the same files; the deepest file comes from a distributed listing."""
    if "**" in rest:
        return _matching(spark, folder, f"**/{rest}")
    store = Storage(spark)
    found = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", posixpath.basename(rest)).load(folder))
    deepest = found.select(F.max(F.size(F.split("path", "/")))).first()[0] or 0
    spare = deepest - len(store.qualified(folder).split("/")) - rest.count("/") - 1
    globs = ["/".join([folder.rstrip("/"), *["*"] * depth, rest]) for depth in range(max(0, spare) + 1)]
    return [g for g in globs if store.matches(g)] or globs[:1]


def _matching(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    """Files below ``folder`` that a pattern with several ``**`` matches; the listing and the test are distributed.

    Only paths that match come to the driver, which is what a reader is given. A path that matches nothing is kept as
    one that no file has, so that the reader reports it.
    """
    from siltstone.sources.archives import glob_regex

    root = Storage(spark).qualified(folder).rstrip("/")
    found = list_files(spark, [folder]).filter(F.substring("path", len(root) + 2, 1 << 20).rlike(glob_regex(pattern)))
    return sorted(literal(r["path"]) for r in found.select("path").collect()) or [f"{folder}/{pattern.replace('**/', '').replace('**', '*')}"]


def list_files(spark: SparkSession, paths: Iterable[str], recursive: bool = True) -> DataFrame:
    """(path, file_name, length, modified): attributes only, contents are never read."""
    targets, name_filter = read_target(spark, paths)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    return (
        reader.load(targets)
        .select(
            "path",
            base_name(F.col("path")).alias("file_name"),
            "length",
            F.col("modificationTime").alias("modified"),
        )
        .coalesce(LISTING_TASKS)
    )


def first_records(
    spark: SparkSession, paths: Iterable[str], skip: int = 0, encoding: str = "utf-8", quote: str = '"'
) -> DataFrame:
    """(path, head): the first record of each file after ``skip`` lines; empty files have none."""
    paths = list(paths)
    if all(urlparse(p).scheme in DIRECT_SCHEMES for p in paths):
        heads = file_heads(list_files(spark, paths), skip, encoding, quote)
    else:
        heads = first_lines(spark, paths, skip, encoding, quote)
    return heads.filter(F.trim("head") != "")


def file_heads(files: DataFrame, skip: int = 0, encoding: str = "utf-8", quote: str = '"') -> DataFrame:
    """(path, head), read straight from the files of a listing.

    Each task opens its files and reads a few kilobytes, so the cost follows the
    number of files rather than their size. Quotes may span lines; the head grows
    until they are balanced. An empty file has an empty head.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            heads = [_head(path, skip, encoding, quote) for path in batch["path"]]
            yield pd.DataFrame({"path": batch["path"], "head": heads})

    return files.select("path").mapInPandas(run, "path string, head string")


def sample_rows(read: Callable[[str], DataFrame], files: Iterable[str], rows: int) -> DataFrame:
    """The first rows of each of the files, which are few.

    ``read`` scans one file with any reader, on any file system. A limit stops its task after ``rows`` rows, so the bytes
    read follow the number of files and not their size. For the first rows of every file of a table see ``rows_per_file``.
    """
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [read(literal(file)).limit(rows) for file in files])


def first_lines(
    spark: SparkSession, paths: Iterable[str], skip: int = 0, encoding: str = "utf-8", quote: str = '"'
) -> DataFrame:
    """(path, head) through Spark's text reader, for file systems only Hadoop can open.

    Each file is a job of one task, many at a time, that stops after its first record, so no more than a block of a file is read.
    A record may span lines inside quotes. The driver holds paths and heads, as it does those of a header group.
    """
    reader = spark.read.option("encoding", encoding)

    def head(path: str) -> tuple[str, str] | None:
        wanted = skip + 1
        while True:
            found = [r["value"] for r in reader.text(literal(path)).limit(wanted).collect()]
            lines = found[skip:]
            if found and not skip:
                lines[0] = lines[0].removeprefix("\ufeff")
            for end in range(1, len(lines) + 1):
                if sum(line.count(quote) for line in lines[:end]) % 2 == 0:
                    return path, "\n".join(lines[:end])
            if len(found) < wanted or sum(map(len, lines)) > LONGEST_HEAD:
                return (path, "\n".join(lines)) if lines else None
            wanted = skip + 2 * (wanted - skip)

    files = [r["path"] for r in list_files(spark, paths).filter("length > 0").select("path").collect()]
    with ThreadPool(min(HEAD_JOBS, len(files) or 1)) as pool:
        heads = [found for found in pool.map(head, files) if found]
    return spark.createDataFrame(heads, "path string, head string")


def _head(path: str, skip: int, encoding: str, quote: str = '"') -> str:
    fs, name = arrow_path(path)
    with fs.open_input_stream(name, compression="detect") as stream:
        decode = codecs.getincrementaldecoder(encoding)(errors="ignore").decode
        text, at, inside, lines = "", 0, False, 0
        body = 0 if skip == 0 else None  # where the first record begins
        while True:
            chunk = stream.read(HEAD_BYTES)
            text += decode(chunk, final=not chunk)
            if at == 0:
                text = text.removeprefix("\ufeff")
            # each letter is looked at once, however far the record goes
            for place in range(at, len(text)):
                if body is None:
                    lines += text[place] == "\n"
                    body = place + 1 if lines == skip else None
                elif text[place] == quote:
                    inside = not inside
                elif text[place] == "\n" and not inside:
                    return text[body:place]
            at = len(text)
            if not chunk or (body is not None and at - body > LONGEST_HEAD):
                return "" if body is None else text[body:]


