"""CSV and TSV.

Spark binds a multi-file CSV scan to one header. Files here are grouped by the
header they really carry, each group is read by its own column names, and the
groups are united by name.
"""

from __future__ import annotations

import csv
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass
from functools import reduce
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.text import col, quoted
from siltstone.functions.types import parse_type, reported_name, widen_all
from siltstone.operators.align import NAME as FILE_NAME
from siltstone.operators.align import guard_extra_columns
from siltstone.sources.files import first_records, literal, read_target

# Option names of other readers and their Spark counterparts.
OPTION_NAMES = {"delim": "sep", "delimiter": "sep"}


@dataclass(frozen=True)
class DelimitedOptions:
    header: bool
    skip: int
    infer: bool
    spark: Mapping[str, str]

    @classmethod
    def of(cls, options: Mapping[str, Any] | None, tabs: bool = False) -> DelimitedOptions:
        given = {OPTION_NAMES.get(k, k): v for k, v in (options or {}).items() if v is not None}
        if tabs:
            given.setdefault("sep", "\t")
        header = _truth(given.pop("header", True))
        infer = _truth(given.pop("inferSchema", True))
        skip = int(given.pop("skip", 0))
        spark = {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in given.items()}
        return cls(header, skip, infer, spark)

    @property
    def encoding(self) -> str:
        return self.spark.get("encoding", self.spark.get("charset", "utf-8"))

    @property
    def quote(self) -> str:
        return self.spark.get("quote", '"')

    def split_header(self, head: str) -> list[str]:
        if not head.strip():
            return []
        sep, quote = self.spark.get("sep", ","), self.quote
        if len(sep) != 1 or len(quote) != 1:
            return head.rstrip("\r").split(sep)
        return next(csv.reader([head.rstrip("\r")], delimiter=sep, quotechar=quote))


def _truth(value: Any) -> bool:
    return str(value).strip().lower() in ("true", "1", "yes")


@dataclass(frozen=True)
class HeaderGroup:
    """Files that start with the same record."""

    columns: tuple[str, ...]
    paths: tuple[str, ...]
    files: int


def header_groups(spark: SparkSession, paths: Iterable[str], options: DelimitedOptions) -> list[HeaderGroup]:
    """Distinct first records, in a fixed order. Files without a line have none.

    Only the distinct records come to the driver. Where they differ, so do the
    file names of each group, which is what Spark's own file index holds there.
    """
    paths = list(paths)
    heads = first_records(spark, paths, options.skip, options.encoding, options.quote)
    heads = heads.select("path", "head", F.sha2("head", 256).alias("id"))
    distinct = heads.groupBy("id").agg(F.first("head").alias("head"), F.count("*").alias("files")).collect()
    if len(distinct) <= 1:
        return [HeaderGroup(tuple(options.split_header(r["head"])), tuple(paths), r["files"]) for r in distinct]
    members: dict[str, list[str]] = {r["id"]: [] for r in distinct}
    for row in heads.select("id", "path").collect():
        members[row["id"]].append(literal(row["path"]))
    return [
        HeaderGroup(tuple(options.split_header(r["head"])), tuple(sorted(members[r["id"]])), r["files"])
        for r in sorted(distinct, key=lambda r: r["head"])
    ]


def scan_delimited(
    spark: SparkSession,
    paths: Iterable[str],
    schema: Mapping[str, str] | None = None,
    options: Mapping[str, Any] | None = None,
    preserved: Iterable[str] = (),
    tabs: bool = False,
    hive: bool = False,
    each: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Columns by header name: STRING under a declared schema, inferred without one.

    ``each`` sees the scan of every header before they are united, where rows still know their file.

    Undeclared columns fail before anything is read. Without a header a declared
    schema names the columns by position.
    """
    opts = DelimitedOptions.of(options, tabs)
    paths = list(paths)
    if not opts.header:
        return each(_headerless(spark, paths, schema, opts, hive))
    groups = header_groups(spark, paths, opts)
    for group in groups:
        _reject_duplicates(group.columns)
        if schema:
            guard_extra_columns(group.columns, schema, preserved)
    if not groups:
        return _no_rows(spark, schema)
    # a list of files loses its partition folders unless their base is named
    base = paths[0] if hive and len(groups) > 1 else None
    return unite([each(_read_group(spark, g.columns, g.paths, opts, bool(schema), hive, base)) for g in groups])


def unite(frames: list[DataFrame]) -> DataFrame:
    """Union by name; a column met with several types gets the wider one."""
    seen: dict[str, list[T.DataType]] = {}
    for frame in frames:
        for f in frame.schema:
            seen.setdefault(f.name, []).append(f.dataType)
    target = {}
    for name, types in seen.items():
        if len(set(types)) > 1:
            target[name] = parse_type(widen_all(reported_name(t) for t in types), name)
    if target:
        frames = [
            f.select(*(col(c).cast(target[c]).alias(c) if c in target else col(c) for c in f.columns))
            for f in frames
        ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _reader(spark: SparkSession, opts: DelimitedOptions, hive: bool):
    return spark.read.options(**opts.spark).option("recursiveFileLookup", str(not hive).lower())


def _load(spark: SparkSession, reader, paths: Iterable[str]) -> DataFrame:
    targets, name_filter = read_target(spark, paths)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.csv(targets)


def _text_struct(columns: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def _read_group(
    spark, columns, paths, opts: DelimitedOptions, declared: bool, hive: bool, base: str | None = None
) -> DataFrame:
    if opts.skip:
        infer = not declared and opts.infer
        return _read_skipping(spark, columns, paths, opts, opts.skip + 1, infer, hive, base)
    reader = _reader(spark, opts, hive).option("header", "true")
    if base:
        reader = reader.option("basePath", base)
    if declared or not opts.infer:
        # enforceSchema=false makes the reader compare each file's header with the names
        reader = reader.schema(_text_struct(columns)).option("enforceSchema", "false")
    else:
        reader = reader.option("inferSchema", "true")
    return _load(spark, reader, paths)


def _headerless(spark, paths, schema, opts: DelimitedOptions, hive: bool) -> DataFrame:
    if not schema:
        reader = _reader(spark, opts, hive).option("header", "false").option("inferSchema", str(opts.infer).lower())
        return _load(spark, reader, paths)
    names = list(schema)
    for group in header_groups(spark, paths, opts):
        if len(group.columns) > len(names):
            extra = [f"column {n + 1}" for n in range(len(names), len(group.columns))]
            guard_extra_columns(extra, {}, ())
    if opts.skip:
        return _read_skipping(spark, names, paths, opts, opts.skip, False, hive)
    return _load(spark, _reader(spark, opts, hive).option("header", "false").schema(_text_struct(names)), paths)


def _read_skipping(
    spark, columns, paths, opts: DelimitedOptions, drop: int, infer: bool, hive: bool, base: str | None = None
) -> DataFrame:
    """Leave out the first lines of each file, then parse the rest line by line.

    Partition folders stay columns, and FILE_NAME tells the file of each row.
    """
    targets, name_filter = read_target(spark, paths)
    reader = spark.read.option("recursiveFileLookup", str(not hive).lower())
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    if base:
        reader = reader.option("basePath", base)
    parsed = parse_after(reader.text(targets), columns, opts, drop)
    return infer_text(parsed, columns) if infer else parsed


def parse_after(
    lines: DataFrame, columns: Iterable[str], opts: DelimitedOptions, drop: int, header: Iterable[str] | None = None
) -> DataFrame:
    """Columns of text lines, batch or stream, after the first ``drop`` lines of each file.

    With ``header``, the last of these lines has to name exactly these columns, else the task fails.
    """
    columns, expected = list(columns), None if header is None else list(header)
    folders = [c for c in lines.columns if c != "value"]
    lines = lines.select(
        "value", *(col(c) for c in folders), F.col("_metadata.file_name").alias(FILE_NAME),
        F.col("_metadata.file_path").alias("__path"), F.col("_metadata.file_block_start").alias("__block"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0  # file and block of the row before, and its lines so far
        for batch in batches:
            if not batch.num_rows:
                continue
            block = batch.column("__block").to_numpy()
            place = batch.column("__path").dictionary_encode().indices.to_numpy()
            new = np.append(True, (place[1:] != place[:-1]) | (block[1:] != block[:-1]))
            starts = np.flatnonzero(new)
            line = np.arange(len(new)) - np.repeat(starts, np.diff(np.append(starts, len(new))))
            if (batch.column("__path")[0].as_py(), block[0]) == last:
                line[: starts[1] if len(starts) > 1 else len(line)] += seen
            last, seen = (batch.column("__path")[-1].as_py(), block[-1]), int(line[-1]) + 1
            for at in np.flatnonzero((block == 0) & (line == drop - 1)) if expected is not None else ():
                found = opts.split_header(batch.column("value")[int(at)].as_py().removeprefix("\ufeff"))
                if found != expected:
                    raise ValueError(f"{batch.column('__path')[int(at)]}: header {found} instead of {expected}")
            yield batch.filter(pa.array((block > 0) | (line >= drop))).select(kept_names)

    kept_names = ["value", *folders, FILE_NAME]
    kept = lines.mapInArrow(run, lines.select(*(col(c) for c in kept_names)).schema).filter(F.trim("value") != "")
    ddl = ", ".join(f"{quoted(c)} STRING" for c in columns)
    parsed = kept.withColumn("value", F.from_csv("value", ddl, dict(opts.spark)))
    return parsed.select("value.*", *(col(c) for c in folders), FILE_NAME)


def infer_text(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Types for the text columns named: the narrowest that every value of a column fits."""
    columns = list(columns)
    kinds = ["INT", "BIGINT", "DOUBLE", "TIMESTAMP"]
    fits = df.agg(*(
        F.count_if(col(c).isNotNull() & col(c).try_cast(k).isNull()).alias(f"{c}|{k}")
        for c in columns for k in kinds
    )).first()
    chosen = {c: next((k for k in kinds if fits[f"{c}|{k}"] == 0), "STRING") for c in columns}
    return df.select(*(col(c).cast(chosen[c]).alias(c) if c in chosen else col(c) for c in df.columns))


def _reject_duplicates(columns: Iterable[str]) -> None:
    columns = list(columns)
    twice = sorted({c for c in columns if columns.count(c) > 1})
    if twice:
        raise ValueError(f"header names columns twice: {twice}")


def _no_rows(spark: SparkSession, schema: Mapping[str, str] | None) -> DataFrame:
    return spark.createDataFrame([], _text_struct(schema or {}))
