"""Schema discovery: every column of every file, types from a sample."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from siltstone.functions.text import group_names
from siltstone.functions.types import reported_name
from siltstone.operators.align import NAME
from siltstone.sources.delimited import DelimitedOptions, infer_text, scan_delimited
from siltstone.sources.files import first_records, list_files, literal, sample_rows
from siltstone.sources.structured import scan_json, scan_parquet
from siltstone.spec import FixedWidthSpec

SCHEMA_TABLE = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("spark_type", T.StringType()),
])


def discover_schema(
    spark: SparkSession,
    paths: Iterable[str],
    file_format: str = "csv",
    options: Mapping[str, Any] | None = None,
    sampling_ratio: float = 1.0,
    sample_files: int | None = None,
    rows: int | None = None,
    naming_pattern: str | None = None,
    partition_by: Iterable[str] = (),
    fixed_width: FixedWidthSpec | None = None,
) -> dict[str, tuple[str, str]]:
    """column → (reported type, Spark type), sorted by column name.

    Types come from all files; ``sample_files`` may limit them to so many, and ``rows`` to the first rows of each of these, at
    the caller's risk: then the bytes read do not depend on the size of the files.

    Columns taken from file names and partition folders are added as STRING.
    """
    if file_format in ("csv", "tsv", "tab"):
        found = _delimited(spark, list(paths), options, file_format != "csv", sampling_ratio, sample_files, rows)
    elif file_format == "json":
        ratio = {"samplingRatio": sampling_ratio} if sampling_ratio < 1 else {}
        found = _of(scan_json(spark, paths, {**(options or {}), **ratio}).schema)
    elif file_format == "parquet":
        found = _of(scan_parquet(spark, paths, options).schema)
    elif file_format == "fixed_width" and fixed_width:
        found = {p.name: (p.type, p.type.lower()) for p in fixed_width.columns}
    else:
        raise ValueError(f"cannot discover the schema of format '{file_format}'")
    if not found:
        raise ValueError(f"no columns found in {list(paths)}")
    out = dict(sorted(found.items()))
    for name in [*group_names(naming_pattern), *partition_by]:
        out.setdefault(name, ("STRING", "string"))
    return out


def _of(schema: T.StructType) -> dict[str, tuple[str, str]]:
    return {f.name: (reported_name(f.dataType), f.dataType.simpleString()) for f in schema}


def _delimited(
    spark: SparkSession, paths: list[str], options, tabs: bool, sampling_ratio: float, sample_files: int | None,
    rows: int | None,
) -> dict[str, tuple[str, str]]:
    opts = DelimitedOptions.of(options, tabs)
    ratio = {"samplingRatio": sampling_ratio} if sampling_ratio < 1 else {}
    if list_files(spark, paths).isEmpty():
        raise ValueError(f"no files found in {paths}")
    if sample_files is None:
        return _of(scan_delimited(spark, paths, options={**(options or {}), **ratio}, tabs=tabs).drop(NAME).schema)
    heads = first_records(spark, paths, opts.skip, opts.encoding, opts.quote)
    # one row per distinct header, with the first file that carries it
    headers = {
        row["head"]: row["first_path"]
        for row in heads.groupBy("head").agg(F.min("path").alias("first_path")).collect()
    }
    sources: dict[str, str] = {}
    columns_of: dict[str, list[str]] = {}
    for head, path in sorted(headers.items(), key=lambda item: item[1]):
        columns_of[path] = opts.split_header(head)
        for name in columns_of[path]:
            sources.setdefault(name, path)
    required: set[str] = set()
    covered: set[str] = set()
    for name in sorted(sources):
        if name not in covered:
            required.add(sources[name])
            covered.update(columns_of[sources[name]])
    first_files = heads.orderBy("path").select("path").limit(sample_files + len(required)).collect()
    spare = [r["path"] for r in first_files if r["path"] not in required]
    sample = sorted(required) + spare[:max(0, sample_files - len(required))]
    if rows is None:
        typed = scan_delimited(spark, sorted(map(literal, sample)), options={**(options or {}), **ratio}, tabs=tabs)
    else:
        texts = {**(options or {}), "inferSchema": False}
        first = sample_rows(lambda p: scan_delimited(spark, [p], options=texts, tabs=tabs).drop(NAME), sample, rows)
        typed = infer_text(first, first.columns)
    found = _of(typed.drop(NAME).schema)
    return {name: found.get(name, ("STRING", "string")) for name in sources}


def discover_folder(spark: SparkSession, path: str, file_format: str) -> tuple[list[str], dict[str, tuple[str, str]]]:
    """Partition keys read off ``k=v`` folders, and the other columns."""
    scans = {
        "csv": lambda: scan_delimited(spark, [path], hive=True),
        "tsv": lambda: scan_delimited(spark, [path], tabs=True, hive=True),
        "json": lambda: scan_json(spark, [path], hive=True),
        "parquet": lambda: scan_parquet(spark, [path], hive=True),
    }
    schema = scans[file_format]().schema
    relative = F.substring(F.regexp_replace("path", r"^file:/+", "/"), len(path.rstrip("/")) + 2, 1 << 20)
    listing = list_files(spark, [path]).select(F.explode(F.split(relative, "/")).alias("step"))
    steps = listing.filter(F.col("step").contains("=")).select(F.substring_index("step", "=", 1).alias("key")).distinct()
    folder_keys = {r["key"] for r in steps.collect()}
    keys = [f.name for f in schema if f.name in folder_keys]
    return keys, {n: t for n, t in _of(schema).items() if n not in keys}


def schema_rows(spark: SparkSession, table: str, found: Mapping[str, tuple[str, str]]) -> DataFrame:
    """The discovered schema as a table: one row per column."""
    return spark.createDataFrame([(table, n, *t) for n, t in found.items()], SCHEMA_TABLE)


def rows_per_file(df: DataFrame, rows: int) -> DataFrame:
    """The first rows of every file, in file order.

    Each task passes on at most ``rows`` rows of a file, so the shuffle does not
    depend on how large a file is.
    """
    file = F.col("_metadata.file_path").alias("__file")
    block = F.col("_metadata.file_block_start").alias("__block")
    tagged = df.select("*", file, block, F.monotonically_increasing_id().alias("__id"))
    order = W.partitionBy("__file").orderBy("__block", "__id")
    ranked = tagged.withColumn("__row", F.row_number().over(order)).filter(F.col("__row") <= rows)
    return ranked.drop("__file", "__block", "__id", "__row")
