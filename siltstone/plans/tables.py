"""From a table declaration to one lazy DataFrame."""

from __future__ import annotations

import dataclasses
import posixpath
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.text import base_name, named_groups
from siltstone.functions.user import map_items
from siltstone.operators.align import align, with_file_groups, with_literals
from siltstone.session import materialise, scratch_path
from siltstone.sources.archives import archive_files, unpack
from siltstone.sources.delimited import scan_delimited
from siltstone.sources.files import list_files, literal
from siltstone.sources.fixed_width import scan_fixed_width
from siltstone.sources.structured import scan_json, scan_parquet
from siltstone.spec import MEMBER_GLOBS, TableSpec
from siltstone.storage import Storage, file_name


def scan(spark: SparkSession, table: TableSpec, paths: Iterable[str] | None = None, guard: str = "before") -> DataFrame:
    """The columns of a table's files, and those that their names give; ``guard`` as in scan_json."""

    def each(df: DataFrame) -> DataFrame:
        return with_file_groups(df, table.naming_pattern)

    paths = list(paths if paths is not None else table.paths)
    hive, options = table.hive_partitioning, table.read_options
    if table.format in ("csv", "tsv", "tab"):
        tabs = table.format != "csv"
        return scan_delimited(spark, paths, table.schema, options, table.preserved, tabs, hive, each)
    if table.format == "json":
        return each(scan_json(spark, paths, options, hive, table.schema, table.preserved, guard))
    if table.format == "parquet":
        return scan_parquet(spark, paths, options, hive, each)
    # read options of fixed-width tables: where short lines are looked for, and in how many lines
    how = {"guard": str((options or {}).get("guard", "inline")), "sample_rows": (options or {}).get("sample_rows")}
    return each(scan_fixed_width(spark, paths, table.fixed_width, **how, hive=hive))


def plan(
    spark: SparkSession, table: TableSpec, paths: Iterable[str] | None = None, keys: Iterable[str] = (),
    guard: str = "before",
) -> DataFrame:
    """scan, columns from file names, literals, guard and alignment.

    No job runs for a declared schema beyond reading file heads, except for JSON under ``guard="before"``.
    """
    paths = list(paths if paths is not None else table.paths)
    df = with_literals(scan(spark, table, paths, guard), table.metadata)
    schema = table.schema
    if not schema:
        return df
    missing = [k for k in keys if k not in table.preserved]
    return align(df, schema, [*table.preserved, *missing], table.type_enforcement.get("on_fail", "null"))


def resolve_inputs(
    spark: SparkSession, table: TableSpec, scratch: str | None = None, sources: list[str] | None = None
) -> list[str]:
    """Paths to read: as declared, unpacked from archives, or made by a preprocess function.

    ``sources`` may name a part of the archives or files to start from.
    """
    if table.archives:
        target = scratch or scratch_path(spark, f"unpacked-{table.name}")
        members = unpack(archive_files(spark, sources or table.archive_paths), target, table.files)
        # counting runs the copies; the list of members stays on the executors
        if not members.count() and not (sources and Storage(spark).exists(target)):
            raise ValueError(f"table '{table.name}': no member matches '{table.files}'")
        return [target]
    if table.preprocess:
        target = scratch or scratch_path(spark, f"preprocessed-{table.name}")
        return preprocess_files(spark, table, target, sources)
    return table.paths


def preprocess_files(spark: SparkSession, table: TableSpec, target: str, sources: list[str] | None = None) -> list[str]:
    """Run the table's function on every file, on executors: ``fn(path, output_folder, **preprocess_options)``.

    It returns the path it made. Results below the output folder are read by the
    format's extension; any failed file fails the table.
    """
    fn, options = table.preprocess, dict(table.preprocess_options)

    def one(path: str) -> str:
        name = posixpath.splitext(file_name(path))[0]
        plain = path.removeprefix("file:")
        return str(fn(plain, f"{target.removeprefix('file:')}/{name}", **options))

    files = list_files(spark, sources or table.paths)
    # written once, so that looking at the results does not run the function again
    done = materialise(map_items(files, "path", one, spread=True), f"results-{table.name}")
    failed = done.filter(F.col("error").isNotNull()).limit(3).collect()
    if failed:
        raise RuntimeError("; ".join(f"{r['path']}: {r['error']}" for r in failed))
    inside = F.col("result").startswith(target.removeprefix("file:"))
    paths = sorted(literal(r["result"]) for r in done.filter(~inside).select("result").distinct().collect())
    inside = not done.filter(inside).isEmpty()
    return (made_paths(table, target) if inside else []) + paths


def made_paths(table: TableSpec, target: str) -> list[str]:
    """What to read below the folder that archives or a preprocess function filled."""
    wanted = MEMBER_GLOBS.get(table.format) if table.preprocess else None
    return [f"{target}/**/{wanted}" if wanted else target]


def expand(spark: SparkSession, table: TableSpec) -> list[TableSpec]:
    """One table per matching file, with the groups of its file name as metadata.

    Without ``expand_glob`` the table stays whole.
    """
    if not table.expand_glob or table.hive_partitioning:
        return [table]
    files = list_files(spark, table.paths).select("path", base_name(F.col("path")).alias("file"))
    groups = named_groups(F.col("file"), table.naming_pattern) if table.naming_pattern else {}
    out, made = [], {}
    # one declaration per file: they live on the driver like all declarations
    for row in files.select("path", "file", *groups.values()).orderBy("path").collect():
        metadata = {g: row[g] for g in groups if row[g] is not None}
        stem = posixpath.splitext(row["file"])[0]
        name = "".join(c if c.isalnum() else "_" for c in f"{table.name}_{stem}")
        if name in made:
            raise ValueError(f"files {made[name]} and {row['path']} both give the table name '{name}'")
        made[name] = row["path"]
        out.append(dataclasses.replace(
            table, name=name, path=literal(row["path"]), root=None, expand_glob=False,
            naming_pattern=None, metadata={**table.metadata, **metadata},
        ))
    return out


def inventory(spark: SparkSession, table: TableSpec) -> DataFrame:
    """The files a run of the table would read; nothing is opened."""
    paths = table.archive_paths if table.archives else table.paths
    return list_files(spark, paths).select(F.lit(table.name).alias("table_name"), "path", "length", "modified")
