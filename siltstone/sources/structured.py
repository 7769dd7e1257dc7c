"""JSON and Parquet, with files of different columns united by name."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator, Mapping
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.text import col
from siltstone.functions.types import parse_type
from siltstone.operators.align import GUARD_PREFIX, guard_extra_columns
from siltstone.sources.delimited import unite
from siltstone.sources.files import list_files, literal, read_target
from siltstone.storage import Storage, arrow_path

#: Written beside a table's files; readers leave out names that begin so.
SCHEMA_FILE = "_written_schema.json"
NESTED = (T.StructType, T.ArrayType, T.MapType)


def scan_json(
    spark: SparkSession,
    paths: Iterable[str],
    options: Mapping[str, Any] | None = None,
    hive: bool = False,
    schema: Mapping[str, str] | None = None,
    preserved: Iterable[str] = (),
    guard: str = "before",
) -> DataFrame:
    """Objects per line, or arrays; ``multiLine`` for documents over several lines.

    Fields are inferred from all objects. Under a declared schema plain fields are read as the text they have in
    the file. ``guard``: "before" looks at all objects for undeclared fields ahead of the scan; "inline" reads the input
    once, and an undeclared field, or a line that is no object, fails the task that meets it.
    """
    given = _texts(options)
    if schema and guard == "inline":
        return _objects(spark, paths, given, hive, schema, preserved)
    targets, name_filter = read_target(spark, paths)
    reader = spark.read.option("recursiveFileLookup", str(not hive).lower())
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    reader = reader.options(**given)
    inferred = reader.json(targets)
    if not schema:
        return inferred
    guard_extra_columns(inferred.columns, schema, preserved)

    def read_as(found: T.StructField) -> T.DataType:
        if found.name not in schema:
            return found.dataType
        declared = parse_type(schema[found.name], found.name)
        return declared if isinstance(declared, NESTED) else T.StringType()

    fields = T.StructType([T.StructField(f.name, read_as(f)) for f in inferred.schema])
    return reader.schema(fields).json(targets)


def _objects(
    spark: SparkSession, paths: Iterable[str], given: Mapping[str, str], hive: bool, schema: Mapping[str, str],
    preserved: Iterable[str],
) -> DataFrame:
    """Declared fields in one scan: each object is read as a VARIANT, whose map of fields has names for the guard and texts.

    Numbers keep their value exactly up to 38 digits, but their text is the plain one (12.5 for 12.50), and nested
    values under a STRING column are compact JSON. Nested types are taken from the VARIANT. Fields that may exist beside the
    schema come as text.
    """
    targets, name_filter = read_target(spark, paths)
    reader = spark.read.options(**given).option("recursiveFileLookup", str(not hive).lower())
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    found = reader.option("singleVariantColumn", "__v").json(targets)
    folders = [c for c in found.columns if c != "__v"]
    # exploding also keeps the map from being worked out once per field
    rows = found.select(F.expr(
        "explode(transform(coalesce(try_variant_get(__v, '$', 'array<variant>'), array(__v)), "
        "x -> struct(x AS v, try_variant_get(x, '$', 'map<string,string>') AS texts)))").alias("__o"), *(col(c) for c in folders))
    texts = F.col("__o")["texts"]
    if given.get("mode", "").upper() == "DROPMALFORMED":
        rows = rows.filter(texts.isNotNull())
    beside = [n for n in dict.fromkeys(preserved) if n not in schema and n not in folders]
    extra = F.array_except(F.map_keys(texts), F.array(*(F.lit(n) for n in [*schema, *beside])))
    rows = rows.filter(
        F.when(texts.isNull(), F.raise_error(F.concat(
            F.lit(f"{GUARD_PREFIX}: not a JSON object: "), F.coalesce(F.substring(F.to_json(F.col("__o")["v"]), 1, 60), F.lit("")))))
        .when(F.size(extra) > 0, F.raise_error(F.concat(
            F.lit(f"{GUARD_PREFIX}: undeclared fields "), F.array_join(extra, ", ")))).otherwise(True))
    inside = F.try_variant_get(F.col("__o")["v"], "$", "map<string,variant>")

    def field(name: str) -> Column:
        declared = parse_type(schema[name], name) if name in schema else T.StringType()
        nested = isinstance(declared, NESTED)
        return (F.try_variant_get(inside[name], "$", declared.simpleString()) if nested else texts[name]).alias(name)

    return rows.select(*(field(n) for n in schema if n not in folders), *(field(n) for n in beside), *(col(c) for c in folders))


def scan_parquet(
    spark: SparkSession, paths: Iterable[str], options: Mapping[str, Any] | None = None, hive: bool = False,
    each: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """All columns of all files. Footers that disagree on a type are widened. ``each`` sees every scan before a union."""
    paths = list(paths)
    targets, name_filter = read_target(spark, paths)
    reader = spark.read.option("mergeSchema", "true").option("recursiveFileLookup", str(not hive).lower())
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    try:
        return each(reader.options(**_texts(options)).parquet(*targets))
    except Exception as exc:  # reported as a JVM error or as a PySpark one
        if "CANNOT_MERGE_SCHEMA" not in str(exc) or hive:
            raise
    groups = footer_groups(list_files(spark, paths))
    return unite([each(spark.read.options(**_texts(options)).parquet(*files)) for files in groups])


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A written table: columns added over time are merged, partition folders become columns.

    The schema that the writer left beside the files gives the types, so a key keeps its text (``09`` is not read as 9) and no
    footers have to be merged. Tables without one are looked at.
    """
    written = stored_schema(spark, path)
    if written is not None:
        return spark.read.schema(written).parquet(path)
    return spark.read.option("mergeSchema", "true").parquet(path)


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    text = Storage(spark).read_text(f"{path.rstrip('/')}/{SCHEMA_FILE}")
    return T.StructType.fromJson(json.loads(text)) if text else None


def store_schema(spark: SparkSession, path: str, schema: T.StructType, keys: Iterable[str] = (), beside: bool = False) -> None:
    """Leave ``schema`` (keys last, all columns nullable) with the table; ``beside`` keeps columns that were there before.

    A column that changes its type drops the stored schema, and the table is looked at as before.
    """
    keys = list(keys)
    known = stored_schema(spark, path) if beside else None
    fields = {f.name: T.StructField(f.name, f.dataType, True) for f in (known or [])}
    for f in schema:
        if f.name in fields and fields[f.name].dataType != f.dataType:
            Storage(spark).delete(f"{path.rstrip('/')}/{SCHEMA_FILE}")
            return
        fields[f.name] = T.StructField(f.name, f.dataType, True)
    ordered = [f for n, f in fields.items() if n not in keys] + [fields[k] for k in keys]
    Storage(spark).write_text(f"{path.rstrip('/')}/{SCHEMA_FILE}", T.StructType(ordered).json())


def footer_groups(files: DataFrame) -> list[list[str]]:
    """Paths by identical footer schema; footers are read on the executors."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq

        for batch in batches:
            footers = []
            for path in batch["path"]:
                fs, name = arrow_path(path)
                schema = pq.read_schema(name, filesystem=fs)
                footers.append("\n".join(f"{f.name}\t{f.type}" for f in schema))
            yield pd.DataFrame({"path": batch["path"], "footer": footers})

    footers = files.select("path").mapInPandas(run, "path string, footer string")
    groups: dict[str, list[str]] = {}
    for row in footers.select("path", F.sha2("footer", 256).alias("footer")).collect():
        groups.setdefault(row["footer"], []).append(literal(row["path"]))
    return [sorted(groups[footer]) for footer in sorted(groups)]


def _texts(options: Mapping[str, Any] | None) -> dict[str, str]:
    return {
        k: str(v).lower() if isinstance(v, bool) else str(v)
        for k, v in (options or {}).items() if v is not None
    }
