"""Added columns, the undeclared-column guard and alignment to a schema."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.text import col, named_groups
from siltstone.functions.types import parse_type
from siltstone.operators.enforce import lenient, strict


#: Column of file names of rows that were parsed from lines.
NAME = "__file_name"

# Fixed value: how the error starts, for callers that look for it.
GUARD_PREFIX = "[RULE-115] Data Integrity Error"


class ExtraColumnsError(ValueError):
    """The source holds columns the schema does not declare."""


def with_literals(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    """The same value in every row, one column per entry."""
    return df.withColumns({name: F.lit(value) for name, value in values.items()}) if values else df


def with_file_groups(df: DataFrame, pattern: str | None) -> DataFrame:
    """Named groups of the source file's name as STRING columns.

    Must be applied while the frame still reads from files, or carries their names in NAME.
    """
    if not pattern:
        return df.drop(NAME)
    name = F.col(NAME) if NAME in df.columns else F.col("_metadata.file_name")
    groups = named_groups(decoded_name(name), pattern)
    return df.select(*(col(c) for c in df.columns if c not in groups and c != NAME), *groups.values())


def decoded_name(raw: Column) -> Column:
    # names come encoded like a URI; decoding is skipped where there is nothing to decode
    return F.when(raw.contains("%"), F.url_decode(F.regexp_replace(raw, r"\+", "%2B"))).otherwise(raw)


def guard_extra_columns(columns: Iterable[str], declared: Iterable[str], preserved: Iterable[str]) -> None:
    extra = set(columns) - set(declared) - set(preserved)
    if extra:
        raise ExtraColumnsError(
            f"{GUARD_PREFIX}: source has {len(extra)} columns outside the strict schema: "
            f"{sorted(extra)}. Nothing was loaded, so that no data is dropped."
        )


def align(
    df: DataFrame, schema: Mapping[str, str], preserved: Iterable[str] = (), on_fail: str = "null"
) -> DataFrame:
    """Declared columns in declared order and type, then preserved ones.

    Missing columns become typed NULLs; undeclared ones are an error. Values
    that do not fit become NULL, or fail under ``on_fail="strict"``.
    """
    if not schema:
        return df
    preserved = list(dict.fromkeys(preserved))
    guard_extra_columns(df.columns, schema, preserved)
    present = set(df.columns)
    cast = strict if on_fail == "strict" else lenient
    out = []
    for name, kind in schema.items():
        dtype = parse_type(kind, name)
        if name not in present:
            out.append(F.lit(None).cast(dtype).alias(name))
        elif df.schema[name].dataType == dtype:
            out.append(col(name))
        else:
            out.append(cast(col(name), dtype).alias(name))
    out += [col(name) for name in preserved if name in present and name not in schema]
    return df.select(*out)
