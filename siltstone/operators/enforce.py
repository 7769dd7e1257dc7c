"""Type enforcement and the small column helpers for transforms."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.text import col, strip_lower
from siltstone.functions.types import parse_type
from siltstone.spec import TypedColumn


def lenient(column: Column, dtype: T.DataType) -> Column:
    """The value in its type; NULL where it does not fit."""
    return column.try_cast(dtype)


def strict(column: Column, dtype: T.DataType) -> Column:
    """The value in its type; an error where it does not fit, whatever the ANSI setting."""
    value = column.try_cast(dtype)
    message = F.format_string(f"cannot cast '%s' to {dtype.simpleString()}", column.cast("string"))
    failed = column.isNotNull() & value.isNull()
    return F.when(failed, F.raise_error(message).cast(dtype)).otherwise(value)


def enforce_types(df: DataFrame, columns: Iterable[TypedColumn], on_fail: str = "null") -> DataFrame:
    """Give the listed columns their types in one projection; others pass through.

    ``on_fail="strict"`` makes every column strict, ``cast_mode="strict"`` a single one.
    Text columns stay as they are.
    """
    wanted = {c.name: c for c in columns}
    out = []
    for name in df.columns:
        rule = wanted.get(name)
        dtype = parse_type(rule.type, name) if rule else None
        if dtype is None or isinstance(dtype, T.StringType):
            out.append(col(name))
            continue
        cast = strict if "strict" in (on_fail, rule.cast_mode) else lenient
        out.append(cast(col(name), dtype).alias(name))
    return df.select(*out)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def cast_types(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """Cast the columns that exist; the rest of the mapping is ignored."""
    return df.withColumns({c: col(c).cast(parse_type(t, c)) for c, t in schema.items() if c in df.columns})


def clean_strings(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Strip white space and lower-case the columns that exist."""
    return df.withColumns({c: strip_lower(col(c)) for c in columns if c in df.columns})


def derive_amounts(df: DataFrame, amount: str = "amount") -> DataFrame:
    """The example transform: positive amounts, doubled and on a log scale."""
    if amount not in df.columns:
        return df
    value = col(amount)
    return df.filter(value > 0).select(
        "*",
        (value * 2).alias("amount_doubled"),
        F.when(value > -1, F.log1p(value)).otherwise(F.lit(0.0)).alias("log_amount"),
    )
