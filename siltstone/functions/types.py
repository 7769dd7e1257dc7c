"""Declared type names, reported type names and widening."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import types as T

# Accepted names of declared types.
DECLARED = {
    "STRING": T.StringType(),
    "VARCHAR": T.StringType(),
    "INTEGER": T.IntegerType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "LONG": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "FLOAT": T.FloatType(),
    "BOOLEAN": T.BooleanType(),
    "BOOL": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
    "DECIMAL": T.DecimalType(18, 3),
}

# Numeric widening order; STRING can hold everything.
WIDENING = ["BOOLEAN", "INTEGER", "BIGINT", "FLOAT", "DOUBLE", "STRING"]
TEMPORAL = ["DATE", "TIMESTAMP"]

_SIZED_TEXT = re.compile(r"^(VARCHAR|CHAR)\s*\(\s*\d+\s*\)$")


def parse_type(name: str, column: str = "?") -> T.DataType:
    """The Spark type for a declared name; any Spark DDL type is accepted as well."""
    upper = str(name).strip().upper()
    if upper in DECLARED:
        return DECLARED[upper]
    if _SIZED_TEXT.match(upper):
        return T.StringType()
    try:
        return T.DataType.fromDDL(upper if "<" not in upper else str(name))
    except Exception as exc:
        raise ValueError(f"column '{column}': unknown type '{name}'") from exc


def is_text(name: str) -> bool:
    return isinstance(parse_type(name), T.StringType)


def reported_name(dtype: T.DataType) -> str:
    """The coarse name used in discovered schemas."""
    names = {
        T.BooleanType: "BOOLEAN",
        T.ByteType: "INTEGER",
        T.ShortType: "INTEGER",
        T.IntegerType: "INTEGER",
        T.LongType: "BIGINT",
        T.FloatType: "FLOAT",
        T.DoubleType: "DOUBLE",
        T.DecimalType: "DOUBLE",
        T.DateType: "DATE",
        T.TimestampType: "TIMESTAMP",
        T.TimestampNTZType: "TIMESTAMP",
    }
    return names.get(type(dtype), "STRING")


def widen(left: str, right: str) -> str:
    """The narrowest reported name that can hold values of both."""
    left, right = (left or "STRING").upper(), (right or "STRING").upper()
    if left == right:
        return left
    for order in (WIDENING, TEMPORAL):
        if left in order and right in order:
            return order[max(order.index(left), order.index(right))]
    return "STRING"


def widen_all(names) -> str:
    return reduce(widen, names)
