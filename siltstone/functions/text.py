"""String and file-name expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_GROUP_OPEN = re.compile(r"\(\?P<([^>]+)>")
_GROUP_REF = re.compile(r"\(\?P=([^)]+)\)")


def quoted(name: str) -> str:
    """A column name in backticks, safe inside ``F.col`` and SQL text."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def text_slice(line: Column, start: int, length: int, trim: bool = False) -> Column:
    """``length`` characters from the 0-based position ``start``."""
    piece = F.substring(line, start + 1, length)
    return F.trim(piece) if trim else piece


def strip_lower(column: Column) -> Column:
    """Lower case without leading and trailing white space of any kind."""
    return F.lower(F.regexp_replace(column, r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))


def full_match(column: Column, pattern: str) -> Column:
    """True when the whole string matches, trailing newline included."""
    return column.cast("string").rlike(rf"\A(?:{java_pattern(pattern)})\z")


def java_pattern(pattern: str) -> str:
    """Python named groups rewritten to positions, which Java always accepts."""
    index = re.compile(pattern).groupindex
    pattern = _GROUP_REF.sub(lambda m: "\\" + str(index[m.group(1)]), pattern)
    return _GROUP_OPEN.sub("(", pattern)


def group_names(pattern: str | None) -> list[str]:
    return list(re.compile(pattern).groupindex) if pattern else []


def named_groups(source: Column, pattern: str) -> dict[str, Column]:
    """One STRING column per named group; NULL where the pattern does not match."""
    java = java_pattern(pattern)
    return {
        name: F.nullif(F.regexp_extract(source, java, position), F.lit("")).alias(name)
        for name, position in re.compile(pattern).groupindex.items()
    }


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def relative_key(path: Column, root: str | None) -> Column:
    """The path below ``root``; the whole path where it lies elsewhere."""
    plain = F.regexp_replace(path, r"^file:/+", "/")
    if not root:
        return plain
    prefix = re.sub(r"^file:/+", "/", root).rstrip("/") + "/"
    return F.when(plain.startswith(prefix), F.substring(plain, len(prefix) + 1, 1 << 30)).otherwise(plain)


def partition_path(keys: list[str]) -> Column:
    """``k=v/k2=v2`` with separators and parent steps in values made harmless."""
    parts = [
        F.concat(F.lit(f"{key}="), F.regexp_replace(col(key).cast("string"), r"[/\\]|\.\.", "_"))
        for key in keys
    ]
    return F.concat_ws("/", *parts)
