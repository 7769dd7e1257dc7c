"""Fixed-width text: one record per line, columns by position."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.text import text_slice
from siltstone.sources.files import read_target
from siltstone.spec import FixedWidthSpec

SAMPLE_LINES = 3
SAMPLE_CHARS = 50


class ShortLineError(ValueError):
    """A line ends before the last declared column does."""


def read_lines(spark: SparkSession, paths: Iterable[str], hive: bool = False) -> DataFrame:
    targets, name_filter = read_target(spark, paths)
    reader = spark.read.option("recursiveFileLookup", str(not hive).lower())
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.text(targets)


def select_records(lines: DataFrame, spec: FixedWidthSpec) -> DataFrame:
    """Keep the wanted record type, then drop lines declared too short to count."""
    value = F.col("value")
    if spec.record_filter:
        wanted = spec.record_filter
        lines = lines.filter(F.substring(value, wanted.position + 1, wanted.length) == wanted.value)
    if spec.min_line_length:
        lines = lines.filter(F.length(value) >= spec.min_line_length)
    return lines


def guarded_line(line: Column, needed: int) -> Column:
    """The line itself, or an error at execution when it is too short.

    The test rides in the scan that reads the data, so every line is checked and
    nothing is read twice.
    """
    message = F.format_string(
        f"data integrity: line of %d characters, {needed} needed: '%s'",
        F.length(line), F.substring(line, 1, SAMPLE_CHARS),
    )
    return F.when(F.length(line) >= needed, line).otherwise(F.raise_error(message))


def check_lines(lines: DataFrame, needed: int, sample_rows: int | None = None) -> None:
    """Raise before any work, naming a few short lines; optionally look at a sample only."""
    value = F.col("value")
    looked_at = lines.limit(sample_rows) if sample_rows else lines
    short = (
        looked_at.filter(F.length(value) < needed)
        .select(F.length(value).alias("len"), F.substring(value, 1, SAMPLE_CHARS).alias("text"))
        .limit(SAMPLE_LINES)
        .collect()
    )
    if short:
        samples = "; ".join(f"len={r['len']}: '{r['text']}'" for r in short)
        raise ShortLineError(f"data integrity: lines shorter than {needed} characters. Samples: {samples}")


def scan_fixed_width(
    spark: SparkSession,
    paths: Iterable[str],
    spec: FixedWidthSpec,
    guard: str = "inline",
    sample_rows: int | None = None,
    hive: bool = False,
) -> DataFrame:
    """All declared columns as STRING.

    ``guard``: "inline" fails while reading, "before" fails ahead of it (a scan
    of its own, over ``sample_rows`` lines when given).
    """
    lines = select_records(read_lines(spark, paths, hive), spec)
    if guard == "before":
        check_lines(lines, spec.line_length, sample_rows)
    line = guarded_line(F.col("value"), spec.line_length)
    others = [F.col(c) for c in lines.columns if c != "value"]
    cut = [text_slice(F.col("value"), p.start, p.length, p.trim).alias(p.name) for p in spec.columns]
    return lines.select(line.alias("value"), *others).select(*cut, *others)
