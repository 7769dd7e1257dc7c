"""Files grouped by the partition their names place them in."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.text import col, named_groups, partition_path
from siltstone.operators.digest import ordered_digest


def with_partition_values(files: DataFrame, pattern: str, keys: Iterable[str], name: str = "file_name") -> DataFrame:
    """The listing with one STRING column per key; all NULL where the name does not match."""
    groups = named_groups(col(name), pattern)
    keys = list(keys)
    matched = F.lit(True)
    for key in keys:
        matched &= groups[key].isNotNull() if key in groups else F.lit(False)
    values = {k: F.when(matched, groups[k]) if k in groups else F.lit(None).cast("string") for k in keys}
    return files.withColumns(values)


def unmatched(files: DataFrame, keys: list[str]) -> DataFrame:
    return files.filter(col(keys[0]).isNull())


def partition_batches(files: DataFrame, keys: list[str], table: str, path: str = "path") -> DataFrame:
    """One row per partition: keys, sub-path, number of files and a batch id.

    The id follows from table, partition and the set of file paths, whatever
    order they come in. Member lists are not gathered: the listing keeps one row
    per file and joins on the keys.
    """
    placed = files.filter(col(keys[0]).isNotNull())
    digests = ordered_digest(placed, keys, path, "\n")
    sub_path = partition_path(keys)
    return digests.select(
        *(col(k) for k in keys),
        sub_path.alias("partition"),
        F.col("rows").alias("file_count"),
        batch_id(table, sub_path, F.col("digest")).alias("batch_id"),
    )


def batch_id(table: str, partition: Column, digest: Column) -> Column:
    safe = F.translate(partition, "/=", "_-")
    return F.concat_ws("_", F.lit(table), safe, F.substring(digest, 1, 8))


def combined_hash(files: DataFrame, keys: list[str], fingerprint: str = "fingerprint") -> DataFrame:
    """(keys…, combined_hash): one short hash per set of file fingerprints."""
    known = files.filter(col(fingerprint).isNotNull() & (col(fingerprint) != ""))
    digests = ordered_digest(known, keys, fingerprint, "")
    return digests.select(*(col(k) for k in keys), F.substring("digest", 1, 16).alias("combined_hash"))
