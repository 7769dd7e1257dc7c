"""siltstone: raw files to checked, typed, partitioned tables, as Spark DataFrames."""

from siltstone.spec import DatasetSpec, FixedWidthSpec, SpecError, TableSpec

__all__ = ["DatasetSpec", "FixedWidthSpec", "SpecError", "TableSpec"]
