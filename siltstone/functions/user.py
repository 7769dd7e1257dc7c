"""The surface on which user code meets the data."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.operators.enforce import cast_types, clean_strings, rename_columns

# Slow items of one job share this many tasks at most.
MOST_TASKS = 10_000

Transform = Callable[[DataFrame], DataFrame]


def apply_transforms(df: DataFrame, *transforms: Transform | None) -> DataFrame:
    """Apply the first transform given: a table's own one comes before a global one.

    A transform is a function of a frame, or a class built with the frame whose
    ``transform()`` returns the new one.
    """
    for transform in transforms:
        if transform is None:
            continue
        made = transform(df)
        result = made if isinstance(made, DataFrame) else made.transform()
        if not isinstance(result, DataFrame):
            raise TypeError(f"transform returned {type(result).__name__}, not a DataFrame")
        return result
    return df


class TableTransform:
    """A transform as a class: override ``transform``, starting from ``self.df``."""

    def __init__(self, df: DataFrame):
        self.df = df

    def transform(self) -> DataFrame:
        return self.df

    def rename_columns(self, mapping: Mapping[str, str]) -> TableTransform:
        self.df = rename_columns(self.df, mapping)
        return self

    def cast_types(self, schema: Mapping[str, str]) -> TableTransform:
        self.df = cast_types(self.df, schema)
        return self

    def clean_strings(self, columns: Iterable[str]) -> TableTransform:
        self.df = clean_strings(self.df, columns)
        return self


def vectorised(fn: Callable[[pd.Series], pd.Series], returns: str | T.DataType) -> Callable[..., Column]:
    """A user function over whole Arrow batches, callable on columns."""
    return F.pandas_udf(fn, returns)


def log_plus_one(values: pd.Series) -> pd.Series:
    """``ln(x + 1)``; 0 where it is undefined or x is missing."""
    x = values.to_numpy(dtype=float, na_value=np.nan)
    defined = x > -1
    return pd.Series(np.where(defined, np.log1p(np.where(defined, x, 0.0)), 0.0), index=values.index)


def map_items(
    items: DataFrame,
    column: str,
    fn: Callable[[object], object],
    returns: str = "string",
    spread: bool = False,
) -> DataFrame:
    """Call ``fn`` on every value of ``column`` on the executors.

    The result keeps the item, the returned value and the error text of a call
    that failed, so one bad item does not lose the others. ``spread`` gives slow
    calls a task each.
    """
    dtype = T.DataType.fromDDL(returns) if isinstance(returns, str) else returns
    item = items.schema[column]
    schema = T.StructType([
        T.StructField(column, item.dataType),
        T.StructField("result", dtype),
        T.StructField("error", T.StringType()),
    ])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for value in batch[column]:
                try:
                    rows.append((value, fn(value), None))
                except Exception as exc:  # reported per item
                    rows.append((value, None, f"{type(exc).__name__}: {exc}"))
            # object columns: a missing result must not turn whole numbers into floats
            yield pd.DataFrame(rows, columns=[column, "result", "error"], dtype=object)

    chosen = items.select(column)
    return (one_task_each(chosen) if spread else chosen).mapInPandas(run, schema)


def one_task_each(items: DataFrame, most: int = MOST_TASKS) -> DataFrame:
    """Few rows that stand for much work, dealt out evenly.

    The number is explicit, because adaptive execution would merge partitions
    that hold few bytes.
    """
    return items.repartition(max(1, min(items.count(), most)))
