"""Digests over ordered sets: one hash per key over its sorted values."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions.text import col

CHUNK_CHARS = 1 << 20


def ordered_digest(df: DataFrame, keys: list[str], value: str, separator: str) -> DataFrame:
    """(keys…, rows, digest): SHA-256 of each key's values, sorted and joined.

    The hash of a group has to see its values in order. Sorting is spread by
    ranges of (keys, value), so a key with much of the data is sorted by many
    tasks. Each hands on chunks of joined text, and a group's chunks stream
    through its hash; no task holds a group.
    """
    rows = df.select(*(col(k).cast("string").alias(k) for k in keys), col(value).cast("string").alias("value"))
    order = [*(col(k) for k in keys), F.col("value")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    key_ddl = "".join(f"`{k}` string, " for k in keys)
    width = len(keys)

    def chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            lists = [batch[k].tolist() for k in keys]
            tuples = list(zip(*lists)) if keys else [()] * len(batch)
            values = batch["value"].tolist()
            for key, run in groupby(range(len(values)), key=tuples.__getitem__):
                part: list[str] = []
                size = 0
                for i in run:
                    part.append(values[i])
                    size += len(values[i])
                    if size >= CHUNK_CHARS:
                        out.append((*key, part[0], part[-1], len(part), separator.join(part)))
                        part, size = [], 0
                if part:
                    out.append((*key, part[0], part[-1], len(part), separator.join(part)))
            yield pd.DataFrame(out, columns=[*keys, "first", "last", "rows", "part"])

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state, total = None, None, 0
        for batch in batches:
            out = []
            for record in batch.itertuples(index=False, name=None):
                key, count, part = record[:width], record[-2], record[-1]
                if state is None or key != current:
                    if state is not None:
                        out.append((*current, total, state.hexdigest()))
                    current, state, total = key, hashlib.sha256(), 0
                elif separator:
                    state.update(separator.encode())
                state.update(part.encode())
                total += count
            yield pd.DataFrame(out, columns=[*keys, "rows", "digest"])
        if state is not None:
            yield pd.DataFrame([(*current, total, state.hexdigest())], columns=[*keys, "rows", "digest"])

    parts = ranged.mapInPandas(chunks, f"{key_ddl}first string, last string, rows long, part string")
    grouped = parts.repartition(*(col(k) for k in keys)) if keys else parts.repartition(1)
    placed = grouped.sortWithinPartitions(*(col(k) for k in keys), "first", "last")
    return placed.mapInPandas(fold, f"{key_ddl}rows long, digest string")
