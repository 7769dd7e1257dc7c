"""Words and shingles of whole Arrow batches, and joins with tables of known size."""

from __future__ import annotations

import os

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.session import materialise
from siltstone.shipping import ship_packages

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Largest number of rows, of a few numbers each, that is sent to every executor, and of bytes where rows are wider.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 64_000_000

_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def ship(spark: SparkSession) -> None:
    """Put the package on the executors' path; once per application."""
    ship_packages(spark, ROOT, ("siltstone", "queries"))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the splitmix64 finaliser)."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def join_known(big: DataFrame, small: DataFrame, rows: int, on, how: str = "inner", size: int = 0) -> DataFrame:
    """Join with a table whose row count (and bytes) was taken: broadcast up to a bound, else shuffle (AQE splits hot keys)."""
    return big.join(F.broadcast(small) if rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES else small.hint("merge"), on, how)


def kept(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """``df`` written to the shared folder and read back, and its number of rows."""
    out = materialise(df, label)
    return out, out.count()


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string column; nulls are empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    column = pc.fill_null(pc.cast(column, pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8)[at[0]: at[-1]] if data is not None and len(at) else np.zeros(0, np.uint8)
    return raw, at - at[0] if len(at) else np.zeros(1, np.int64)


#: Bytes of text that a task turns into arrays at a time, unless one text alone is longer.
SLICE_BYTES = 4_000_000


def slices(batches, column: int):
    """The batches, cut so that the texts of ``column`` take about SLICE_BYTES each."""
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        size = pc.binary_length(pc.cast(batch.column(column), pa.large_string()))
        offsets = np.append(0, np.cumsum(pc.fill_null(size, 0).to_numpy(zero_copy_only=False)))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, side="right")) - 1)
            yield batch.slice(at, end - at)
            at = end


def byte_table(separators) -> np.ndarray:
    """Byte to byte: A-Z lower-cased, separators 0, other bytes as they are."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[list(separators)] = 0
    return table


#: Words are runs of anything but these.
BLANKS = byte_table([0x20, *range(0x09, 0x0E)])


def word_hashes(raw: np.ndarray, offsets: np.ndarray, table: np.ndarray = BLANKS) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash per word in order, and the index of each text's first word.

    A zero byte of a text counts as a letter, hence the separate mask.
    """
    letters = table[raw]
    is_word = (letters != 0) | (raw == 0)
    before = np.empty_like(is_word)
    before[1:] = is_word[:-1]
    before[offsets[:-1][offsets[:-1] < len(raw)]] = False
    begins = np.flatnonzero(is_word & ~before)
    if not len(begins):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    first = np.searchsorted(begins, offsets)
    span = np.diff(np.append(begins, len(raw)))
    place = np.arange(begins[0], len(raw)) - np.repeat(begins, span)
    powers = np.cumprod(np.full(int(span.max()) + 1, _GOLDEN | np.uint64(1), dtype=np.uint64))
    value = (letters[begins[0]:].astype(np.uint64) + np.uint64(1)) * is_word[begins[0]:]
    return mix(np.add.reduceat(value * powers[place], begins - begins[0])), first


def shingle_sets(raw, offsets, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, ascending within each text, and each text's number of them.

    A text with fewer than ``size`` words has its whole sequence as one shingle, one without words none.
    """
    words, first = word_hashes(raw, offsets)
    n_docs, count = len(offsets) - 1, np.diff(first)
    per_doc = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    doc = np.repeat(np.arange(n_docs), per_doc)
    start = np.arange(len(doc)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc) + np.repeat(first[:-1], per_doc)
    length = np.minimum(np.repeat(count, per_doc), size)
    total = length.astype(np.uint64)
    for k in range(size):
        inside = length > k
        word = np.where(inside, words[np.minimum(start + k, max(0, len(words) - 1))], np.uint64(0)) if len(words) else total
        total = mix(total * _GOLDEN + word)
    order = np.lexsort((total, doc))
    total, doc = total[order], doc[order]
    new = np.ones(len(total), bool)
    new[1:] = (total[1:] != total[:-1]) | (doc[1:] != doc[:-1])
    return total[new], np.bincount(doc[new], minlength=n_docs)
