"""Short codes for vectors: one codebook per part of the vector, searched by slicing and intersecting bitmasks.

A vector is cut into parts, and each part is known by the number of its nearest codebook entry. The search keeps, for
each dimension of a part, the entries' coordinates in order and, for each place in that order, a bitmask (uint64 words)
of the entries before it. A radius selects a range of places per dimension; two masks give the entries of the range, and
the masks of all dimensions are ANDed. What is left lies in a box around the vector, so it holds every entry within
the radius, ties included; exact distances decide among them. The radius starts as the distance to the entry of the
round before, or as the usual distance between entries; where the best entry found lies beyond it, it grows to that
entry's distance and the box is searched again, so every answer is exact.

A round is one pass over a table of integer vectors and one small aggregation of sums; the codebooks (entries x
components) are the only thing that the driver holds.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import join_known, kept, ship
from siltstone.llm.vectors import finite, integers, joined, lists, matrix, sums
from siltstone.session import materialise

#: Fixed values of the contract: scale of the integers, parts, entries of a codebook, rounds.
SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Candidates whose distances are worked out at a time.
BLOCK = 1 << 18


@dataclass
class Slices:
    """Entries of one codebook, their coordinates in order per dimension, and the masks of the entries before each place."""

    entries: np.ndarray
    ordered: np.ndarray
    masks: np.ndarray
    radius: int

    @classmethod
    def of(cls, entries: np.ndarray) -> Slices:
        n, width = entries.shape
        order = np.argsort(entries, axis=0, kind="stable").T
        masks = np.zeros((width, n + 1, -(-n // 64)), dtype=np.uint64)
        bits = np.uint64(1) << (order % 64).astype(np.uint64)
        for at in range(n):
            masks[:, at + 1] = masks[:, at]
            masks[np.arange(width), at + 1, order[:, at] // 64] |= bits[:, at]
        gaps = [int(((entries - one) ** 2).sum(axis=1)[np.arange(n) != at].min()) for at, one in enumerate(entries) if n > 1]
        return cls(entries, np.sort(entries, axis=0).T.copy(), masks, int(np.median(gaps)) if gaps else 0)

    def box(self, points: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks of the entries that differ from each point by ``radius`` at most in every dimension."""
        found = None
        for axis, places in enumerate(self.ordered):
            low = np.searchsorted(places, points[:, axis] - radius, side="left")
            high = np.searchsorted(places, points[:, axis] + radius, side="right")
            inside = self.masks[axis][high] & ~self.masks[axis][low]
            found = inside if found is None else found & inside
        return found

    def nearest(self, points: np.ndarray, guess: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) per point; of entries equally near, the lower one."""
        best = np.zeros(len(points), dtype=np.int64)
        best2 = np.full(len(points), np.iinfo(np.int64).max)
        start = np.full(len(points), self.radius) if guess is None else ((points - self.entries[guess]) ** 2).sum(axis=1)
        radius = np.sqrt(start.astype(np.float64)).astype(np.int64) + 1
        todo = np.arange(len(points))
        while len(todo):
            for at in range(0, len(todo), max(1, BLOCK // len(self.entries))):
                rows = todo[at: at + max(1, BLOCK // len(self.entries))]
                self._search(points, rows, radius, best, best2)
            far = best2[todo] > radius[todo] ** 2
            todo = todo[far]
            found = best2[todo] < np.iinfo(np.int64).max
            wider = np.sqrt(np.where(found, best2[todo], 0).astype(np.float64)).astype(np.int64) + 1
            radius[todo] = np.where(found, wider, 2 * radius[todo])
        return best, best2

    def _search(self, points, rows, radius, best, best2) -> None:
        """Fill in the best entry within each row's box, where the box holds any."""
        masks = self.box(points[rows], radius[rows])
        bits = np.unpackbits(masks.view(np.uint8), axis=1, bitorder="little")[:, :len(self.entries)]
        of, entry = np.nonzero(bits)
        if not len(of):
            return
        off = points[rows[of]] - self.entries[entry]
        far = np.einsum("ij,ij->i", off, off)
        first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        least = np.minimum.reduceat(far, first)
        hit = np.flatnonzero(far == np.repeat(least, np.diff(np.append(first, len(of)))))
        hit = hit[np.append(True, of[hit][1:] != of[hit][:-1])]
        best[rows[of[first]]], best2[rows[of[first]]] = entry[hit], least


def _assign(state: DataFrame, books: list[np.ndarray], width: int, guessed: bool) -> DataFrame:
    """``state`` with each part's nearest entry and the squared distance summed over parts."""
    entries = [book.tolist() for book in books]

    def assign(batches):
        import pyarrow as pa

        slices = [Slices.of(np.array(book, dtype=np.int64)) for book in entries]
        for batch in batches:
            whole = matrix(batch.column("q"), width * len(slices))
            before = matrix(batch.column("codes"), len(slices)) if guessed else None
            answers = [s.nearest(whole[:, at * width: (at + 1) * width], before[:, at] if guessed else None)
                       for at, s in enumerate(slices)]
            codes = np.stack([a[0] for a in answers], axis=1).astype(np.int16)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), batch.column("q"), lists(codes, pa.int16()),
                 pa.array(sum(a[1] for a in answers), type=pa.int64())], ["vec_id", "label", "q", "codes", "error"])

    kinds = {f.name: f.dataType.simpleString() for f in state.schema}
    return state.mapInArrow(
        assign, f"vec_id {kinds['vec_id']}, label {kinds['label']}, q array<int>, codes array<smallint>, error bigint")


def _moved(state: DataFrame, books: list[np.ndarray], width: int) -> list[np.ndarray]:
    """Codebooks whose used entries are the floored means of their parts; unused entries stay."""
    each = F.explode(F.array(*(F.struct(
        F.lit(part).alias("part"), F.get("codes", part).alias("code"),
        F.slice("q", part * width + 1, width).alias("x")) for part in range(len(books))))).alias("one")
    out = [book.copy() for book in books]
    for row in sums(state.select(each).select("one.*"), ["part", "code"], "x", width):
        out[row["part"]][row["code"]] = np.array(row["total"], dtype=np.int64) // row["n"]
    return out


@dataclass
class Coded:
    """Rows (vec_id, label, q, codes, error), codebooks, and rows (vec_id, label) of vectors that have no code."""

    rows: DataFrame
    books: list[np.ndarray]
    without: DataFrame

    def digest(self) -> str:
        """sha256 of all entries' components by codebook, entry and place."""
        return hashlib.sha256(joined(x for book in self.books for x in book.reshape(-1)).encode()).hexdigest()


def fit_codes(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
    scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> Coded:
    """Fit codebooks to all vectors and encode them.

    Vectors that are null or hold null or non-finite components are dropped. The most common length that ``parts``
    divide (of several, the smallest) is coded; vectors of other lengths, and those with a component whose integer is beyond
    2**27 (their squared distances need not fit in 64 bits), have no code and take no part in the codebooks. Rows whose
    ids repeat are vectors of their own; null ids come last, rows with one id in the order of their components.
    With fewer vectors than entries the codebooks are shorter; an empty table gives empty codebooks.
    """
    ship(vectors.sparkSession)
    vector = F.col(vector_column)
    rows = vectors.where(finite(vector)).select(
        F.col(id_column).alias("vec_id"), F.col(label_column).alias("label"), integers(vector, scale).alias("q"))
    lengths = rows.where(F.size("q") % parts == 0).where(F.size("q") > 0).groupBy(F.size("q").alias("length")).count()
    common = lengths.orderBy(F.desc("count"), "length").first()
    width = common["length"] // parts if common else 0
    codable = F.coalesce(F.size("q") == width * parts, F.lit(False)) & F.lit(width > 0)
    source = rows.where(codable)
    first = source.orderBy(F.col("vec_id").asc_nulls_last(), "q").limit(entries).select("q").collect()
    start = np.array([r["q"] for r in first], dtype=np.int64).reshape(len(first), width * parts)
    books = [start[:, at * width: (at + 1) * width].copy() for at in range(parts)]
    without = rows.where(~codable).select("vec_id", "label")
    if not first:
        none = source.select("*", F.lit(None).cast("array<smallint>").alias("codes"), F.lit(0).cast("bigint").alias("error"))
        return Coded(none, books, without)
    state = materialise(_assign(source, books, width, False), "codes")
    for _ in range(rounds):
        books = _moved(state, books, width)
        state = materialise(_assign(state, books, width, True), "codes")
    return Coded(state, books, without)


def vector_codes(vectors: DataFrame, **settings) -> DataFrame:
    """Per vector that is not dropped: vec_id, code, error, label_error and codebooks_sha256; settings as in fit_codes.

    ``code`` holds two hex digits per part. Vectors without a code have a null code and error and add nothing to their
    label's sum. Null labels form one group. Extra columns of the input are left out.
    """
    coded = fit_codes(vectors, **settings)
    digits = F.concat(*(F.lpad(F.lower(F.hex(F.get("codes", part))), 2, "0") for part in range(len(coded.books))))
    rows = coded.rows.select("vec_id", "label", digits.alias("code"), "error").unionByName(coded.without.select(
        "vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("bigint").alias("error")))
    labels, n_labels = kept(rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "labels")
    return join_known(rows, labels, n_labels, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(coded.digest()).alias("codebooks_sha256"))
