"""Language of a text by prediction by partial matching.

Each language has a tree of byte contexts up to ORDER bytes long, with the counts of the bytes that followed. A byte is
coded in its longest known context, or, where it never followed there, after an escape in the next shorter one, and at last
among all bytes that no context knows. An escape is as likely as there are distinct bytes in its context (method C), and
bytes that a longer context would have coded are excluded from the shorter ones, and a context that every byte has followed has
no escape, so the probabilities of all bytes sum to one. The counts are frozen after training. A text costs the sum of its bytes' code lengths in bits,
the language with the shortest code is the answer.

The code length of a byte follows from the ORDER bytes before it and the byte itself, so each distinct run of bytes is
worked out once per task and looked up after that.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import byte_table, ship, slices, text_bytes

#: Longest context in bytes, and texts per language (different ones, about) that the trees are grown from at most.
ORDER, TRAINING_ROWS = 4, 2_000
#: The answer for texts without a letter.
UNKNOWN = "und"
#: Code lengths that a task remembers, and bytes that it looks at together.
REMEMBERED, CHUNK = 1 << 22, 1 << 19

#: A-Z are read as a-z, all other bytes as they are.
_FOLD = byte_table([])


def runs(raw: np.ndarray, offsets: np.ndarray, start: int, end: int, order: int = ORDER) -> np.ndarray:
    """For the bytes from ``start`` to ``end``, each with the ``order`` bytes before it in its text as one integer.

    Texts begin after zero bytes.
    """
    out = np.zeros(end - start, dtype=np.int64)
    for back in range(order + 1):
        first = max(start, back)
        out[first - start:] |= raw[first - back: max(0, end - back)].astype(np.int64) << (8 * back)
    begins = offsets[:-1][np.diff(offsets) > 0]
    ends = offsets[1:][np.diff(offsets) > 0]
    for place in range(order):
        at = (begins + place)[(begins + place >= start) & (begins + place < np.minimum(end, ends))]
        out[at - start] &= (1 << (8 * (place + 1))) - 1
    return out


@dataclass
class Level:
    """Contexts of one length: their bytes' counts, and per context total, distinct bytes and what escaping from it excludes."""

    symbols: np.ndarray
    counts: np.ndarray
    contexts: np.ndarray
    total: np.ndarray
    distinct: np.ndarray
    excluded: np.ndarray


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, whether it is there) of each wanted number among sorted keys."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return place, keys[place] == wanted


class Tree:
    """Frozen context tree of one language, from counts of runs of ``order`` + 1 bytes."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, order: int = ORDER):
        self.levels: list[Level] = []
        for length in range(order + 1):
            symbols, of = np.unique(grams & ((1 << (8 * (length + 1))) - 1), return_inverse=True)
            n = np.bincount(of, weights=counts, minlength=len(symbols)).astype(np.int64)
            contexts, first = np.unique(symbols >> 8, return_index=True)
            excluded = np.zeros(len(symbols), np.int64)
            if length:
                shorter = self.levels[-1]
                excluded = shorter.counts[_find(shorter.symbols, symbols & ((1 << (8 * length)) - 1))[0]]
            add = lambda x: np.add.reduceat(x, first) if len(first) else x
            self.levels.append(Level(symbols, n, contexts, add(n), add(np.ones_like(n)), add(excluded)))

    def bits(self, grams: np.ndarray) -> np.ndarray:
        """Exact code length of each run's last byte after the bytes before it."""
        out = np.zeros(len(grams))
        out_total, out_distinct = np.zeros(len(grams), np.int64), np.zeros(len(grams), np.int64)
        todo = np.arange(len(grams))
        for length in range(len(self.levels) - 1, -1, -1):
            level, some = self.levels[length], grams[todo] & ((1 << (8 * (length + 1))) - 1)
            at, known = _find(level.contexts, some >> 8)
            place, seen = _find(level.symbols, some)
            distinct = np.where(known, level.distinct[at] if len(level.distinct) else 0, 0)
            # a context that every byte has followed needs no escape
            distinct = np.where(distinct == 256, 0, distinct - out_distinct[todo])
            space = np.where(known, level.total[at] if len(level.total) else 0, 0) - out_total[todo] + distinct
            out[todo[seen]] += np.log2(space[seen] / level.counts[place[seen]])
            escapes = known & ~seen & (distinct > 0)
            out[todo[escapes]] += np.log2(space[escapes] / distinct[escapes])
            left = known & ~seen
            out_total[todo[left]], out_distinct[todo[left]] = level.excluded[at[left]], level.distinct[at[left]]
            todo = todo[~seen]
        out[todo] += np.log2(256 - out_distinct[todo])
        return out


class Scorer:
    """Code lengths of whole texts under all trees, remembering those of runs seen before."""

    def __init__(self, trees: list[Tree], order: int = ORDER):
        self.trees, self.order = trees, order
        self.size = 1 << max(12, int(np.log2(REMEMBERED / max(4, len(trees)))))
        self.keys = np.full(self.size, -1, dtype=np.int64)
        self.known = np.zeros((self.size, len(trees)))

    def _slot(self, grams: np.ndarray) -> np.ndarray:
        spread = grams.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(65 - self.size.bit_length())).astype(np.int64)

    def lengths(self, grams: np.ndarray) -> np.ndarray:
        slot = self._slot(grams)
        out = self.known[slot]
        missing = np.flatnonzero(self.keys[slot] != grams)
        if len(missing):
            new, of = np.unique(grams[missing], return_inverse=True)
            found = np.stack([tree.bits(new) for tree in self.trees], axis=1)
            out[missing] = found[of]
            free = np.flatnonzero(self.keys[self._slot(new)] < 0)
            self.keys[self._slot(new[free])] = new[free]
            at, holds = self._slot(new[free]), self.keys[self._slot(new[free])] == new[free]
            self.known[at[holds]] = found[free[holds]]
        return out

    def score(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits per text and tree."""
        raw = _FOLD[raw]
        out = np.zeros((len(offsets) - 1, len(self.trees)))
        for start in range(0, len(raw), CHUNK):
            end = min(len(raw), start + CHUNK)
            bits = self.lengths(runs(raw, offsets, start, end, self.order))
            low, high = np.maximum(offsets[:-1], start), np.minimum(offsets[1:], end)
            inside = np.flatnonzero(low < high)
            out[inside] += np.add.reduceat(bits, low[inside] - start, axis=0)
        return out


def training_texts(learned: DataFrame, rows: int = TRAINING_ROWS) -> tuple[DataFrame, list]:
    """(text, at) of about ``rows`` different texts per language, chosen by their hashes, and the languages in order.

    A text counts once in its language however often it is repeated, so neither a large group of copies nor a large language
    makes the sample larger. Rows without text or language are left out. The number of languages is
    taken to be small.
    """
    known = learned.where("text is not null and lang is not null").select(
        "text", F.col("lang").cast("string").alias("lang"), F.xxhash64("text").alias("key"))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.approx_count_distinct("key", 0.02).alias("n")).collect()}
    langs = sorted(counts)
    if not langs:
        return known.where("false").select("text", F.lit(0).alias("at")), []
    share = F.create_map(*(x for lang in langs for x in (F.lit(lang), F.lit(min(1.0, rows / max(1, counts[lang]))))))
    at = F.create_map(*(x for place, lang in enumerate(langs) for x in (F.lit(lang), F.lit(place))))
    spread = F.pmod(F.hash("key"), F.lit(1_000_000)) / 1_000_000
    some = known.where(spread < share[F.col("lang")]).groupBy("lang", "key").agg(F.min("text").alias("text"))
    return some.select("text", at[F.col("lang")].alias("at")), langs


def grow(learned: DataFrame, rows: int = TRAINING_ROWS, order: int = ORDER) -> tuple[list, list[Tree]]:
    """(languages, their trees): runs are counted in tasks and summed by a grouping, the driver holds each distinct run once."""
    texts, langs = training_texts(learned, rows)

    def count(batches):
        import pyarrow as pa

        for batch in slices(batches, 0):
            raw, offsets = text_bytes(batch.column(0))
            raw, at = _FOLD[raw], batch.column(1).to_numpy()
            for start in range(0, len(raw), CHUNK):
                end = min(len(raw), start + CHUNK)
                grams = runs(raw, offsets, start, end, order)
                inside = np.maximum(np.minimum(offsets[1:], end) - np.maximum(offsets[:-1], start), 0)
                of = np.repeat(at, inside)
                for place in np.unique(of):
                    gram, n = np.unique(grams[of == place], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(gram), place), type=pa.int32()), pa.array(gram), pa.array(n, type=pa.int64())],
                        ["at", "gram", "n"])

    found = texts.mapInArrow(count, "at int, gram bigint, n bigint").groupBy("at", "gram").agg(F.sum("n").alias("n")).toArrow()
    at, gram, n = (found.column(name).to_numpy() for name in ("at", "gram", "n"))
    return langs, [Tree(gram[at == place], n[at == place], order) for place in range(len(langs))]


def predict_languages(docs: DataFrame, learned: DataFrame, *keep: str, rows: int = TRAINING_ROWS, order: int = ORDER) -> DataFrame:
    """Per row of ``docs`` (text and the columns ``keep``): these columns, lang_pred, score and bits.

    ``learned`` holds the rows (text, lang) to learn from. ``bits`` is the code length of the text in its language,
    ``score`` the share of that language if each code length stands for a probability: 1 for the only language, 0 for
    ``und``. Texts that are null or hold no letter are ``und``, as all texts are where nothing was learned. Of equal code lengths
    the language first in order wins. Equal texts get equal answers; no other column has a part in them.
    """
    spark = docs.sparkSession
    ship(spark)
    langs, trees = grow(learned, rows, order)
    shared = spark.sparkContext.broadcast(trees)
    source = docs.select(F.coalesce("text", F.lit("")).alias("__text"), F.coalesce(
        F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("__letters"), *keep)

    def predict(batches):
        import pyarrow as pa

        scorer = Scorer(shared.value, order)
        for batch in slices(batches, 0):
            n = batch.num_rows
            best, share, cost = np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
            told = batch.column(1).to_numpy(zero_copy_only=False).astype(bool) & bool(langs)
            if langs:
                bits = scorer.score(*text_bytes(batch.column(0)))
                best = bits.argmin(axis=1)
                cost = bits[np.arange(n), best]
                share = 1 / np.exp2(np.maximum(cost[:, None] - bits, -1000)).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[2:], pa.array([langs[b] if t else UNKNOWN for b, t in zip(best, told)], type=pa.string()),
                 pa.array(np.where(told, np.round(share, 6), 0.0)), pa.array(np.where(told, np.round(cost, 3), 0.0))],
                [*batch.schema.names[2:], "lang_pred", "score", "bits"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[2:])
    return source.mapInArrow(predict, f"{kinds}{', ' if kinds else ''}lang_pred string, score double, bits double")
