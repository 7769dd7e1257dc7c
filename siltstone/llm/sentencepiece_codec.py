"""SentencePiece BPE with seeded merge-dropout, and lossless decoding.

The vocabulary is read from a ``.model`` file on the driver and sent to the tasks (a few MB, bounded by
the vocabulary). Encoding takes the candidate merges of a unit by score, leftmost first, as the agenda of
SentencePiece does; a candidate is skipped for good when a keyed hash of (seed, unit, stream, span) falls below
the dropout. The stream is a hash of (seed, doc_id, place), one per occurrence of a unit, so repeated words are cut in
different ways while the same seed always gives the same pieces. Without dropout the pieces equal the library's.

No piece of such a vocabulary holds a letter before a space sign, so no merge crosses the start of a run
of spaces: text falls into independent units there, which are encoded together as array operations: each distinct
unit once without dropout, and again the occurrences whose stream drops one of the merges made on the way.
Units beyond LONG letters go through a heap instead, in n log n steps.
"""

from __future__ import annotations

import heapq
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import mix, ship, slices

#: The sign that stands for a space, and a code above Unicode for that sign itself as text.
SPACE, LITERAL = 0x2581, 0x110000
#: Production parameters; a number of streams limits the segmentations of a unit under one seed, None does not.
DROPOUT, SEED, STREAMS = 0.1, 17, None
#: Letters of a unit above which the heap is used, and code points that are encoded at a time.
LONG, SLICE = 96, 1_000_000
#: Symbols of units of one length that go through the agenda together.
AGENDA = 100_000
#: Units whose letters or merges are arrays at a time; more of them share an agenda, as repeats are found among all.
CHUNK = 8_192

_NONE = np.int32(1 << 30)


@dataclass
class Vocabulary:
    """Pieces as arrays: what a task needs to encode and decode."""

    first: np.ndarray  # code point -> id of the piece of this one letter, or size + code point
    keys: np.ndarray  # open-addressed table of (left id, right id)
    merged: np.ndarray  # the piece that the two make
    rank: np.ndarray  # id -> place by score
    byte: np.ndarray  # byte -> id of its piece
    data: np.ndarray  # bytes of all pieces
    at: np.ndarray  # id -> start in data
    size: int


def read_vocabulary(path: str) -> Vocabulary:
    """Arrays of a SentencePiece BPE model with byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    byte, raw, ids = np.full(256, -1, np.int64), [], {}
    for i in range(size):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte[int(piece[3:5], 16)] = i
            raw.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i):
            raw.append(b"")
        else:
            ids[piece] = i
            raw.append(piece.replace(chr(SPACE), " ").encode())
    if (byte < 0).any():
        raise ValueError("the model has no byte pieces, so it cannot decode without loss")
    if any(re.search(f"[^{chr(SPACE)}]{chr(SPACE)}", piece) for piece in ids):
        raise ValueError("pieces hold a space sign after a letter: units are not independent")
    first = np.arange(LITERAL + 1, dtype=np.int32) + np.int32(size)
    for piece, i in ids.items():
        if len(piece) == 1:
            first[ord(piece)] = i
    pairs = {}
    for piece, i in ids.items():
        for cut in range(1, len(piece)):
            left, right = ids.get(piece[:cut]), ids.get(piece[cut:])
            if left is not None and right is not None:
                pairs[left << 32 | right] = i
    keys = np.full(1 << max(4, (4 * len(pairs)).bit_length()), -1, np.int64)
    merged = np.zeros(len(keys), np.int32)
    wanted = np.fromiter(pairs, np.int64, len(pairs))
    for key, slot in zip(wanted.tolist(), _slots(wanted, len(keys)).tolist()):
        while keys[slot] >= 0:
            slot = (slot + 1) & (len(keys) - 1)
        keys[slot], merged[slot] = key, pairs[key]
    scores = np.array([model.get_score(i) for i in range(size)])
    rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
    at = np.append(0, np.cumsum([len(x) for x in raw])).astype(np.int64)
    return Vocabulary(first, keys, merged, rank, byte, np.frombuffer(b"".join(raw), np.uint8), at, size)


def _slots(keys: np.ndarray, n: int) -> np.ndarray:
    return (mix(keys.view(np.uint64)) & np.uint64(n - 1)).astype(np.int64)


def _merge(v: Vocabulary, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Piece of two neighbours, -1 if they make none."""
    flat = (left.astype(np.int64) << np.int64(32) | right).ravel()
    known = (left.ravel() < v.size) & (right.ravel() < v.size)
    slot = _slots(flat, len(v.keys))
    out = np.full(len(flat), -1, np.int32)
    open_ = np.flatnonzero(known)
    while len(open_):
        found = v.keys[slot[open_]]
        hit = found == flat[open_]
        out[open_[hit]] = v.merged[slot[open_[hit]]]
        open_ = open_[~hit & (found >= 0)]
        slot[open_] = (slot[open_] + 1) & (len(v.keys) - 1)
    return out.reshape(left.shape)


def _skipped(key: np.ndarray, start: np.ndarray, end: np.ndarray, dropout: float) -> np.ndarray:
    """Whether the merge that makes letters start..end of a unit with this key is dropped."""
    span = start.astype(np.uint64) << np.uint64(32) | end.astype(np.uint64)
    return mix(key ^ mix(span + np.uint64(1))) < np.uint64(int(dropout * 2.0**64))


def _agenda_short(v, ids, keys, dropout, met=None):
    """Pieces of units of equal length, one per row of ``ids``: (row, place, piece) arrays in order.

    ``met`` takes (row, start, end) arrays of all merges that are made.
    """
    n, length = ids.shape
    rows = np.arange(n)
    starts = np.broadcast_to(np.arange(length + 1, dtype=np.int32), (n, length + 1)).copy()  # start of each symbol, then the end
    done = []

    def ranked(ids, starts, keys):
        piece = _merge(v, ids[:, :-1], ids[:, 1:])
        order = np.where(piece >= 0, v.rank[piece], _NONE)
        at = np.nonzero(piece >= 0)
        if dropout > 0:
            drop = _skipped(keys[at[0]], starts[at[0], at[1]], starts[at[0], at[1] + 2], dropout)
            order[at[0][drop], at[1][drop]] = _NONE
        return piece, order

    if length > 1:
        piece, order = ranked(ids, starts, keys)
    while ids.shape[1] > 1 and len(ids):
        best = order.argmin(axis=1)
        line = np.arange(len(ids))
        going = order[line, best] < _NONE
        if not going.all():
            done.append((rows[~going], ids[~going]))
            ids, starts, keys, rows, best = ids[going], starts[going], keys[going], rows[going], best[going]
            piece, order, line = piece[going], order[going], np.arange(int(going.sum()))
            if not len(ids):
                break
        if met is not None:
            met.append((rows, starts[line, best], starts[line, best + 2]))
        ids[line, best] = piece[line, best]
        width = ids.shape[1]
        take = np.arange(width - 1) + (np.arange(width - 1) > best[:, None])
        ids = np.take_along_axis(ids, take, 1)
        starts = np.take_along_axis(starts, np.arange(width) + (np.arange(width) > best[:, None]), 1)
        # only the pairs beside the new symbol change
        take = np.arange(width - 2) + (np.arange(width - 2) > best[:, None])
        piece, order = np.take_along_axis(piece, take, 1), np.take_along_axis(order, take, 1)
        for side in (best - 1, best):
            at = np.flatnonzero((side >= 0) & (side < width - 2))
            if len(at):
                place = side[at]
                new = _merge(v, ids[at, place], ids[at, place + 1])
                value = np.where(new >= 0, v.rank[new], _NONE)
                if dropout > 0:
                    value[_skipped(keys[at], starts[at, place], starts[at, place + 2], dropout)] = _NONE
                piece[at, place], order[at, place] = new, value
    if len(ids):
        done.append((rows, ids))
    return done


def _agenda_long(v, ids, key, dropout):
    """Pieces of one unit by a heap of candidates."""
    n = len(ids)
    symbol, before, after = ids.tolist(), list(range(-1, n - 1)), list(range(1, n + 1))
    end = list(range(1, n + 1))
    heap = []

    def offer(lefts):
        lefts = [i for i in lefts if i >= 0 and after[i] < n]
        if not lefts:
            return
        left, right = np.array([symbol[i] for i in lefts]), np.array([symbol[after[i]] for i in lefts])
        piece = _merge(v, left, right)
        ends = np.array([end[after[i]] for i in lefts])
        drop = _skipped(np.uint64(key), np.array(lefts), ends, dropout) if dropout > 0 else np.zeros(len(lefts), bool)
        for i, p, e, gone in zip(lefts, piece.tolist(), ends.tolist(), drop.tolist()):
            if p >= 0 and not gone:
                heapq.heappush(heap, (int(v.rank[p]), i, e, p))

    offer(range(n))
    while heap:
        _, i, e, p = heapq.heappop(heap)
        j = after[i] if symbol[i] >= 0 else n
        if j >= n or end[j] != e or symbol[j] < 0 or end[i] > e:
            continue
        if int(_merge(v, np.array([symbol[i]]), np.array([symbol[j]]))[0]) != p:
            continue
        symbol[i], symbol[j], end[i], after[i] = p, -1, e, after[j]
        if after[i] < n:
            before[after[i]] = i
        offer([before[i], i])
    return np.array([s for s in symbol if s >= 0], np.int32)


def _chunks(n: int) -> list[slice]:
    """CHUNK of n units after the other."""
    return [slice(at, at + CHUNK) for at in range(0, n, CHUNK)]


def _ragged(values, starts, counts):
    """Concatenation of values[start:start + count] over all starts."""
    ends = np.cumsum(counts)
    return values[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)]


def _encode_slice(
    v: Vocabulary, texts: list[str], doc_keys: np.ndarray, places: np.ndarray, dropout: float, seed_key, streams: int | None,
):
    """Ids of all texts in order, and each text's number of ids. A text that is not empty begins with a space.

    ``places`` has the number of each text's first unit, which is not 0 for the later parts of a long one.
    """
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.int32).copy()
    sizes = np.array([len(t) for t in texts], np.int64)
    if not len(codes):
        return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
    codes[codes == SPACE] = LITERAL
    codes[codes == 0x20] = SPACE
    space = codes == SPACE
    begins = space.copy()
    begins[1:] &= ~space[:-1]
    text_at = np.append(0, np.cumsum(sizes))
    begins[text_at[:-1][sizes > 0]] = True
    unit_at = np.flatnonzero(begins)
    lengths = np.diff(np.append(unit_at, len(codes)))
    first_unit = np.searchsorted(unit_at, text_at)
    per_text = np.diff(first_unit)
    place = np.arange(len(unit_at)) - np.repeat(first_unit[:-1] - places, per_text)
    stream = mix(np.repeat(doc_keys, per_text) + mix(place.astype(np.uint64)))
    if streams is not None:
        stream %= np.uint64(streams)

    powers = np.cumprod(np.full(int(lengths.max()), 0x9E3779B97F4A7C15 | 1, np.uint64))
    value = np.zeros(len(unit_at), np.uint64)
    for some in _chunks(len(unit_at)):
        at, size = unit_at[some], lengths[some]
        letters = codes[at[0]: at[-1] + size[-1]].astype(np.uint64) + np.uint64(1)
        letters *= powers[np.arange(at[0], at[-1] + size[-1]) - np.repeat(at, size)]
        value[some] = np.add.reduceat(letters, at - at[0])
    value = mix(value + mix(lengths.astype(np.uint64)))
    keys = mix(value + mix(stream + seed_key))

    def distinct(units, hashes):
        """First of each kind among ``units``, and the kind of each; equal hashes are confirmed letter by letter."""
        _, one, which = np.unique(hashes, return_index=True, return_inverse=True)
        size, like = lengths[units], units[one[which]]
        same = size == lengths[like]
        alike = np.flatnonzero(same)
        for some in (alike[x] for x in _chunks(len(alike))):
            equal = _ragged(codes, unit_at[units[some]], size[some]) == _ragged(codes, unit_at[like[some]], size[some])
            same[some] = np.logical_and.reduceat(equal, np.cumsum(size[some]) - size[some])
        odd = np.flatnonzero(~same)
        which[odd] = len(one) + np.arange(len(odd))
        return units[np.append(one, odd)], which

    out_ids, out_unit = [], []

    def encode_units(units, first, share, met=None):
        """Pieces of units, numbered from ``first``."""
        length = lengths[units]
        for size in np.unique(length):
            mine = np.flatnonzero(length == size)
            if size > LONG:
                for u in mine.tolist():
                    at = unit_at[units[u]]
                    got = _agenda_long(v, v.first[codes[at: at + size]], keys[units[u]], share)
                    out_ids.append(got)
                    out_unit.append(np.full(len(got), first + u, np.int32))
                continue
            step = max(1, AGENDA // int(size))
            for cut in range(0, len(mine), step):
                some = mine[cut: cut + step]
                ids = v.first[codes[unit_at[units[some]][:, None] + np.arange(size)]]
                seen = None if met is None else []
                for rows, pieces in _agenda_short(v, ids, keys[units[some]], share, seen):
                    out_ids.append(pieces.ravel())
                    out_unit.append(np.repeat((first + some[rows]).astype(np.int32), pieces.shape[1]))
                if met is not None:
                    met += [(some[r], a, b) for r, a, b in seen]

    plain = np.flatnonzero(lengths <= LONG) if dropout > 0 else np.arange(len(unit_at))
    which = np.zeros(len(unit_at), np.int64)
    one, which[plain] = distinct(plain, value[plain])
    met = [] if dropout > 0 else None
    encode_units(one, 0, 0.0, met)
    n_units = len(one)
    if dropout > 0:
        again = lengths > LONG
        if met:
            # the same merges are made under dropout until one of them is dropped; candidates that are not made do not matter
            kind, start, end = (np.concatenate(x) for x in zip(*met))
            order = np.argsort(kind, kind="stable")
            start, end = start[order], end[order]
            count = np.bincount(kind, minlength=n_units)
            first = np.cumsum(count) - count
            for some in (plain[x] for x in _chunks(len(plain))):
                of = which[some]
                owner = np.repeat(some, count[of])
                start_of, end_of = _ragged(start, first[of], count[of]), _ragged(end, first[of], count[of])
                again[owner[_skipped(keys[owner], start_of, end_of, dropout)]] = True
        more = np.flatnonzero(again)
        one, kinds = distinct(more, keys[more])
        which[more] = n_units + kinds
        encode_units(one, n_units, dropout)
        n_units += len(one)
    del codes, space, begins, place, stream, value, keys, met
    ids, unit = np.concatenate(out_ids), np.concatenate(out_unit)
    out_ids.clear()
    out_unit.clear()
    order = np.argsort(unit, kind="stable")
    ids, unit = ids[order], unit[order]
    ids, unit = _bytes_for_unknown(v, ids, unit)
    counts = np.bincount(unit, minlength=n_units)
    starts = np.cumsum(counts) - counts
    all_ids = _ragged(ids, starts[which], counts[which])
    unit_ends = np.append(0, np.cumsum(counts[which]))
    return all_ids.astype(np.int32), np.diff(unit_ends[first_unit])


def _bytes_for_unknown(v, ids, unit):
    """Letters without a piece become the pieces of their UTF-8 bytes."""
    unknown = ids >= v.size
    if not unknown.any():
        return ids, unit
    code = np.where(ids - v.size == LITERAL, SPACE, ids - v.size)[unknown]
    letters, which = np.unique(code, return_inverse=True)
    encoded = [chr(c).encode("utf-8", "surrogatepass") for c in letters.tolist()]
    count = np.ones(len(ids), np.int64)
    count[unknown] = np.array([len(x) for x in encoded])[which]
    at = np.cumsum(count) - count
    out = np.repeat(ids, count)
    for k in range(4):
        has = np.array([len(x) > k for x in encoded])[which]
        byte = np.array([x[k] if len(x) > k else 0 for x in encoded])[which]
        out[at[unknown][has] + k] = v.byte[byte[has]]
    return out, np.repeat(unit, count)


def _parts(text: str) -> list[str]:
    """A text cut before runs of spaces, where no merge crosses, into parts of about SLICE letters."""
    out, at = [], 0
    while len(text) - at > SLICE:
        last = text.rfind(" ", at + 1, at + SLICE)
        cut = at + len(text[at: last + 1].rstrip(" ")) if last > 0 else at
        if cut <= at:  # no unit begins there
            found = re.compile(r"(?<! ) ").search(text, at + SLICE)
            if not found:
                break
            cut = found.start()
        out.append(text[at:cut])
        at = cut
    return [*out, text[at:]]


def encode_texts(v: Vocabulary, texts: list[str], doc_ids: np.ndarray, dropout: float, seed: int, streams: int | None):
    """(ids, counts) of texts, about SLICE code points at a time."""
    seed_key = mix(np.array([seed], np.int64).view(np.uint64))
    doc_keys = mix(doc_ids.astype(np.int64).view(np.uint64) + seed_key)
    found, counts = [], np.zeros(len(texts), np.int64)
    parts, of, places, total = [], [], [], 0

    def encode_parts():
        ids, n = _encode_slice(v, parts, doc_keys[of], np.array(places, np.int64), dropout, seed_key, streams)
        found.append(ids)
        np.add.at(counts, of, n)

    for doc, text in enumerate(texts):
        place = 0
        for part in _parts(f" {text}") if text else ():
            if parts and total + len(part) > SLICE:
                encode_parts()
                parts, of, places, total = [], [], [], 0
            parts.append(part)
            of.append(doc)
            places.append(place)
            total += len(part)
            place += len(re.findall(" +", part)) if len(text) >= SLICE else 0
    if parts:
        encode_parts()
    return (np.concatenate(found) if found else np.zeros(0, np.int32)), counts


def decode_ids(v: Vocabulary, ids: np.ndarray, counts: np.ndarray) -> list[str]:
    """Texts of id lists; the space put before each text is taken off again."""
    out, at = [], np.append(0, np.cumsum(counts))
    doc = 0
    while doc < len(counts):
        last = int(np.searchsorted(at, at[doc] + SLICE, side="right")) - 1
        last = max(last, doc + 1)
        some = ids[at[doc]: at[last]].astype(np.int64)
        size = v.at[some + 1] - v.at[some]
        data = _ragged(v.data, v.at[some], size).tobytes()
        ends = np.append(0, np.cumsum(size))[at[doc: last + 1] - at[doc]].tolist()
        out += [data[a + 1: b].decode("utf-8", "surrogatepass") for a, b in zip(ends, ends[1:])]
        doc = last
    return out


def _piece_lists(v: Vocabulary, texts, ids, dropout: float, seed: int, streams: int | None):
    """Arrow lists of piece ids of an Arrow column of texts."""
    import pyarrow as pa
    import pyarrow.compute as pc

    ids = pc.fill_null(pc.cast(ids, pa.int64()), 0).to_numpy(zero_copy_only=False)
    found, counts = encode_texts(v, [t or "" for t in texts.to_pylist()], ids, dropout, seed, streams)
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), pa.array(found, pa.int32()))
    return pc.if_else(pc.is_null(texts), pa.scalar(None, lists.type), lists) if texts.null_count else lists


def _texts_of(v: Vocabulary, lists):
    """Arrow texts of Arrow lists of piece ids."""
    import pyarrow as pa
    import pyarrow.compute as pc

    counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    ids = pc.list_flatten(lists).to_numpy(zero_copy_only=False)
    texts = pa.array(decode_ids(v, ids, counts), pa.string())
    return pc.if_else(pc.is_null(lists), pa.scalar(None, pa.string()), texts) if lists.null_count else texts


def encode(
    docs: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text", into: str = "pieces",
    dropout: float = DROPOUT, seed: int = SEED, streams: int | None = STREAMS, decoded: str | None = None,
) -> DataFrame:
    """``docs`` with a column ``into`` of piece ids, and ``decoded``, if named, with the text that these give again.

    A null text gives null, an empty one an empty list; a null id counts as 0 in the choice of streams; repeated
    rows get equal pieces. ``into`` and ``decoded`` replace columns of these names, all others stay. A task holds the rows of
    one Arrow batch and works on a few MB of their texts at a time.
    """
    if not 0 <= dropout < 1:
        raise ValueError("dropout lies between 0 and 1, 1 excluded")
    spark = docs.sparkSession
    ship(spark)
    vocabulary = spark.sparkContext.broadcast(read_vocabulary(model_path))
    kept = docs.drop(into, decoded) if decoded else docs.drop(into)
    names, at = kept.columns, kept.columns.index(text_column)

    def run(batches):
        import pyarrow as pa

        for batch in slices(batches, at):
            lists = _piece_lists(vocabulary.value, batch.column(at), batch.column(id_column), dropout, seed, streams)
            more = [lists, _texts_of(vocabulary.value, lists)] if decoded else [lists]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*names, into, *([decoded] if decoded else [])])

    schema = kept.withColumn(into, F.lit(None).cast("array<int>"))
    return kept.mapInArrow(run, (schema.withColumn(decoded, F.lit(None).cast("string")) if decoded else schema).schema)


def decode(docs: DataFrame, model_path: str, pieces_column: str = "pieces", into: str = "decoded") -> DataFrame:
    """``docs`` with a column ``into``: the text of the pieces; null for null, empty for an empty list."""
    spark = docs.sparkSession
    ship(spark)
    vocabulary = spark.sparkContext.broadcast(read_vocabulary(model_path))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = _texts_of(vocabulary.value, batch.column(pieces_column))
            names = [n for n in batch.schema.names if n != into]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [texts], names=[*names, into])

    kept = docs.drop(into)
    return kept.mapInArrow(run, kept.withColumn(into, F.lit(None).cast("string")).schema)
