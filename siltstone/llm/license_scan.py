"""License notices in texts: exact phrases, and short notices with a few edits.

A notice may differ by ``edits`` letters. Cut into edits + 1 parts, at least one part stands unchanged
(pigeonhole), so exact searches for the parts find all candidates; only around them is the notice matched with
the regex library's bounded errors. Texts are searched as their words joined by one space, so line breaks and
punctuation inside a notice cost no edits.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from siltstone.llm.common import ship

# Fixed values of the contract: phrases and labels that are found as consecutive words.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: Short notices and their labels: words of a notice, joined by one space.
NOTICES = (
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person", "mit"),
    ("licensed under cc by nc", "cc-by-nc"),
    ("licensed under cc by sa", "cc-by-sa"),
    ("creative commons attribution", "cc-by"),
    ("gnu general public license", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("mozilla public license", "mpl"),
    ("redistribution and use in source and binary forms", "bsd"),
    ("all rights reserved", "reserved"),
)
#: One edit for so many letters of a notice, and at most so many.
LETTERS_PER_EDIT, MOST_EDITS = 8, 4

#: Words that tell notices apart, and words of other licenses that may stand in their place.
TELLING = frozenset("apache mit nc sa lesser mozilla".split())
RIVALS = tuple("apache mit nc sa nd lesser affero mozilla bsd isc gpl lgpl mpl gnu eclipse zlib boost".split())

#: Bytes of words, lower-cased; all others are spaces.
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


@dataclass(frozen=True)
class Notice:
    text: str
    label: str
    edits: int

    def parts(self) -> list[tuple[int, bytes]]:
        """edits + 1 parts of near equal length, with their places."""
        cuts = np.linspace(0, len(self.text), self.edits + 2).astype(int).tolist()
        return [(a, self.text[a:b].encode()) for a, b in zip(cuts, cuts[1:])]


def notices(pairs: Iterable[tuple[str, str]] = NOTICES) -> list[Notice]:
    return [Notice(t, label, max(1, min(MOST_EDITS, len(t) // LETTERS_PER_EDIT))) for t, label in pairs]


def _edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def _others(text: str) -> list[str]:
    """The notice with each telling word replaced by that of another license."""
    words = text.split()
    return [" ".join([*words[:i], r, *words[i + 1:]]) for i, w in enumerate(words) if w in TELLING for r in RIVALS if r != w]


def _places(text: bytes, part: bytes):
    at = text.find(part)
    while at >= 0:
        yield at
        at = text.find(part, at + 1)


class _Searcher:
    """Searches of one task: patterns are compiled once."""

    def __init__(self, found: list[Notice]):
        import regex

        self.notices = [
            (n, n.parts(), _others(n.text), regex.compile(f"(?<![^ ])(?:{regex.escape(n.text, literal_spaces=True)}){{e<={n.edits}}}(?![^ ])"))
            for n in found]
        # the same with the fewest edits instead of the first place
        self.best = [regex.compile("(?b)" + pattern.pattern) for *_, pattern in self.notices]

    def base(self, text: bytes):
        """(start in words, label) of every place of a base phrase in a text that begins and ends with a space."""
        for phrase, label in BASE:
            for at in _places(text, b" %s " % phrase.encode()):
                yield text.count(b" ", 0, at), label

    def fuzzy(self, text: bytes):
        """(label, start, end, edits, letters) of every notice; places count bytes of the joined words.

        Windows around the seeds overlap; joined, each is scanned once, from left to right: of what overlaps the first
        match, the best counts. A span that is nearer to the notice of another license is not one of this.
        """
        for (notice, parts, others, pattern), best in zip(self.notices, self.best):
            windows = []
            for shift, part in parts:
                for at in _places(text, part):
                    begin = max(0, at - shift - 4 * notice.edits)
                    windows.append((begin, min(len(text), at - shift + len(notice.text) + 4 * notice.edits)))
            windows.sort()
            joined: list[list[int]] = []
            for begin, end in windows:
                if joined and begin <= joined[-1][1]:
                    joined[-1][1] = max(joined[-1][1], end)
                else:
                    joined.append([begin, end])
            for begin, end in joined:
                begin, end = max(0, text.rfind(b" ", 0, begin + 1)), (text.find(b" ", end - 1) + 1) or len(text)
                window = text[begin:end].decode("utf-8", "replace")
                at = 0
                while m := pattern.search(window, at):
                    # a match that starts too early covers the start of a better one
                    stop = window.find(" ", m.start() + len(notice.text) + 2 * notice.edits)
                    m = best.search(window, m.start(), len(window) if stop < 0 else stop) or m
                    at = max(m.end(), at + 1)
                    edits = sum(m.fuzzy_counts)
                    if edits and any(_edits(m.group().strip(), x) < edits for x in others):
                        continue
                    start = begin + len(window[: m.start()].encode())
                    yield (notice.label, start, start + len(m.group().encode()), sum(m.fuzzy_counts), len(notice.text))


def _scan(batches, found: list[Notice]):
    import pyarrow as pa

    searcher = _Searcher(found)
    for batch in batches:
        rows = []
        for text in batch.column(1).cast(pa.binary()).to_pylist():
            words = (text or b"").translate(_WORDS).split()
            joined = b" %s " % b" ".join(words)
            base = sorted(searcher.base(joined))
            spans = sorted(set(searcher.fuzzy(joined)), key=lambda x: (x[1], x[2], x[0]))
            score = 1.0 if base else max([0.0, *(1 - e / n for *_, e, n in spans)])
            rows.append((
                len(words), len(base), base[0][0] if base else None, base[-1][0] if base else None,
                ",".join(sorted({x for _, x in base})), ",".join(sorted({x for _, x in base} | {x[0] for x in spans})), score,
                [{"label": label, "first_word": joined.count(b" ", 0, a + 1) - 1 if joined[a:a + 1] != b" " else joined.count(b" ", 0, a),
                  "n_words": len(joined[a:b].split()), "edits": e} for label, a, b, e, _ in spans]))
        columns = list(zip(*rows)) or [()] * 8
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct(
            [("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("edits", pa.int64())]))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
            names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "notices"])


def license_scan(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", pairs: Iterable[tuple[str, str]] = NOTICES,
) -> DataFrame:
    """One row per row of ``docs``: base places, labels, score and the spans of fuzzy notices.

    ``score`` is 1 with a base phrase, else 1 - edits / letters of the best notice, 0 without any. A null text
    counts as empty; repeated rows give equal rows; other columns are not read.
    """
    ship(docs.sparkSession)
    found = notices(pairs)
    return docs.select(docs[id_column].alias("doc_id"), docs[text_column].alias("text")).mapInArrow(
        lambda batches: _scan(batches, found),
        f"doc_id {docs.schema[id_column].dataType.simpleString()}, n_words bigint, n_base bigint, first_word bigint, "
        "last_word bigint, base_labels string, labels string, score double, "
        "notices array<struct<label:string,first_word:bigint,n_words:bigint,edits:bigint>>")
