"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is cut into blocks at block-level tags. Each block has its word count and link density, those of the
blocks before and after it, and where it stands (inside the page's main element, inside an element that is furniture by
tag or class). A small decision tree, trained on the labelled blocks below when a job starts, keeps or drops
each block.
"""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from siltstone.llm.common import ship

# Fixed values of HTML: element names by the part they play.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math select xmp noembed".split())
#: Of these, the elements whose text runs to the end of the page when they are not closed.
OPEN_ENDED = frozenset("script style".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split())
FURNITURE = frozenset("nav footer aside form button dialog menu fieldset head".split())
MAIN = frozenset("article main".split())

# Class and id names that mark furniture, after an optional place word.
_FURNITURE_NAME = re.compile(
    r"(?:(?:site|page|main|user|reader|top|bottom|left|right|global|post|article|primary|secondary)[-_])?"
    r"(?:ads?|advert\w*|adbox|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter"
    r"|subscribe|subscription|signup|login|comments?|discussion|disqus|replies|respond|sidebar|side|widget\w*|menu|nav|navbar"
    r"|navigation|breadcrumbs?|footer|header|masthead|social|share|sharing|related|recommended|search\w*|toolbar|pager|pagination"
    r"|copyright|disclaimer|skip\w*)(?:[-_].*)?", re.I)
_MAIN_NAME = re.compile(r"(?:(?:main|page|article|post|entry|story|blog)[-_]?)?(?:article|content|entry|story|body|text)", re.I)
_FURNITURE_ROLE = frozenset("navigation banner contentinfo complementary search dialog alert form menu".split())

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?>\"[^\"]*\"|'[^']*'|[^>\"'])*+|[^>]*)>", re.S)
_ATTRIBUTE = re.compile(r"(?:^|[\s\"'])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

COLUMNS = (
    "furniture", "place", "link_density", "words", "before_link_density", "before_words", "after_link_density", "after_words")

# Labelled blocks: the columns above, then 1 for text. ``place`` is 1 inside the page's main element, 0 outside
# it, 0.5 on pages without one. Densities are shares of words inside links.
LABELLED = (
    (0, 1, 0.0, 10, 0.0, 14, 0.0, 60, 1), (0, 1, 0.0, 60, 0.0, 10, 0.0, 45, 1), (0, 1, 0.0, 4, 0.0, 80, 0.0, 90, 1),
    (0, 1, 0.0, 1, 0.0, 9, 0.0, 3, 1), (0, 1, 0.3, 40, 0.0, 50, 0.0, 30, 1), (0, 1, 1.0, 6, 0.0, 40, 0.0, 25, 1),
    (0, 1, 0.1, 200, 0.2, 12, 0.0, 0, 1), (0, 1, 0.0, 25, 1.0, 3, 1.0, 2, 1), (0, 1, 0.0, 7, 0.0, 0, 0.0, 0, 1),
    (0, 1, 0.6, 12, 0.6, 10, 0.5, 11, 1), (0, 1, 0.0, 2, 1.0, 1, 0.0, 8, 1), (0, 1, 0.0, 400, 0.0, 300, 0.0, 12, 1),
    (1, 1, 0.0, 30, 0.0, 60, 0.0, 45, 0), (1, 1, 0.0, 9, 0.0, 70, 0.0, 80, 0), (1, 1, 0.5, 8, 0.0, 40, 0.0, 30, 0),
    (1, 1, 0.0, 120, 0.0, 90, 0.0, 70, 0), (1, 1, 1.0, 3, 0.0, 20, 0.0, 20, 0), (1, 1, 0.0, 2, 0.0, 10, 0.0, 55, 0),
    (1, 0, 1.0, 1, 0.0, 0, 1.0, 1, 0), (1, 0, 1.0, 2, 1.0, 1, 1.0, 3, 0), (1, 0, 0.0, 8, 1.0, 1, 0.0, 12, 0),
    (1, 0, 0.0, 35, 0.0, 60, 0.0, 0, 0), (1, 0, 0.0, 60, 0.0, 45, 0.0, 50, 0), (1, 0, 0.2, 14, 0.0, 70, 0.0, 0, 0),
    (0, 0, 0.0, 6, 0.0, 0, 1.0, 2, 0), (0, 0, 0.0, 50, 0.0, 60, 0.0, 9, 0), (0, 0, 0.9, 20, 1.0, 4, 0.0, 40, 0),
    (0, 0, 0.0, 15, 0.0, 80, 0.0, 0, 0), (0, 0, 1.0, 2, 0.0, 5, 1.0, 2, 0), (0, 0, 0.0, 90, 0.0, 30, 0.0, 20, 0),
    (1, 0.5, 0.0, 40, 0.0, 60, 0.0, 40, 0), (1, 0.5, 1.0, 2, 1.0, 1, 1.0, 1, 0), (1, 0.5, 0.0, 7, 0.0, 30, 0.0, 30, 0),
    (0, 0.5, 0.0, 60, 0.0, 50, 0.0, 40, 1), (0, 0.5, 0.1, 45, 0.0, 10, 0.0, 60, 1), (0, 0.5, 0.0, 8, 1.0, 2, 0.0, 55, 1),
    (0, 0.5, 0.0, 18, 0.0, 60, 0.0, 30, 1), (0, 0.5, 0.2, 25, 0.0, 40, 0.0, 0, 1), (0, 0.5, 0.0, 12, 0.0, 40, 0.0, 20, 1),
    (0, 0.5, 0.0, 40, 0.0, 40, 1.0, 4, 1), (0, 0.5, 0.0, 35, 1.0, 2, 1.0, 3, 1), (0, 0.5, 0.0, 5, 1.0, 1, 0.0, 90, 1),
    (0, 0.5, 1.0, 2, 1.0, 2, 1.0, 1, 0), (0, 0.5, 0.9, 12, 0.0, 6, 1.0, 4, 0), (0, 0.5, 1.0, 1, 0.0, 0, 1.0, 2, 0),
    (0, 0.5, 0.7, 30, 0.8, 25, 0.9, 10, 0), (0, 0.5, 1.0, 5, 0.0, 40, 1.0, 4, 0), (0, 0.5, 0.5, 6, 1.0, 3, 0.9, 8, 0),
)


@dataclass
class Block:
    text: str
    words: int
    linked: int
    main: bool
    furniture: bool


def blocks(page: str) -> tuple[list[Block], bool]:
    """Text blocks in page order, and whether the page has a main element."""
    out: list[Block] = []
    stack: list[tuple[str, bool, int]] = []  # name, main, furniture (below 0: takes back that of forms around it)
    mains = furniture = links = 0
    seen_main = False
    pieces: list[tuple[str, bool]] = []

    def flush():
        words = linked = 0
        for text, in_link in pieces:
            n = len(text.split())
            words, linked = words + n, linked + n * in_link
        text = " ".join("".join(t for t, _ in pieces).split())
        if text:
            out.append(Block(text, max(words, 1), linked, mains > 0, furniture > 0))
        pieces.clear()

    def close(at: int):
        nonlocal mains, furniture
        for _, is_main, is_furniture in stack[at:]:
            mains, furniture = mains - is_main, furniture - is_furniture
        del stack[at:]

    at = 0
    while at < len(page):
        m = _MARKUP.search(page, at)
        text = page[at: m.start() if m else len(page)]
        if text:
            pieces.append((entities.unescape(text), links > 0))
        if not m:
            break
        at = m.end()
        if m["name"] is None:
            if m[0].startswith("<![CDATA["):
                pieces.append((m[0][9:].removesuffix("]]>"), links > 0))
            continue
        name, ends = m["name"].lower(), bool(m["end"])
        if name == "a":
            links = max(0, links + (-1 if ends else 1)) if not m["rest"].endswith("/") else links
            continue
        if name in RAW and not ends:
            if not m["rest"].endswith("/"):
                stop = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                at = stop.end() if stop else len(page) if name in OPEN_ENDED else at
            continue
        if name == "option":
            # end tags are optional: the label ends at the next tag
            stop = -1 if ends else page.find("<", at)
            at = at if ends else stop if stop >= 0 else len(page)
            continue
        if name in INLINE:
            if name == "br":
                pieces.append((" ", links > 0))
            continue
        flush()
        links = 0
        if ends:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    close(i)
                    break
            continue
        if stack and stack[-1][0] == "p" or stack and name == "li" == stack[-1][0]:
            close(len(stack) - 1)
        if name in VOID or m["rest"].endswith("/"):
            continue
        is_main, is_furniture = _part(name, m["rest"], mains > 0)
        if is_main and furniture and all(n == "form" for n, _, f in stack if f > 0):
            # a form around the page's main element wraps the page
            is_furniture = -furniture
        stack.append((name, is_main, is_furniture))
        mains, furniture, seen_main = mains + is_main, furniture + is_furniture, seen_main or (is_main and not furniture + is_furniture)
    flush()
    return out, seen_main


def _part(name: str, rest: str, in_main: bool) -> tuple[bool, bool]:
    """Whether an element is main, or furniture."""
    if name in MAIN:
        main, furniture = True, False
    else:
        main, furniture = False, name in FURNITURE or (name == "header" and not in_main)
    if name in ("html", "body"):
        return False, False
    for key, *values in _ATTRIBUTE.findall(rest):
        for value in entities.unescape("".join(values)).split():
            if key.lower() == "role":
                main, furniture = main or value.lower() == "main", furniture or value.lower() in _FURNITURE_ROLE
            elif _FURNITURE_NAME.fullmatch(value):
                furniture = furniture or not (in_main and name in ("header", "h1", "h2"))
            elif name in ("div", "section") and _MAIN_NAME.fullmatch(value):
                main = True
    return main and not furniture, furniture


def features(found: list[Block], has_main: bool) -> np.ndarray:
    """One row of COLUMNS per block."""
    density = [b.linked / b.words for b in found]
    words = [b.words for b in found]
    place = [0.5 if not has_main else float(b.main) for b in found]
    return np.array([
        [b.furniture for b in found], place, density, words,
        [0, *density[:-1]], [0, *words[:-1]], [*density[1:], 0], [*words[1:], 0]], dtype=float).T.reshape(len(found), len(COLUMNS))


@dataclass
class Tree:
    """An inner node tests ``column <= bound``; a leaf has a label only."""

    label: bool
    column: int = -1
    bound: float = 0.0
    low: "Tree | None" = None
    high: "Tree | None" = None

    def predict(self, rows: np.ndarray) -> np.ndarray:
        if self.column < 0:
            return np.full(len(rows), self.label)
        low = rows[:, self.column] <= self.bound
        out = np.empty(len(rows), bool)
        out[low], out[~low] = self.low.predict(rows[low]), self.high.predict(rows[~low])
        return out


def train(rows: np.ndarray, labels: np.ndarray, depth: int = 6) -> Tree:
    """A classification tree by Gini impurity; of equal splits the first column and the lowest bound."""
    node = Tree(labels.mean() >= 0.5)
    if depth == 0 or labels.min() == labels.max():
        return node
    best = None
    for column in range(rows.shape[1]):
        values = np.unique(rows[:, column])
        for bound in (values[1:] + values[:-1]) / 2:
            low = rows[:, column] <= bound
            impurity = sum(s.sum() * labels[s].mean() * (1 - labels[s].mean()) for s in (low, ~low))
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, column, bound, low)
    if best is None:
        return node
    _, node.column, node.bound, low = best
    node.low, node.high = train(rows[low], labels[low], depth - 1), train(rows[~low], labels[~low], depth - 1)
    return node


def trained() -> Tree:
    table = np.array(LABELLED, dtype=float)
    return train(table[:, :-1], table[:, -1])


def main_text(page: str | None, tree: Tree) -> str:
    found, has_main = blocks(page or "")
    if not found:
        return ""
    keep = tree.predict(features(found, has_main))
    return "\n".join(b.text for b, k in zip(found, keep) if k)


def extract_text(
    pages: DataFrame, html_column: str = "html", keep: tuple[str, ...] = ("page_id", "url"),
) -> DataFrame:
    """Columns ``keep``, the page's main text and its number of code points.

    Null and empty pages, and pages without a text block, give an empty text; repeated rows give equal rows;
    other columns are not read.
    """
    ship(pages.sparkSession)
    tree = trained()

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [main_text(x, tree) for x in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[*keep, "text", "n_chars"])

    kinds = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep)
    return pages.select(*keep, html_column).mapInArrow(run, f"{kinds}, text string, n_chars bigint")
