"""Main text of web pages, by a linear-chain conditional random field over the leaf blocks of the page's tree.

A page is read into its tree in one pass, with the end tags that pages leave out.  A leaf
block is a run of text between the tags of block elements.  Its features are the tags and
names (class, id, role) of its ancestors and the shape of its text; neighbouring labels are
tied by transition weights.  The field is trained on labelled pages and decoded by Viterbi;
the blocks labelled main, in page order, are the text.

Only text in scripts, styles, titles, form controls and other elements that show none of it
as text is left out before that, and comments and tags.  Each page is read alone, so nothing
is shuffled, and time is linear in a page's length, whatever its markup.

Defined cases: a null or empty page has an empty text, as has one without a main block.  Of a
tag, comment or script that does not end, the rest of the page is part.  White space is
Unicode's, no-break spaces included; a line break element is white space.  Repeated rows,
and rows without ``page_id``, give a row each.  An empty table gives an empty result.  Other
columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.common import record_batch, slices
from jobtide.llm.labelled_pages import MAIN, OTHER, SAID_WORDS, labelled_pages

#: Elements whose text is not text of the page, and which hold no elements.
RAW = "script|style|title|textarea|xmp|iframe|noembed|noframes"
#: Elements left out with all that they hold.
UNSHOWN = frozenset("noscript template svg math object canvas audio video select datalist button map".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th "
    "thead tr ul label".split()
)
#: A new element ends an open one of these, unless an element of the second set is open above it.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "thead": (("thead", "tbody", "tfoot"), ("table",)),
    "tbody": (("thead", "tbody", "tfoot"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot"), ("table",)),
}
#: End tags of other elements do not reach beyond these.
WALLS = frozenset("table td th caption".split())
_ATTRIBUTES = r"""(?:[^>=]++|=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|(?!["'>])[^\s>]++)?+)*+"""
_TOKEN = re.compile(
    rf"<!--(?:>|->|.*?(?:--!?>|\Z))|<(?P<raw>{RAW})(?=[\s/>]){_ATTRIBUTES}(?:>.*?(?:</(?P=raw)(?=[\s/>])[^>]*+(?:>|\Z)|\Z)|\Z)"
    rf"|<[!?][^>]*+(?:>|\Z)|</(?P<end>[a-z][^\s/>]*+){_ATTRIBUTES}(?:>|\Z)|<(?P<start>[a-z][^\s/>]*+)(?P<with>{_ATTRIBUTES})(?:>|\Z)",
    re.I | re.S,
)
_NAMED = re.compile(r"""(?:^|[\s"'/])(class|id|role|hidden|style|aria-hidden)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?+""", re.I)
_PIECES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_WORDS = re.compile(r"[^\W\d_]{3,}|©")


@lru_cache(maxsize=20_000)
def _own(tag: str, attributes: str) -> frozenset[str]:
    """Features of one element for all blocks within it."""
    out = {f"in {tag}"}
    for name, value in _NAMED.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in ("hidden", "aria-hidden", "style"):
            if name == "hidden" or value.lower() == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                out.add("hidden")
        else:
            names = [x.lower() for x in _PIECES.findall(value[:200])]
            out |= {f"name {x}" for x in names} | {f"stem {x[:4]}" for x in names if len(x) > 4}
    return frozenset(out)


class Tree:
    """The open elements of a page.  Each keeps the features of all its ancestors, as one shared set."""

    def __init__(self) -> None:
        self.tags: list[str] = []
        self.held: list[frozenset[str]] = [frozenset()]
        self.at: dict[str, list[int]] = {}
        self.walls: list[int] = [-1]
        self.unshown = self.anchors = 0

    def _last(self, tag: str) -> int:
        found = self.at.get(tag)
        return found[-1] if found else -1

    def _cut(self, depth: int) -> None:
        """Ends all elements from ``depth`` on."""
        while len(self.tags) > depth:
            tag = self.tags.pop()
            self.held.pop()
            self.at[tag].pop()
            self.unshown -= tag in UNSHOWN
            self.anchors -= tag == "a"
            if tag in WALLS:
                self.walls.pop()

    def start(self, tag: str, attributes: str) -> None:
        if tag in BLOCKS and (p := self._last("p")) > self.walls[-1]:
            self._cut(p)
        if tag in ENDS:
            same, above = ENDS[tag]
            own = max(map(self._last, same))
            if own > max(map(self._last, above)):
                self._cut(own)
        if tag in VOID:
            return
        had = self.held[-1]
        own = _own(tag, attributes) if len(attributes) < 500 else _own.__wrapped__(tag, attributes)
        self.held.append(had if own <= had else had | own)
        self.at.setdefault(tag, []).append(len(self.tags))
        self.tags.append(tag)
        self.unshown += tag in UNSHOWN
        self.anchors += tag == "a"
        if tag in WALLS:
            self.walls.append(len(self.tags) - 1)

    def end(self, tag: str) -> None:
        at = self._last(tag)
        if at >= 0 and (at > self.walls[-1] or tag in ("table", "td", "th", "tr", "tbody", "thead", "tfoot", "caption")):
            if tag not in ("html", "body"):
                self._cut(at)


@dataclass
class Block:
    text: str
    within: frozenset[str]
    parent: str
    linked: float


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page, in order; white space is one blank, blocks without text are none."""
    out: list[Block] = []
    tree = Tree()
    parts: list[tuple[str, bool]] = []
    begun: tuple[frozenset[str], str] | None = None

    def ended() -> None:
        nonlocal begun
        if begun:
            text = " ".join("".join(x for x, _ in parts).split())
            linked = sum(len(x) for x, a in parts if a)
            whole = sum(len(x) for x, _ in parts)
            out.append(Block(text, *begun, linked / whole))
        parts.clear()
        begun = None

    def add(text: str) -> None:
        nonlocal begun
        if not tree.unshown:
            text = unescape(text) if "&" in text else text
            if begun is None and not text.isspace():
                begun = (tree.held[-1], next((t for t in reversed(tree.tags[-8:]) if t in BLOCKS), ""))
            parts.append((text, tree.anchors > 0))

    last = 0
    for m in _TOKEN.finditer(page):
        if m.start() > last:
            add(page[last : m.start()])
        last = m.end()
        if tag := m["start"]:
            tag = tag.lower()
            if tag in BLOCKS:
                ended()
            elif tag == "br":
                parts.append((" ", False))
            tree.start(tag, m["with"])
        elif tag := m["end"]:
            tag = tag.lower()
            if tag in BLOCKS:
                ended()
            tree.end(tag)
    if last < len(page):
        add(page[last:])
    ended()
    return out


def _share(x: float) -> str:
    return "none" if x == 0 else "some" if x < 0.4 else "much" if x < 0.9 else "all"


def text_features(block: Block) -> list[str]:
    """Features of the block's own text and parent."""
    text = block.text
    words = text.split()
    n = len(words)
    size = next(name for top, name in ((1, "1"), (3, "3"), (6, "6"), (12, "12"), (25, "25"), (60, "60"), (1 << 62, "more")) if n <= top)
    out = ["bias", f"parent {block.parent}", f"words {size}", f"linked {_share(block.linked)}"]
    if text[-1] in ".!?…。\"”":
        out.append("sentence" if n > 3 else "short sentence")
    if "," in text:
        out.append("comma")
    if 4 * sum(map(str.isdigit, text[:400])) > min(len(text), 400):
        out.append("digits")
    # The words that such parts are known by are short texts or stand at the beginning.
    return out + [f"said {x}" for x in SAID_WORDS.intersection(map(str.lower, _WORDS.findall(text[:200])))]


@dataclass
class BlockField:
    """Weights of the known features for main against other, and of neighbouring labels ``[before, now]``."""

    weights: dict[str, float]
    transition: np.ndarray

    def __post_init__(self) -> None:
        self._of_set: dict[frozenset[str], float] = {}

    def odds(self, block: Block) -> float:
        found = self._of_set.get(block.within)
        known = self.weights
        if found is None:
            if len(self._of_set) > 50_000:
                self._of_set.clear()
            found = self._of_set[block.within] = sum(known[x] for x in sorted(block.within) if x in known)
        return found + sum(known.get(x, 0.0) for x in sorted(text_features(block)))

    def decode(self, odds: list[float]) -> list[int]:
        """The best labels by Viterbi; of equal ones the label 0."""
        (oo, om), (mo, mm) = self.transition.tolist()
        back, other, main = [], 0.0, odds[0]
        for e in odds[1:]:
            from_other, from_main = main + mo > other + oo, main + mm > other + om
            back.append((from_other, from_main))
            other, main = max(other + oo, main + mo), max(other + om, main + mm) + e
        label = int(main > other)
        out = [label]
        for step in reversed(back):
            label = int(step[label])
            out.append(label)
        return out[::-1]

    def text(self, page: str | None) -> str:
        found = blocks(page or "")
        if not found:
            return ""
        labels = self.decode([self.odds(b) for b in found])
        return " ".join(b.text for b, y in zip(found, labels, strict=True) if y)


def labelled(pages: list[str]) -> list[tuple[list[Block], list[int]]]:
    """Blocks and labels of pages whose texts are marked."""
    out = []
    for page in pages:
        found, labels = [], []
        for b in blocks(page):
            marks = {x for x in b.text if x in (MAIN, OTHER)}
            text = b.text.replace(MAIN, "").replace(OTHER, "").strip()
            if marks and text:
                found.append(Block(text, b.within, b.parent, b.linked))
                labels.append(int(MAIN in marks))
        if found:
            out.append((found, labels))
    return out


def fit(pages: list[tuple[list[Block], list[int]]], least: int = 12, rounds: int = 120, ridge: float = 2e-4) -> BlockField:
    """Maximum likelihood by Adam over all pages at once, on features that ``least`` pages have."""
    told = [[sorted({*b.within, *text_features(b)}) for b in found] for found, _ in pages]
    spread = Counter(x for page in told for x in {f for block in page for f in block})
    names = sorted(x for x, n in spread.items() if n >= least)
    index = {x: i for i, x in enumerate(names)}
    order = sorted(range(len(pages)), key=lambda i: -len(pages[i][1]))
    lengths = np.array([len(pages[i][1]) for i in order])
    first = np.cumsum(lengths) - lengths
    truth = np.concatenate([pages[i][1] for i in order])
    x = np.zeros((len(truth), len(names)), dtype=np.float32)
    for at, i in zip(first.tolist(), order, strict=True):
        for k, block in enumerate(told[i]):
            x[at + k, [index[f] for f in block if f in index]] = 1
    inner = np.ones(len(truth), dtype=bool)
    inner[first] = False
    seen = np.bincount(2 * truth[:-1][inner[1:]] + truth[1:][inner[1:]], minlength=4).astype(float)
    active = [int((lengths > t).sum()) for t in range(int(lengths[0]))]
    theta = np.zeros(len(names) + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        odds = np.clip(x @ theta[:-4].astype(np.float32), -30, 30).astype(float)
        p = 1 / (1 + np.exp(-odds))
        own = np.column_stack((1 - p, p))
        link = np.exp(theta[-4:].reshape(2, 2))
        ahead, back, pairs = own.copy(), np.ones_like(own), np.zeros((2, 2))
        for t in range(1, len(active)):
            at = first[: active[t]] + t
            now = own[at] * (ahead[at - 1] @ link)
            ahead[at] = now / now.sum(axis=1, keepdims=True)
        for t in range(len(active) - 1, 0, -1):
            at = first[: active[t]] + t
            after = own[at] * back[at]
            joint = ahead[at - 1][:, :, None] * link * after[:, None, :]
            pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            before = after @ link.T
            back[at - 1] = before / before.sum(axis=1, keepdims=True)
        both = ahead * back
        slope = np.concatenate((x.T @ (truth - both[:, 1] / both.sum(axis=1)).astype(np.float32), seen - pairs.ravel()))
        slope = slope / len(lengths) - ridge * theta
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        theta += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return BlockField(dict(zip(names, theta[:-4].tolist(), strict=True)), theta[-4:].reshape(2, 2))


@lru_cache(maxsize=1)
def trained() -> BlockField:
    """The field fitted to the labelled pages: a bounded table that is part of this package."""
    return fit(labelled(labelled_pages()))


DDL = "page_id long, url string, text string, n_chars long"
SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def extract(pages: DataFrame, model: BlockField) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``."""
    columns = [F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url")]
    rows = pages.select(*columns, F.col("html").cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 100):
            texts = [model.text(x) for x in batch.column(2).to_pylist()]
            yield record_batch([batch.column(0), batch.column(1), texts, list(map(len, texts))], SCHEMA)

    return rows.mapInArrow(run, DDL)
