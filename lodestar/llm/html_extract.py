"""Main text of web pages: a linear-chain conditional random field over the
DOM's leaf blocks.

A leaf block is the text between two boundaries of block elements, in page
order; inline elements (links, emphasis, ``br``) do not end it.  Comments,
declarations, scripts and styles are no text.  End tags may be missing.  The
features of a block are its ancestors' tags, the words of their class, id and
role, its own tag, and buckets of its length, link share and punctuation.
The field has the labels main and other, a weight per feature and label, and
weights for neighbouring labels; it is trained on labelled pages
(``html_layouts``) by maximum likelihood (forward-backward, Adam) on the
driver in a few seconds, whatever the table's size, and decoded by Viterbi.

The text of a page is its main blocks: character references decoded, white
space inside a block one space, ends trimmed, blocks joined by a line feed.

Pages are extracted one by one in a narrow pass.

Defined cases: null and empty html have the empty text, as have pages without
a main block.  Unended comments, scripts and styles reach to the page's end.
Equally likely labels: other.  Time and memory follow the page's length, however
deep its elements nest.  Repeated rows give a row each.  Extra columns are
ignored.
"""

from __future__ import annotations

import functools
import html as html_entities
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lodestar.llm.common import map_batches
from lodestar.llm.html_layouts import labelled_pages
from lodestar.llm.words import segment_sum, slices

TRAIN_PAGES = 600
STEPS = 120
DECAY = 2e-4

INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q s "
                   "samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(("script", "style"))
#: an opening tag ends these open ones (up to the nearest stop tag)
CLOSES = {"li": ("li",), "td": ("td", "th"), "th": ("td", "th"), "tr": ("td", "th", "tr"), "dt": ("dt", "dd"),
          "dd": ("dt", "dd"), "option": ("option",)}
STOPS = {"li": ("ul", "ol", "menu"), "td": ("table", "tr"), "th": ("table", "tr"), "tr": ("table",), "dt": ("dl",),
         "dd": ("dl",), "option": ("select",)}

_TOKEN = re.compile(
    r"<!--(?P<comment>.*?)(?:--!?>|\Z)"
    r"|<[!?](?P<declaration>[^>]*)(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|</[^a-zA-Z][^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role|itemprop|data-main)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_NAME = re.compile(r"[a-z]+")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for tag in RAW}


@functools.lru_cache(maxsize=20_000)
def _element(tag: str, attributes: str) -> tuple[str, tuple[str, ...], str | None]:
    """(tag, features, value of data-main)."""
    features, main = ["tag " + tag], None
    for name, *values in _ATTRIBUTE.findall(attributes):
        value = "".join(values)
        if name.lower() == "data-main":
            main = value
        else:
            features += ["name " + w for w in _NAME.findall(value.lower())]
    return tag, tuple(features), main


class Path:
    """A block element and, through its parent, all block elements around it;
    ``found`` are the features of all of them."""

    __slots__ = ("parent", "element", "found")

    def __init__(self, parent: Path | None, element: tuple):
        self.parent, self.element = parent, element
        # an element that adds nothing shares its parent's set, so depth costs nothing
        above = parent.found if parent else frozenset()
        self.found = above if above.issuperset(element[1]) else above.union(element[1])

    def key(self) -> tuple[frozenset, str]:
        return self.found, self.element[0]


_TOP = (frozenset(), "")


def leaf_blocks(page: str):
    """(text, element path, share of characters in links) of each leaf block."""
    blocks = []
    stack: list[tuple] = []  # open elements and the path they were opened in
    path: Path | None = None  # the innermost open block element
    places: dict[str, list[int]] = {}  # of a tag's open elements in the stack
    text: list[str] = []
    linked = links = 0

    def flush():
        nonlocal linked
        if text:
            joined = " ".join("".join(text).split())
            if joined:
                blocks.append((joined, path, min(1.0, linked / len(joined))))
            text.clear()
        linked = 0

    def close(at: int):
        nonlocal links, path
        outer = stack[at][1]
        blocks_gone = False
        for element, _ in stack[at:]:
            places[element[0]].pop()
            links -= element[0] == "a"
            blocks_gone = blocks_gone or element[0] not in INLINE
        del stack[at:]
        if blocks_gone:
            flush()
            path = outer

    def innermost(tags) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=-1)

    def nearest(names, stops=()) -> int | None:
        i = innermost(names)
        return i if i >= 0 and i > innermost(t for t in stops if t not in names) else None

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.match(page, at)
        if m is None:  # an unclosed quote: the rest of the tag is lost
            end = page.find(">", at)
            at = size if end < 0 else end + 1
            continue
        at = m.end()
        piece = m["text"]
        if piece is not None:
            piece = html_entities.unescape(piece) if "&" in piece else piece
            text.append(piece)
            if links:
                linked += len(piece.strip())
            continue
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["end"]:
            i = nearest((tag,))
            if i is not None:
                close(i)
            elif tag not in INLINE:
                flush()
            continue
        if tag in RAW:
            end = _RAW_END[tag].search(page, at)
            at = size if end is None else end.end()
            continue
        if tag == "br":
            text.append(" ")
        if tag not in INLINE:
            flush()
            i = nearest(("p",), ("div", "article", "section", "td", "li", "table", "button", "body"))
            if i is not None:
                close(i)
            if tag in CLOSES:
                i = nearest(CLOSES[tag], STOPS[tag])
                if i is not None:
                    close(i)
        if tag in VOID:
            continue
        element = _element(tag, m["attributes"])
        places.setdefault(tag, []).append(len(stack))
        stack.append((element, path))
        if tag not in INLINE:
            path = Path(path, element)
        elif tag == "a":
            links += 1
    flush()
    return blocks


def _path_features(path: Path | None) -> tuple[str, ...]:
    found, tag = path.key() if path else _TOP
    return tuple(sorted(found | {"own " + tag}))


def _bucket(n: int) -> int:
    return min(6, int(math.log2(n + 1)))


def text_features(text: str, link_share: float) -> tuple[str, ...]:
    return ("bias", f"words {_bucket(text.count(' ') + 1)}", f"links {0 if not link_share else 1 if link_share < 0.5 else 2}",
            f"stop {text[-1] in '.?!…'}", f"mark {text[0] in '©®|»›'}")


def label_of(path: Path | None) -> int:
    while path is not None:
        if path.element[2] is not None:
            return int(path.element[2])
        path = path.parent
    return 0


class Field:
    """Trained weights: (other, main) per feature, from label to label, and at
    the first block."""

    def __init__(self, weights: dict[str, tuple[float, float]], step: np.ndarray, first: np.ndarray):
        self.weights = weights
        self.step = step.tolist()
        self.first = first.tolist()
        self.by_path: dict[tuple, tuple[float, float]] = {}

    def __getstate__(self):
        return self.weights, self.step, self.first

    def __setstate__(self, state):
        self.weights, self.step, self.first = state
        self.by_path = {}

    def score(self, features) -> tuple[float, float]:
        known = [self.weights[f] for f in features if f in self.weights]
        return sum(w[0] for w in known), sum(w[1] for w in known)

    def decode(self, blocks) -> list[int]:
        """Viterbi: the most likely labels of a page's blocks."""
        (s00, s01), (s10, s11) = self.step
        back = []
        a = b = 0.0
        for k, (text, path, share) in enumerate(blocks):
            key = path.key() if path else _TOP
            own = self.by_path.get(key)
            if own is None:
                if len(self.by_path) > 20_000:
                    self.by_path.clear()
                own = self.by_path[key] = self.score(_path_features(path))
            more = self.score(text_features(text, share))
            e0, e1 = own[0] + more[0], own[1] + more[1]
            if k == 0:
                a, b = self.first[0] + e0, self.first[1] + e1
                continue
            from0, from1 = b + s10 > a + s00, b + s11 > a + s01
            back.append((from0, from1))
            a, b = (b + s10 if from0 else a + s00) + e0, (b + s11 if from1 else a + s01) + e1
        labels = [int(b > a)] if blocks else []
        for step in reversed(back):
            labels.append(int(step[labels[-1]]))
        return labels[::-1]


def train(pages: list[str], steps: int = STEPS) -> Field:
    """Maximum likelihood on labelled pages, all pages in step."""
    names: dict[str, int] = {}
    features, counts, labels, lengths = [], [], [], []
    for page in pages:
        blocks = leaf_blocks(page)
        if not blocks:
            continue
        lengths.append(len(blocks))
        for text, path, share in blocks:
            own = [names.setdefault(f, len(names)) for f in (*_path_features(path), *text_features(text, share))]
            features += own
            counts.append(len(own))
            labels.append(label_of(path))
    features, counts, labels = np.array(features), np.array(counts), np.array(labels)
    lengths = np.array(lengths)
    n_pages, longest = len(lengths), int(lengths.max())
    row = np.repeat(np.arange(n_pages), lengths)
    col = np.arange(len(labels)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    inside = np.arange(longest)[None, :] < lengths[:, None]
    gold = np.zeros((n_pages, longest, 2))
    gold[row, col, labels] = 1.0
    gold_step = np.einsum("pti,ptj->ij", gold[:, :-1], gold[:, 1:])
    params = [np.zeros((len(names), 2)), np.zeros((2, 2)), np.zeros(2)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]

    def logsum(x, axis):
        top = x.max(axis=axis, keepdims=True)
        return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))

    for t in range(1, steps + 1):
        weight, step, first = params
        emit = np.zeros((n_pages, longest, 2))
        emit[row, col] = segment_sum(weight[features], counts)
        ahead = np.zeros_like(emit)
        ahead[:, 0] = emit[:, 0] + first
        for k in range(1, longest):
            nxt = logsum(ahead[:, k - 1, :, None] + step, 1) + emit[:, k]
            ahead[:, k] = np.where(inside[:, k, None], nxt, ahead[:, k - 1])
        behind = np.zeros_like(emit)
        for k in range(longest - 2, -1, -1):
            nxt = logsum(step + (emit[:, k + 1] + behind[:, k + 1])[:, None, :], 2)
            behind[:, k] = np.where(inside[:, k + 1, None], nxt, behind[:, k])
        total = logsum(ahead[:, -1], 1)
        posterior = np.exp(ahead + behind - total[:, None, None]) * inside[:, :, None]
        pair = np.exp(ahead[:, :-1, :, None] + step + (emit[:, 1:] + behind[:, 1:])[:, :, None, :]
                      - total[:, None, None, None]) * inside[:, 1:, None, None]
        error = (posterior - gold)[row, col]
        spread = np.repeat(error, counts, axis=0)
        grads = [np.stack([np.bincount(features, spread[:, y], len(names)) for y in (0, 1)], axis=1) / n_pages
                 + DECAY * weight,
                 (pair.sum(axis=(0, 1)) - gold_step) / n_pages + DECAY * step,
                 (posterior[:, 0] - gold[:, 0]).sum(axis=0) / n_pages]
        for p, g, (m, v) in zip(params, grads, moments, strict=True):
            m *= 0.9
            m += 0.1 * g
            v *= 0.99
            v += 0.01 * g * g
            p -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    weight, step, first = params
    return Field({f: (float(weight[i, 0]), float(weight[i, 1])) for f, i in names.items()}, step, first)


@functools.lru_cache(maxsize=1)
def default_field() -> Field:
    return train(labelled_pages(TRAIN_PAGES))


def main_text(page: str | None, field: Field) -> str:
    blocks = leaf_blocks(page or "")
    return "\n".join(b[0] for b, main in zip(blocks, field.decode(blocks), strict=True) if main)


def extract(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page."""
    sent = pages.sparkSession.sparkContext.broadcast(field or default_field())

    def run(batches):
        for batch in batches:
            for part in slices(batch, "html"):
                texts = [main_text(p, sent.value) for p in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])
    kind = pages.schema["page_id"].dataType.simpleString()
    return map_batches(pages.select("page_id", "url", "html"), run,
                       f"page_id {kind}, url string, text string, n_chars long")
