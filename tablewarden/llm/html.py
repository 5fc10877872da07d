"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the DOM.

A page is read into leaf blocks, the runs of text between the starts and ends of block elements. A block
is described by its ancestors (element names, classes, ids, roles) and by its text (length, links,
punctuation, digits, place). The field was trained on labelled pages, and Viterbi decoding says which
blocks are the article. Scripts, styles, heads, form controls, drawings and media are never blocks; the text of any other
element, formulas, buttons, listings, fallbacks and hidden ones included, is text of its block, and the field decides.

Inside a block character references are decoded and white space becomes one blank; blocks are joined by
one line feed, whole and in page order. A null or empty page, one without blocks, and one without main
blocks have an empty text. Unclosed elements, comments and tags end with the page. Repeated rows are
extracted alike. Other columns do not matter, whatever their names.

Pages are independent, so extraction is a map over rows; training data and weights have a fixed size.
"""

from __future__ import annotations

import bisect
import functools
import html as entities
import re
from collections.abc import Container, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tablewarden.llm import labelled_pages
from tablewarden.llm.common import col

TRAINING_PAGES = 500

# Names of HTML elements.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title iframe noframes".split())
_SILENT = frozenset("head noscript template svg canvas audio video select datalist".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table "
    "tbody td tfoot th thead tr ul xmp".split()
)
# Elements that end open ones of their kind when they start: which, and what bounds the search.
_IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "tbody": (("tbody", "thead", "tfoot", "tr", "td", "th"), ("table",)), "option": (("option",), ("select", "datalist")),
}
_P_BOUND = frozenset("article aside blockquote body button caption dd div dl dt figure footer form header html li main nav ol "
                     "section table td th ul".split())
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)>""")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)")
_ATTRIBUTE = re.compile(r"""([^\s=/"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_PART = re.compile(r"[^a-z0-9]+")
_XMP_END = re.compile(r"</xmp[^>]*>?", re.I)


@dataclass
class Block:
    text: str
    features: list[str]
    main: bool = False


@dataclass
class _Element:
    name: str
    features: tuple[str, ...] = ()
    silent: bool = False
    main: bool = False


@dataclass
class _Open:
    """The block that text goes into, and what its first text stood in."""

    pieces: list[str] = field(default_factory=list)
    linked: int = 0
    features: list[str] = field(default_factory=list)
    inner: str = ""
    main: bool = False


class _Stack:
    """The open elements, with counts and places of what is asked of them, so that no step looks at all of them."""

    def __init__(self, known: Container[str] | None):
        self.known = known
        self.elements: list[_Element] = []
        self.places: dict[str, list[int]] = {}  # of each name, rising
        self.blocks: list[int] = []
        self.features: dict[str, int] = {}
        self.silent = self.links = self.main = 0

    def push(self, element: _Element) -> None:
        at = len(self.elements)
        self.elements.append(element)
        self.places.setdefault(element.name, []).append(at)
        if element.name in _BLOCK:
            self.blocks.append(at)
        for f in element.features:
            if self.known is None or f in self.known:
                self.features[f] = self.features.get(f, 0) + 1
        self.silent += element.silent
        self.links += element.name == "a"
        self.main += element.main

    def pop(self, index: int) -> None:
        """Close the element at ``index`` and all inside it."""
        while len(self.elements) > index:
            element = self.elements.pop()
            self.places[element.name].pop()
            if element.name in _BLOCK:
                self.blocks.pop()
            for f in element.features:
                if self.known is None or f in self.known:
                    self.features[f] -= 1
                    if not self.features[f]:
                        del self.features[f]
            self.silent -= element.silent
            self.links -= element.name == "a"
            self.main -= element.main

    def last(self, names: Iterable[str]) -> int:
        """The place of the innermost open element of these names, or -1."""
        return max((self.places[name][-1] for name in names if self.places.get(name)), default=-1)

    def first_after(self, names: Iterable[str], bound: int) -> int:
        """The place of the outermost open element of these names inside ``bound``, or -1."""
        found = []
        for name in names:
            places = self.places.get(name, ())
            k = bisect.bisect_right(places, bound)
            found += places[k : k + 1]
        return min(found, default=-1)


@functools.lru_cache(maxsize=4096)
def _element(name: str, attributes: str) -> _Element:
    features, silent, main = [f"a:{name}"], name in _SILENT, False
    if attributes:
        for key, a, b, c in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), (a or b or c).lower()
            if key in ("class", "id", "role"):
                for word in value.split():
                    features.append(f"c:{word}")
                    features += [f"w:{part}" for part in _PART.split(word) if part]
            elif key == "hidden" or key == "style" and "display:none" in value.replace(" ", ""):
                features.append("hidden")
            elif key == "data-main":
                main = True
    return _Element(name, tuple(features), silent, main)


def read(page: str, labelled: bool = False, known: Container[str] | None = None) -> list[Block]:
    """The leaf blocks of a page in order; ``labelled`` pages say which are main.

    ``known`` are the only features that matter, if given: with it, time is linear in the page.
    """
    stack = _Stack(known)
    out: list[Block] = []
    now = _Open()

    def flush() -> None:
        nonlocal now
        if now.pieces:
            text = " ".join(entities.unescape("".join(now.pieces)).split())
            if text:
                out.append(_described(text, now, labelled))
            now = _Open()

    def add(text: str) -> None:
        if stack.silent or not text:
            return
        if not now.pieces:
            if text.isspace():
                return
            now.features = list(stack.features)
            now.inner = stack.elements[stack.blocks[-1]].name if stack.blocks else ""
            now.main = stack.main > 0
        now.pieces.append(text)
        if stack.links:
            now.linked += len(text)

    at, n = 0, len(page)
    while at < n:
        left = page.find("<", at)
        if left < 0:
            add(page[at:])
            break
        add(page[at:left])
        following = page[left + 1 : left + 2]
        if following == "!" or following == "?":
            if page.startswith("<!--", left):
                end = page.find("-->", left + 4)
                at = n if end < 0 else end + 3
            elif page.startswith("<![CDATA[", left):
                end = page.find("]]>", left)
                at = n if end < 0 else end + 3
            else:
                end = page.find(">", left)
                at = n if end < 0 else end + 1
            continue
        tag = _TAG.match(page, left) or _LOOSE.match(page, left)
        if tag is None:
            add("<")
            at = left + 1
            continue
        at = tag.end()
        name = tag[2].lower()
        if tag[1]:
            if name in _BLOCK:
                flush()
            elif name == "br":
                add(" ")
            at_name = stack.last((name,))
            # Inline ends do not reach out of their block.
            if at_name >= 0 and (name in _BLOCK or not stack.blocks or at_name > stack.blocks[-1]):
                stack.pop(at_name)
            continue
        if name in _BLOCK:
            flush()
            if name in _IMPLIED:
                kinds, bounds = _IMPLIED[name]
                ended = stack.first_after(kinds, stack.last(bounds))
                if ended >= 0:
                    stack.pop(ended)
            paragraph = stack.last(("p",))
            if paragraph > stack.last(_P_BOUND):
                stack.pop(paragraph)
        if name in ("body", "main", "article", "header", "nav"):
            head = stack.last(("head",))
            if head >= 0:
                stack.pop(head)
        if name == "xmp":  # a listing: what looks like markup in it is text
            end = _XMP_END.search(page, at)
            stack.push(_element(name, tag[3]))
            add(page[at : n if end is None else end.start()].replace("&", "&amp;"))
            flush()
            stack.pop(len(stack.elements) - 1)
            at = n if end is None else end.end()
            continue
        if name in _RAW:
            end = re.compile(rf"</{name}[^>]*>?", re.I).search(page, at)
            at = n if end is None else end.end()
            continue
        if name == "br":
            add(" ")
            continue
        if name in _VOID:
            continue
        stack.push(_element(name, tag[3]))
    flush()
    for i, block in enumerate(out):
        place = i / len(out)
        block.features.append(f"place:{min(int(place * 5), 4)}")
        block.features.append("last" if i == len(out) - 1 else "first" if i == 0 else "inner")
    return out


def _described(text: str, now: _Open, labelled: bool) -> Block:
    features = {"bias", *now.features, f"t:{now.inner}"}
    words = text.count(" ") + 1
    features.add(f"words:{words if words < 3 else 5 if words < 6 else 10 if words < 11 else 20 if words < 21 else 40}")
    links = now.linked / max(1, sum(map(len, now.pieces)))
    features.add(f"links:{0 if not links else 1 if links < 0.3 else 2 if links < 0.8 else 3}")
    features.add(f"end:{text[-1] if text[-1] in '.!?:' else 'none'}")
    features.add(f"commas:{min(text.count(','), 2)}")
    digits = sum(map(text.count, "0123456789"))
    features.add(f"digits:{0 if not digits else 1 if digits < 0.1 * len(text) else 2}")
    if "©" in text or "opyright" in text:
        features.add("copyright")
    if links and "|" in text:
        features.add("bar")
    return Block(text, sorted(features), labelled and now.main)


@dataclass
class BlockField:
    """Weights of the field: features by label, transitions, and the labels of the ends."""

    index: dict[str, int]
    weights: np.ndarray  # features x 2
    moves: np.ndarray  # from x to
    ends: np.ndarray  # (first, last) x label

    def decode(self, blocks: list[Block]) -> list[bool]:
        """The most probable labels, by Viterbi."""
        if not blocks:
            return []
        (m00, m01), (m10, m11) = self.moves.tolist()
        table, weights = self.index, self._rows
        back = []
        a, b = self.ends[0].tolist()
        for i, block in enumerate(blocks):
            x = y = 0.0
            for f in block.features:
                k = table.get(f)
                if k is not None:
                    u, v = weights[k]
                    x += u
                    y += v
            if i:
                from0, from1 = a + m00, b + m10
                to0, to1 = a + m01, b + m11
                back.append((from1 > from0, to1 > to0))
                a, b = max(from0, from1) + x, max(to0, to1) + y
            else:
                a, b = a + x, b + y
        label = b + self.ends[1, 1] > a + self.ends[1, 0]
        out = [label]
        for from_other, to_main in reversed(back):
            label = to_main if label else from_other
            out.append(label)
        return [bool(x) for x in reversed(out)]

    def __post_init__(self):
        self._rows = [tuple(x) for x in self.weights.tolist()]


def train(pages: list[list[Block]], turns: int = 160, rate: float = 0.2, pull: float = 2e-4, least: int = 3) -> BlockField:
    """Fit the field by gradient ascent on the conditional likelihood, all pages at once."""
    pages = [p for p in pages if p]
    seen: dict[str, int] = {}
    for page in pages:
        for block in page:
            for f in block.features:
                seen[f] = seen.get(f, 0) + 1
    index = {f: i for i, f in enumerate(sorted(f for f, c in seen.items() if c >= least))}
    size = np.array([len(p) for p in pages])
    longest = size.max()
    rows = [b for p in pages for b in p]
    x = np.zeros((len(rows), len(index)), dtype=np.float32)
    for r, block in enumerate(rows):
        x[r, [index[f] for f in block.features if f in index]] = 1
    page = np.repeat(np.arange(len(pages)), size)
    place = np.concatenate([np.arange(k) for k in size])
    y = np.array([b.main for b in rows], dtype=int)
    inside = np.arange(longest)[None] < size[:, None]
    truth = np.zeros((len(pages), longest), dtype=int)
    truth[page, place] = y
    params = [np.zeros((len(index), 2)), np.zeros((2, 2)), np.zeros((2, 2))]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    every = np.arange(len(pages))
    seen_x = [x[y == k].sum(0) for k in (0, 1)]
    pairs = inside[:, 1:]
    seen_moves = np.array([[(pairs & (truth[:, :-1] == a) & (truth[:, 1:] == b)).sum() for b in (0, 1)] for a in (0, 1)])
    seen_ends = np.array([np.bincount(truth[:, 0], minlength=2), np.bincount(truth[every, size - 1], minlength=2)])

    def total(a, axis):
        top = a.max(axis=axis, keepdims=True)
        return np.log(np.exp(a - top).sum(axis=axis)) + top.squeeze(axis)

    for turn in range(1, turns + 1):
        w, moves, ends = params
        score = np.zeros((len(pages), longest, 2))
        score[page, place] = x @ w
        score[:, 0] += ends[0]
        score[every, size - 1] += ends[1]
        forward, backward = score.copy(), np.zeros_like(score)
        for t in range(1, longest):
            step = total(forward[:, t - 1, :, None] + moves[None], 1) + score[:, t]
            forward[:, t] = np.where(inside[:, t, None], step, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            step = total(moves[None] + (score[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(inside[:, t + 1, None], step, 0.0)
        z = total(forward[:, -1], 1)
        p = np.exp(forward + backward - z[:, None, None]) * inside[..., None]
        joint = forward[:, :-1, :, None] + moves[None, None] + (score[:, 1:] + backward[:, 1:])[:, :, None, :] - z[:, None, None, None]
        p_moves = (np.exp(np.minimum(joint, 0)) * pairs[..., None, None]).sum(axis=(0, 1))
        expected = x.T @ p[page, place]
        gradients = [
            np.stack(seen_x, axis=1) - expected, seen_moves - p_moves,
            seen_ends - np.array([p[:, 0].sum(0), p[every, size - 1].sum(0)]),
        ]
        for k, gradient in enumerate(gradients):
            g = gradient / len(pages) - pull * params[k]
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            params[k] = params[k] + rate * (1 - turn / (turns + 1)) * (first[k] / (1 - 0.9**turn)) / (np.sqrt(second[k] / (1 - 0.99**turn)) + 1e-8)
    return BlockField(index, *params)


@functools.cache
def trained(n: int = TRAINING_PAGES) -> BlockField:
    return train([read(p, labelled=True) for p in labelled_pages.pages(n)])


def main_text(page: str | None, model: BlockField) -> str:
    blocks = read(page or "", known=model.index)
    return "\n".join(b.text for b, main in zip(blocks, model.decode(blocks), strict=True) if main)


def extract(df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", model: BlockField | None = None) -> DataFrame:
    """Per row: page_id, url, text and n_chars (code points)."""
    shared = df.sparkSession.sparkContext.broadcast(model or trained())
    schema = T.StructType([
        T.StructField("page_id", df.schema[key].dataType), T.StructField("url", T.StringType()),
        T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py(), shared.value) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=schema.names,
            )

    return df.select(col(key), col(url), col(html)).mapInArrow(run, schema)
