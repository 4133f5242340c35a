"""Main text of web pages by a linear-chain conditional random field.

A page is cut into the leaf blocks of its element tree: runs of text between
block-level tags, each with its open elements and their class and id names.
Blocks have binary features (ancestor tags, words in class names, link share,
length, punctuation, place in the page); the chain has two labels, main text and
the rest. Weights are those of greatest likelihood on labelled pages, whose number
is a parameter, to a stated size of the gradient; pages are decoded by Viterbi inside their
own row, so the job is one narrow pass.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Container, Iterator, Sequence
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled_pages import labelled_pages

#: Labelled pages that the field is fitted on: the bound of its sample.
TRAINING_PAGES = 300

BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol optgroup option p pre search section select summary "
    "table tbody td textarea tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not markup; none of it is text of the page.
RAW = frozenset("script style noscript template svg iframe object title textarea select head".split())
OPAQUE = frozenset("script style title textarea".split())
#: Block elements that stand in a raw one; other block start tags end one that nothing closes.
INNER = frozenset("option optgroup legend".split())
#: A start tag of the first kind ends an open element of the second.
CLOSES_P = BLOCK_TAGS - frozenset("body button caption dd dt head html label legend li optgroup option tbody td tfoot th thead title tr".split())
SELF_CLOSING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table article section div main body html blockquote td".split())
MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
NAMED = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
LETTERS = re.compile(r"[a-z]+")
#: Attributes that end in the slash of a self-closing tag, not in that of a value without quotes.
CLOSES_ITSELF = re.compile(r"(?:^|[\s\"']|(?:^|\s)[^\s=\"']+)/\s*\Z")


class Element:
    """An open element: its tag, its class and id names, and what it stands in."""

    __slots__ = ("tag", "names", "above")

    def __init__(self, tag: str, names: str, above: Element | None):
        self.tag, self.names, self.above = tag, names, above


class Block:
    """A leaf block: its text, how much of it is in links, and its innermost element."""

    __slots__ = ("text", "linked", "inside")

    def __init__(self, text: str, linked: int, inside: Element | None):
        self.text, self.linked, self.inside = text, linked, inside


class Open:
    """The open elements, with their places by tag, so that no step walks them all."""

    def __init__(self) -> None:
        self.stack: list[Element] = []
        self.places: dict[str, list[int]] = {}
        self.loose: list[int] = []  # places of raw elements that nothing closes
        self.closed: list[int] = []  # and of those that something does

    def last(self, *tags: str) -> int:
        """The innermost place of any of the tags, or -1."""
        return max((p[-1] for t in tags if (p := self.places.get(t))), default=-1)

    def push(self, tag: str, names: str, loose: bool) -> None:
        place = len(self.stack)
        self.stack.append(Element(tag, names, self.stack[-1] if self.stack else None))
        self.places.setdefault(tag, []).append(place)
        if tag in RAW:
            (self.loose if loose else self.closed).append(place)

    def pop_to(self, k: int) -> None:
        while len(self.stack) > k:
            self.places[self.stack.pop().tag].pop()
        for raw in (self.loose, self.closed):
            while raw and raw[-1] >= k:
                raw.pop()


def closed_starts(html: str, tag: str) -> set[int]:
    """Where the start tags of ``tag`` that an end tag closes end."""
    out: set[int] = set()
    waiting: list[int] = []
    for m in MARKUP.finditer(html):
        end, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name or name.lower() != tag:
            continue
        if not end and not CLOSES_ITSELF.search(attributes):
            waiting.append(m.end())
        elif end and waiting:
            out.add(waiting.pop())
    return out


def blocks_of(html: str) -> list[Block]:
    """The leaf blocks of a page that have text, in page order. Character
    references are decoded, white space becomes one space."""
    out: list[Block] = []
    open_ = Open()
    parts: list[str] = []
    closed: dict[str, set[int]] = {}
    linked = links = at = 0

    def flush() -> None:
        nonlocal parts, linked
        text = " ".join(unescape("".join(parts)).split()) if parts else ""
        if text and not open_.loose and not open_.closed:
            out.append(Block(text, linked, open_.stack[-1] if open_.stack else None))
        parts, linked = [], 0

    def pop_to(k: int) -> None:
        nonlocal links
        flush()
        open_.pop_to(k)
        links = 0

    while at < len(html):
        m = MARKUP.search(html, at)
        text = html[at : m.start() if m else len(html)]
        if text:
            parts.append(text)
            linked += len(text) if links > 0 else 0
        if not m:
            break
        at = m.end()
        end, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if end:
            if tag == "a":
                links = max(0, links - 1)
            elif tag in BLOCK_TAGS or tag in RAW:
                pop_to(k) if (k := open_.last(tag)) >= 0 else flush()
            continue
        if tag in RAW and CLOSES_ITSELF.search(attributes):
            flush()
            continue
        if tag in OPAQUE:
            close = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(html, at)
            at = close.end() if close else len(html)
            if tag in ("title", "textarea"):
                flush()
            continue
        if tag == "a":
            links += 1
        elif tag == "br" or tag == "wbr":
            parts.append(" ")
        elif tag == "hr":
            flush()
        elif (tag in BLOCK_TAGS or tag in RAW) and tag not in VOID:
            if tag in CLOSES_P and open_.stack and open_.stack[-1].tag == "p":
                pop_to(len(open_.stack) - 1)
            if tag in SELF_CLOSING and (k := open_.last(*SELF_CLOSING[tag])) >= open_.last(*(SCOPES - SELF_CLOSING[tag])) and k >= 0:
                pop_to(k)
            if tag in BLOCK_TAGS and tag not in ("head", "title") and open_.places.get("head"):  # a head that nothing closed
                pop_to(open_.places["head"][0])
            if open_.loose and tag in BLOCK_TAGS - INNER:
                k = bisect_right(open_.loose, open_.closed[-1] if open_.closed else -1)
                if k < len(open_.loose):
                    pop_to(open_.loose[k])
            flush()
            links = 0
            names = " ".join(a or b or c for a, b, c in NAMED.findall(attributes)) if "=" in attributes else ""
            loose = False
            if tag in RAW and tag != "head":
                if tag not in closed:
                    closed[tag] = closed_starts(html, tag)
                loose = at not in closed[tag]
            open_.push(tag, names.lower(), loose)
    flush()
    return out


def marks_of(inside: Element | None, made: dict[Element | None, frozenset[str]], known: Container[str] | None) -> frozenset[str]:
    """The features of an element and all that it stands in, those ``known`` only
    if given. An element that adds none shares its parent's, so a deep page costs
    no more than a flat one."""
    path = []
    while inside not in made:
        path.append(inside)
        inside = inside.above
    marks = made[inside]
    for e in reversed(path):
        own = {f"name={w}" for w in LETTERS.findall(e.names)} if e.names else set()
        if e.tag not in ("html", "body", "div"):
            own.add(f"in={e.tag}")
        own = {x for x in own if x not in marks and (known is None or x in known)}
        marks = made[e] = marks | own if own else marks
    return marks


def features(blocks: Sequence[Block], known: Container[str] | None = None) -> list[list[str]]:
    """The names of each block's binary features; of those of its elements only
    ``known`` ones, if given."""
    out = []
    made: dict[Element | None, frozenset[str]] = {None: frozenset()}
    for k, b in enumerate(blocks):
        n = b.text.count(" ") + 1
        tag = b.inside.tag if b.inside else "none"
        f = ["bias", f"tag={tag}", f"words={min(n.bit_length(), 7)}", f"links={min(4, 4 * b.linked // max(1, len(b.text)))}"]
        f += marks_of(b.inside, made, known)
        f.append(f"end={b.text[-1]}" if b.text[-1] in ".!?:" else "end=other")
        f.append(f"commas={min(3, b.text.count(','))}")
        if "©" in b.text:
            f.append("copyright")
        if k == 0:
            f.append("first")
        if k == len(blocks) - 1:
            f.append("last")
        out.append(f)
    return out


class Field:
    """A two-label chain: weights of the features, and of label pairs."""

    def __init__(self, index: dict[str, int], weights: np.ndarray, pairs: np.ndarray):
        self.index, self.weights, self.pairs = index, weights, pairs

    def decode(self, blocks: Sequence[Block]) -> list[int]:
        """The most likely labels (Viterbi); ties go to main text."""
        if not blocks:
            return []
        scores = []
        for f in features(blocks, self.index):
            at = [self.index[x] for x in f if x in self.index]
            scores.append(self.weights[at].sum(axis=0) if at else np.zeros(2))
        (aa, ab), (ba, bb) = self.pairs.tolist()
        s0, s1 = scores[0].tolist()
        back = []
        for e in scores[1:]:
            e0, e1 = e.tolist()
            from0, from1 = int(s1 + ba >= s0 + aa), int(s1 + bb >= s0 + ab)
            back.append((from0, from1))
            s0, s1 = (s1 + ba if from0 else s0 + aa) + e0, (s1 + bb if from1 else s0 + ab) + e1
        labels = [int(s1 >= s0)]
        for step in reversed(back):
            labels.append(step[labels[-1]])
        return labels[::-1]


def likelihood(pages: Sequence[tuple[str, Sequence[int]]], ridge: float = 0.002) -> tuple[dict[str, int], Callable[[np.ndarray], tuple[float, np.ndarray]]]:
    """The features of labelled pages, and the penalised mean log-likelihood with
    its gradient, as a function of all weights in one vector: two for each
    feature, then the four of label pairs."""
    made = [(features(blocks_of(html)), np.array(labels)) for html, labels in pages]
    made = [(f, y) for f, y in made if len(f) == len(y) and len(y)]
    names = sorted({x for f, _ in made for b in f for x in b})
    index = {x: k for k, x in enumerate(names)}
    longest, n = max(len(y) for _, y in made), len(made)
    labels, mask = np.zeros((n, longest), int), np.zeros((n, longest), bool)
    rows, columns = [], []
    for p, (f, y) in enumerate(made):
        labels[p, : len(y)], mask[p, : len(y)] = y, True
        for k, b in enumerate(f):
            rows += [p * longest + k] * len(b)
            columns += [index[x] for x in b]
    rows, columns = np.array(rows), np.array(columns)
    truth = np.eye(2)[labels] * mask[..., None]
    both = mask[:, 1:, None, None] & True
    pair_truth = np.einsum("pki,pkj->ij", truth[:, :-1], truth[:, 1:])

    def value(all_: np.ndarray) -> tuple[float, np.ndarray]:
        w, t = all_[:-4].reshape(-1, 2), all_[-4:].reshape(2, 2)
        e = np.zeros((n * longest, 2))
        for c in (0, 1):
            e[:, c] = np.bincount(rows, w[columns, c], n * longest)
        e = e.reshape(n, longest, 2)
        fwd, bwd = e.copy(), np.zeros_like(e)
        for k in range(1, longest):
            fwd[:, k] += np.logaddexp.reduce(fwd[:, k - 1, :, None] + t, axis=1)
        last = mask.sum(axis=1) - 1
        for k in range(longest - 2, -1, -1):
            step = np.logaddexp.reduce(t + (e[:, k + 1] + bwd[:, k + 1])[:, None, :], axis=2)
            bwd[:, k] = np.where((k < last)[:, None], step, 0)
        total = np.logaddexp.reduce(fwd[np.arange(n), last], axis=1)
        single = np.exp(np.where(mask[..., None], fwd + bwd - total[:, None, None], -np.inf))
        joint = fwd[:, :-1, :, None] + t + (e + bwd)[:, 1:, None, :] - total[:, None, None, None]
        joint = np.where(both, np.exp(np.where(both, joint, 0)), 0).sum(axis=(0, 1))
        gap = (truth - single).reshape(-1, 2)
        gw = np.stack([np.bincount(columns, gap[rows, c], len(names)) for c in (0, 1)], axis=1)
        score = (truth * e).sum() + (pair_truth * t).sum() - total.sum()
        return float(score / n - ridge / 2 * (all_ @ all_)), np.concatenate([gw.ravel(), (pair_truth - joint).ravel()]) / n - ridge * all_

    return index, value


def highest(value: Callable[[np.ndarray], tuple[float, np.ndarray]], size: int, tolerance: float, most_steps: int, memory: int = 10) -> np.ndarray:
    """Where a smooth concave function is highest, by L-BFGS from zero: until no
    entry of the gradient exceeds ``tolerance``."""
    x = np.zeros(size)
    f, g = value(x)
    pairs: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(most_steps):
        if np.abs(g).max() <= tolerance:
            return x
        q, used = g.copy(), []
        for s, y, r in reversed(pairs):
            used.append(a := r * (s @ q))
            q -= a * y
        q *= (1 / (pairs[-1][2] * (pairs[-1][1] @ pairs[-1][1]))) if pairs else 1 / max(1, np.linalg.norm(g))
        for (s, y, r), a in zip(pairs, reversed(used), strict=True):
            q += s * (a - r * (y @ q))
        step = 1.0
        while (new := value(x + step * q))[0] < f + 1e-4 * step * (g @ q) and step > 1e-12:
            step /= 2
        s, y = step * q, g - new[1]
        if s @ y > 1e-14:
            pairs = [*pairs[1 - memory :], (s, y, 1 / (s @ y))]
        x, (f, g) = x + s, new
    raise RuntimeError(f"not fitted in {most_steps} steps: the gradient is {np.abs(g).max():.1e}")


def fit(pages: Sequence[tuple[str, Sequence[int]]], ridge: float = 0.002, tolerance: float = 1e-4, most_steps: int = 1_000) -> Field:
    """The field of greatest penalised likelihood; an error if that is not found."""
    index, value = likelihood(pages, ridge)
    best = highest(value, 2 * len(index) + 4, tolerance, most_steps)
    return Field(index, best[:-4].reshape(-1, 2), best[-4:].reshape(2, 2))


@lru_cache(maxsize=4)
def fitted(pages: int = TRAINING_PAGES, seed: int = 0) -> Field:
    return fit(labelled_pages(pages, seed))


def main_text(html: str | None, field: Field) -> str:
    """The blocks labelled main text, one to a line; null or none: empty."""
    blocks = blocks_of(html or "")
    return "\n".join(b.text for b, y in zip(blocks, field.decode(blocks), strict=True) if y)


def extract(pages: DataFrame, field: Field | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: (id_col, url_col, text, n_chars).

    ``text`` is the main text of the whole page, empty if there is none or the
    html is null; ``n_chars`` its code points. Null ids and URLs stay null;
    repeated pages each give a row; pages are read whole, whatever their length;
    blocks as likely to be main text as not are; an empty table gives none;
    other columns are not read.
    """
    field = field or fitted()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h, field) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [id_col, url_col, "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("long").alias(id_col), F.col(url_col).cast("string").alias(url_col), F.col(html_col).cast("string").alias(html_col))
    return rows.mapInArrow(run, f"`{id_col}` long, `{url_col}` string, text string, n_chars long")
