"""Main text of web pages: a recurrent labeller reads every leaf block of a page in order, both ways, and keeps the article."""

from __future__ import annotations

import html
import math
import random
import re
import zlib
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .scratch import small_batches

# Fixed values of the HTML standard: elements whose content is text up to their end tag, elements whose content is not
# shown as text, void elements, elements inside a line, elements that their next sibling closes, elements that end an
# open paragraph, and elements that end an open drawing or formula.
RAW = {"script", "style", "textarea", "title", "iframe", "xmp", "noframes"}
UNSEEN = {"noscript", "template", "select", "object", "canvas", "svg", "math"}
FOREIGN = {"svg", "math"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark",
    "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img", "br", "nobr",
}
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDS_P = {
    "address", "article", "aside", "blockquote", "div", "dl", "fieldset", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
    "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul",
}

BREAKS_OUT = {
    "b", "big", "blockquote", "body", "br", "center", "code", "dd", "div", "dl", "dt", "em", "embed", "h1", "h2", "h3", "h4", "h5", "h6", "head", "hr", "i",
    "img", "li", "listing", "menu", "meta", "nobr", "ol", "p", "pre", "ruby", "s", "small", "span", "strong", "strike", "sub", "sup", "table", "tt", "u", "ul", "var",
}
HTML_INSIDE = {"foreignobject", "desc", "title", "annotation-xml"}

#: Elements deeper than this are not nested any further (browsers have such a limit too); of a deep path the labeller
#: sees the outermost and innermost elements, of an element with very many names the first. No text depends on it.
DEPTH, OUTER, INNER, NAMES = 256, 16, 48, 16
PATH_DIM, WORD_DIM, MORE = 512, 64, 6
REST = WORD_DIM + MORE
HIDDEN = 24

#: Comments and the like, or a tag: end mark, name, attributes. No part of it can be read in two ways, so that a page is
#: read once, however broken: a tag that never ends goes to the page's end.
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|</(?![a-zA-Z])[^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?)*+)(?:>|\Z)",
    re.S,
)
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME_PARTS = re.compile(r"[a-z]+")
_SPLIT_CASE = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass
class Block:
    path: tuple[str, ...]
    text: str
    linked: int


def _read_marks(tag: str, attributes: str) -> tuple[str, ...]:
    """The element's name, and the parts of its class, id and role."""
    parts = [tag]
    for m in _NAMED.finditer(attributes):
        value = html.unescape(m[2] or m[3] or m[4] or "")
        parts += [f".{p}" for p in _NAME_PARTS.findall(_SPLIT_CASE.sub(" ", value).lower())]
    return tuple(parts[: NAMES + 1])


_kept_marks = lru_cache(maxsize=20_000)(_read_marks)


def _marks(tag: str, attributes: str) -> tuple[str, ...]:
    return _kept_marks(tag, attributes) if len(attributes) < 256 else _read_marks(tag, attributes)


def _self_closed(attributes: str) -> bool:
    """Whether a tag's last slash ends the element: it does unless it belongs to a value without quotes."""
    if not attributes.endswith("/"):
        return False
    tail = attributes.rsplit(None, 1)[-1]
    before, sign, value = tail.partition("=")
    if sign:
        return value[:1] in ('"', "'")
    return not attributes[: -len(tail)].rstrip().endswith("=")


class _Page:
    """What is open at a place in a page, and the blocks so far."""

    def __init__(self, page: str):
        self.page, self.out = page, []
        self.open: list[tuple[str, tuple[str, ...]]] = []
        self.count: Counter[str] = Counter()  # open elements by name
        self.over: Counter[str] = Counter()  # elements that were too deep to be nested
        self.link = -1  # elements that were open when the open link began
        self.text: list[str] = []
        self.linked = 0
        self.path: tuple[str, ...] | None = None
        self.last: dict[str, int] = {}

    def flush(self) -> None:
        joined = " ".join("".join(self.text).split())
        if joined:
            if self.path is None:
                some = self.open if len(self.open) <= OUTER + INNER else self.open[:OUTER] + self.open[-INNER:]
                self.path = tuple(m for _, marks in some for m in marks)
            self.out.append(Block(self.path, joined, self.linked))
        self.text.clear()
        self.linked = 0

    def add(self, piece: str) -> None:
        self.text.append(html.unescape(piece))
        if self.link >= 0:
            self.linked += len(piece)

    def push(self, tag: str, attributes: str) -> None:
        if len(self.open) >= DEPTH:
            self.over[tag] += 1
            return
        self.open.append((tag, _marks(tag, attributes)))
        self.count[tag] += 1
        self.path = None

    def pop(self) -> str:
        tag, _ = self.open.pop()
        self.count[tag] -= 1
        self.path = None
        if len(self.open) < self.link:
            self.link = -1
        return tag

    def close(self, tag: str) -> None:
        if self.over[tag]:
            self.over[tag] -= 1
        elif self.count[tag]:
            while self.pop() != tag:
                pass

    def last_end(self, tag: str) -> int:
        """Where the page's last end tag of this name begins; -1: nowhere."""
        if tag not in self.last:
            self.last[tag] = max((m.start() for m in _end_tag(tag).finditer(self.page)), default=-1)
        return self.last[tag]


@lru_cache(maxsize=64)
def _end_tag(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*+>", re.I)


def blocks(page: str, passed: frozenset[str] = frozenset()) -> list[Block]:
    """Leaf blocks of a page in order: text that no block element interrupts, with the path of elements around it.

    One pass, linear in the page's length however broken it is. An element that is not shown and has no end tag is
    passed over alone, so that it hides nothing of the page; `passed`: names of such that one pass has shown.
    """
    s = _Page(page)
    hidden, nested, inside = "", 0, 0  # the unseen element that is open, how often, and HTML parts open in a drawing
    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        start = n if m is None else m.start()
        if start > at and not hidden:
            s.add(page[at:start])
        if m is None:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag, is_end = m[2].lower(), bool(m[1])
        closed = not is_end and _self_closed(m[3])
        foreign = hidden in FOREIGN
        if tag in RAW and not is_end and not (foreign and (closed or tag == "title")):
            if at <= s.last_end(tag):
                at = _end_tag(tag).search(page, at).end()
            elif not closed:
                break
            continue
        if hidden:
            if tag == hidden:
                nested += 0 if closed else -1 if is_end else 1
                if nested == 0 or start >= s.last_end(tag):
                    hidden = ""
                continue
            if not foreign:
                continue
            if tag in HTML_INSIDE:
                inside = max(0, inside + (0 if closed else -1 if is_end else 1))
                continue
            if inside or is_end or tag not in BREAKS_OUT:
                continue
            hidden = ""
        if tag in UNSEEN:
            if not is_end and not closed and at <= s.last_end(tag) and tag not in passed:
                hidden, nested, inside = tag, 1, 0
            continue
        if tag in INLINE:
            if tag == "br":
                s.text.append(" ")
            elif tag == "a":
                s.link = -1 if is_end or closed else len(s.open)
            continue
        s.flush()
        if is_end:
            s.close(tag)
            continue
        if tag in VOID:
            continue
        if tag in ENDS_P and s.count["p"]:
            while s.pop() != "p":
                pass
        while s.open and s.open[-1][0] in CLOSES.get(tag, ()):
            s.pop()
        if not closed:
            s.push(tag, m[3])
    s.flush()
    return blocks(page, passed | {hidden}) if hidden else s.out


def _hash(x: str) -> int:
    return zlib.crc32(x.encode("utf-8", "replace")) % PATH_DIM


@lru_cache(maxsize=5_000)
def _path_vector(path: tuple[str, ...]) -> tuple[int, ...]:
    last = next((m for m in reversed(path) if m[0] != "."), "")
    return tuple({_hash(m) for m in path} | {_hash(f"last:{last}")})


def vectors(page_blocks: list[Block]) -> tuple[list[tuple[str, ...]], np.ndarray]:
    """For each block its tag path, and a vector of its words (hashed, unit length) and a few measures."""
    x = np.zeros((len(page_blocks), REST), np.float32)
    for row, b in zip(x, page_blocks, strict=True):
        words = b.text.lower().split()
        counts = np.bincount([zlib.crc32(w.encode("utf-8", "replace")) % WORD_DIM for w in words], minlength=WORD_DIM)
        row[:WORD_DIM] = counts / math.sqrt(counts @ counts)
        chars = len(b.text)
        marks = sum(b.text.count(c) for c in ",.;")
        row[WORD_DIM:] = (math.log1p(len(words)) / 5, min(1.0, b.linked / chars), b.text[-1] in ".!?…\"'”", marks / chars * 10, len(words) < 4, len(b.path) / 20)
    return [b.path for b in page_blocks], x


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Batch:
    """Pages padded to one length: rows of distinct paths, the path of each block, its vector, 1 where there is a block."""

    paths: np.ndarray
    which: np.ndarray
    rest: np.ndarray
    mask: np.ndarray


def batch(pages: list[tuple[list[tuple[str, ...]], np.ndarray]]) -> Batch:
    t = max(len(x) for _, x in pages)
    known: dict[tuple[str, ...], int] = {}
    which, rest = np.zeros((len(pages), t), np.int64), np.zeros((len(pages), t, REST), np.float32)
    mask = np.zeros((len(pages), t), np.float32)
    for k, (paths, x) in enumerate(pages):
        which[k, : len(x)] = [known.setdefault(p, len(known)) for p in paths]
        rest[k, : len(x)] = x
        mask[k, : len(x)] = 1
    rows = np.zeros((max(1, len(known)), PATH_DIM), np.float32)
    for path, k in known.items():
        rows[k, list(_path_vector(path))] = 1
    return Batch(rows, which, rest, mask)


class Labeller:
    """Bidirectional LSTM with a logistic output for each block, in numpy."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.p = {"out": rng.normal(0, 0.1, 2 * HIDDEN), "bias": np.zeros(1)}
        for d in "fb":
            self.p |= {
                f"t{d}": rng.normal(0, 0.08, (PATH_DIM, 4 * HIDDEN)), f"w{d}": rng.normal(0, 0.08, (REST, 4 * HIDDEN)),
                f"u{d}": rng.normal(0, 0.15, (HIDDEN, 4 * HIDDEN)), f"c{d}": np.zeros(4 * HIDDEN),
            }
            self.p[f"c{d}"][HIDDEN : 2 * HIDDEN] = 1.0
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _run(self, d: str, b: Batch, keep: bool, state: tuple[np.ndarray, np.ndarray] | None = None):
        """(hidden states, what gradients need, last state) of one direction; where there is no block the state stays as it is."""
        n, t = b.which.shape
        z = (b.paths @ self.p[f"t{d}"])[b.which] + b.rest @ self.p[f"w{d}"] + self.p[f"c{d}"]
        h, c = state or (np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32))
        hs, cache = np.zeros((n, t, HIDDEN), np.float32), []
        for k in range(t) if d == "f" else range(t - 1, -1, -1):
            g = z[:, k] + h @ self.p[f"u{d}"]
            s = _sigmoid(g[:, : 3 * HIDDEN])
            i, f, o = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :]
            a = np.tanh(g[:, 3 * HIDDEN :])
            m = b.mask[:, k, None]
            c2 = m * (f * c + i * a) + (1 - m) * c
            tc = np.tanh(c2)
            h2 = m * (o * tc) + (1 - m) * h
            if keep:
                cache.append((k, h, c, i, f, o, a, tc, m))
            h, c = h2, c2
            hs[:, k] = h
        return hs, cache, (h, c)

    def predict(self, b: Batch) -> np.ndarray:
        hs = np.concatenate([self._run(d, b, False)[0] for d in "fb"], axis=2)
        return _sigmoid(hs @ self.p["out"] + self.p["bias"])

    def predict_long(self, page_blocks: list[Block], step: int = 2048) -> np.ndarray:
        """As predict, for one page of any length: its blocks go through in parts, the state from each to the next."""
        z = np.full(len(page_blocks), self.p["bias"][0], np.float32)
        for j, d in enumerate("fb"):
            state, out = None, self.p["out"][j * HIDDEN : (j + 1) * HIDDEN]
            starts = range(0, len(page_blocks), step)
            for lo in starts if d == "f" else reversed(starts):
                hs, _, state = self._run(d, batch([vectors(page_blocks[lo : lo + step])]), False, state)
                z[lo : lo + step] += hs[0] @ out
        return _sigmoid(z)

    def gradients(self, b: Batch, y: np.ndarray) -> dict[str, np.ndarray]:
        runs = {d: self._run(d, b, True) for d in "fb"}
        hs = np.concatenate([runs[d][0] for d in "fb"], axis=2)
        dz = (_sigmoid(hs @ self.p["out"] + self.p["bias"]) - y) * b.mask / b.mask.sum()
        grads = {"out": np.einsum("ntk,nt->k", hs, dz), "bias": np.array([dz.sum()])}
        for j, d in enumerate("fb"):
            dhs = dz[:, :, None] * self.p["out"][j * HIDDEN : (j + 1) * HIDDEN]
            dg_all = np.zeros((*b.which.shape, 4 * HIDDEN), np.float32)
            du = np.zeros_like(self.p[f"u{d}"])
            dh, dc = np.zeros((len(y), HIDDEN), np.float32), np.zeros((len(y), HIDDEN), np.float32)
            for k, h, c, i, f, o, a, tc, m in reversed(runs[d][1]):
                dh = dh + dhs[:, k]
                dc_in = dc + m * dh * o * (1 - tc**2)
                dgate = np.concatenate([dc_in * a * i * (1 - i), dc_in * c * f * (1 - f), dh * tc * o * (1 - o), dc_in * i * (1 - a**2)], axis=1) * m
                dg_all[:, k] = dgate
                du += h.T @ dgate
                dh = dgate @ self.p[f"u{d}"].T + (1 - m) * dh
                dc = m * dc_in * f + (1 - m) * dc
            flat = dg_all.reshape(-1, 4 * HIDDEN)
            by_path = np.zeros((len(b.paths), 4 * HIDDEN), np.float32)
            np.add.at(by_path, b.which.ravel(), flat)
            grads |= {f"t{d}": b.paths.T @ by_path, f"w{d}": b.rest.reshape(-1, REST).T @ flat, f"u{d}": du, f"c{d}": flat.sum(0)}
        return grads


def made_pages(n: int = 900, seed: int = 21) -> list[list[tuple[Block, int]]]:
    """Labelled pages by rule: an article among menus, headers, adverts, notices, sidebars, forms, comments and footers.

    Words are invented, so that what is learned rests on structure, length and place, not on a language.
    """
    r = random.Random(seed)
    syllables = [a + b for a in "b c d f g l m n p r s t v st th ch tr".split() for b in ("a", "e", "i", "o", "u", "en", "er", "on")]
    vocabulary = ["".join(r.choice(syllables) for _ in range(r.randint(1, 4))) for _ in range(3000)]

    def words(k: int) -> str:
        return " ".join(r.choice(vocabulary) + (r.choice(",.") if r.random() < 0.12 else "") for _ in range(k))

    def link(path: list[str]) -> tuple[Block, int]:
        t = words(r.randint(1, 3))
        return Block(tuple(path), t, len(t)), 0

    def bar(tag: str, *names: str, wrap: tuple[str, ...] = ("ul", "li")) -> list[tuple[Block, int]]:
        path = [tag, *(f".{x}" for x in names), *wrap]
        return [link(path) for _ in range(r.randint(1, 9))]

    def prose(path: list[str], least: int, most: int, label: int, linked: float = 0.0) -> tuple[Block, int]:
        t = words(r.randint(least, most))
        t = t[0].upper() + t[1:] + r.choice([".", ".", ".", "", "!"])
        return Block(tuple(path), t, int(len(t) * linked)), label

    def before() -> list[list[tuple[Block, int]]]:
        return [
            bar("nav", *r.choice([(), ("menu",), ("main", "nav"), ("navbar",), ("navigation",)])),
            bar(r.choice(["div", "ul"]), r.choice(["menu", "nav", "navigation", "breadcrumb", "breadcrumbs", "topbar"])),
            [prose(["header", *r.choice([[], [".site", ".header"], [".masthead"]]), r.choice(["p", "h1", "div"])], 1, 9, 0)],
            [prose(["div", r.choice([".header", ".banner", ".masthead", ".top"]), r.choice(["p", "div", "h2"])], 1, 10, 0)],
            [prose(["div", *r.choice([[".ad"], [".ads"], [".advert"], [".advertisement"], [".sponsored"], [".promo"], [".banner", ".ad"]])], 2, 40, 0, r.choice([0, 0.5, 1]))],
            [prose([r.choice(["div", "aside", "section"]), *r.choice([[".cookie", ".notice"], [".cookie", ".banner"], [".consent"], [".notice"], [".gdpr"], [".alert"]]), *r.choice([[], ["p"]])], 4, 40, 0)],
            [prose(["form", *r.choice([[], [".search"], [".login"]]), *r.choice([[], ["p"], ["div"]])], 1, 6, 0)],
        ]

    def after() -> list[list[tuple[Block, int]]]:
        comments = ["section" if r.random() < 0.4 else "div", *r.choice([[".comments"], [".comment", ".list"], [".reader", ".comments"], [".discussion"], [".responses"], [".replies"]])]
        return [
            [prose([r.choice(["aside", "aside", "div"]), r.choice([".sidebar", ".side", ".related", ".widget", ".rail"]), r.choice(["p", "h3", "div"])], 1, 40, 0) for _ in range(r.randint(1, 4))],
            bar(r.choice(["aside", "div"]), r.choice(["sidebar", "related", "widget", "recommended", "popular", "trending"])),
            [prose(["aside", *r.choice([[], ["p"]])], 3, 40, 0)],
            [prose([*comments, *r.choice([[], ["h2"], ["h3"]])], 1, 4, 0), *(prose([*comments, *r.choice([["div", ".comment"], ["li"], ["article", ".comment"]]), *r.choice([[], ["p"]])], 3, 50, 0) for _ in range(r.randint(1, 6)))],
            [prose(["form", *r.choice([[], [".newsletter"], [".subscribe"], [".comment", ".form"]]), *r.choice([[], ["p"], ["div"]])], 1, 14, 0)],
            [prose(["div", r.choice([".ad", ".ads", ".advert", ".promo", ".sponsored", ".newsletter", ".subscribe", ".share", ".social"]), *r.choice([[], ["p"]])], 1, 40, 0)],
            [prose(["footer", *r.choice([[], ["p"], ["div"], [".site", ".footer", "p"]])], 3, 30, 0, r.choice([0, 0, 0.4]))],
            [prose(["div", r.choice([".footer", ".copyright", ".legal"]), *r.choice([[], ["p"]])], 3, 30, 0)],
            bar("footer", *r.choice([(), ("links",)])),
        ]

    pages = []
    for _ in range(n):
        home = r.choice([["article"], ["article"], ["main", "article"], ["main"], ["div", ".content"], ["div", ".article", ".body"], ["div", ".post"], ["div", ".entry", ".content"], ["section", ".story"], ["div", ".main"], ["div", ".text"], []])
        if r.random() < 0.3:
            home = ["div", r.choice([".wrapper", ".container", ".page", ".site", ".layout"]), *home]
        top = ["html", "body"]
        article = [prose([*home, *r.choice([["h1"], ["h1"], ["h2"], ["header", "h1"]])], 2, 14, 1)] if r.random() < 0.9 else []
        for _ in range(r.choice([1, 1, 2, 3, 4, 6, 9, 14])):
            kind = r.random()
            if kind < 0.78:
                article.append(prose([*home, "p"], r.choice([2, 8, 20]), r.choice([20, 60, 160]), 1, r.choice([0, 0, 0, 0.1])))
            elif kind < 0.86:
                article.append(prose([*home, r.choice(["h2", "h3"])], 1, 8, 1))
            elif kind < 0.93:
                article += [prose([*home, r.choice(["ul", "ol"]), "li"], 2, 20, 1) for _ in range(r.randint(2, 4))]
            elif kind < 0.97:
                article.append(prose([*home, "blockquote", *r.choice([[], ["p"]])], 6, 40, 1))
            else:  # something foreign among the paragraphs
                article.append(prose([*home, r.choice(["div", "aside"]), r.choice([".ad", ".advert", ".promo", ".related", ".newsletter"]), *r.choice([[], ["p"]])], 2, 30, 0))
        first, last = before(), after()
        page = [b for part in r.sample(first, r.randint(0, 4)) for b in part] + article + [b for part in r.sample(last, r.randint(0, 5)) for b in part]
        if page:
            pages.append([(Block((*top, *b.path), b.text, b.linked), y) for b, y in page])
    return pages


_trained: dict[tuple[int, int], Labeller] = {}


def train(pages: list[list[tuple[Block, int]]] | None = None, steps: int = 320, seed: int = 3) -> Labeller:
    """A labeller from pages of (block, 1 for the article); by default from made_pages(), once for each process."""
    key = (steps, seed)
    if pages is None and key in _trained:
        return _trained[key]
    data = made_pages() if pages is None else pages
    xs = [vectors([b for b, _ in p]) for p in data]
    ys = [np.array([y for _, y in p], np.float32) for p in data]
    model, rng = Labeller(seed), np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in model.p.items()}
    v = {k: np.zeros_like(w) for k, w in model.p.items()}
    order = np.argsort([len(y) for y in ys], kind="stable")
    for step in range(1, steps + 1):
        lo = int(rng.integers(0, max(1, len(order) - 32)))
        pick = order[lo : lo + 32]
        b = batch([xs[k] for k in pick])
        b.rest[:, :, :WORD_DIM] *= rng.random((*b.which.shape, 1)) < 0.7  # some blocks without words, some paths without marks
        b.paths *= rng.random(b.paths.shape) < 0.93
        y = np.zeros(b.mask.shape, np.float32)
        for k, one in enumerate(pick):
            y[k, : len(ys[one])] = ys[one]
        for k, g in model.gradients(b, y).items():
            m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
            model.p[k] = (model.p[k] - 0.01 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    if pages is None:
        _trained[key] = model
    return model


def extract_texts(model: Labeller, pages: list[str], cells: int = 8_000) -> list[str]:
    """The article blocks of each page, joined by a space."""
    parsed = [blocks(p) for p in pages]
    out = [""] * len(pages)
    order = sorted((k for k, b in enumerate(parsed) if b), key=lambda k: len(parsed[k]))
    while order and len(parsed[order[-1]]) > cells:
        k = order.pop()
        out[k] = " ".join(b.text for b, q in zip(parsed[k], model.predict_long(parsed[k]), strict=True) if q >= 0.5)
    lo = 0
    while lo < len(order):
        hi = lo + 1
        while hi < len(order) and len(parsed[order[hi]]) * (hi + 1 - lo) <= cells and len(parsed[order[hi]]) <= 1.3 * len(parsed[order[lo]]) + 2:
            hi += 1
        p = model.predict(batch([vectors(parsed[k]) for k in order[lo:hi]]))
        for row, k in zip(p, order[lo:hi], strict=True):
            out[k] = " ".join(b.text for b, q in zip(parsed[k], row, strict=False) if q >= 0.5)
        lo = hi
    return out


def extract(pages: DataFrame, model: Labeller | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Pages -> (page_id, url, text, n_chars), a row for each row, whatever its id: repeated rows have theirs each.

    A null or empty page, and one without an article, has an empty text. A page of any length is read whole, in one
    pass; a broken one as browsers do. Other columns are not read. No rows: no rows.
    """
    small_batches(pages.sparkSession)
    held = pages.sparkSession.sparkContext.broadcast(model or train())

    def run(column: pa.Array) -> pa.Array:
        out: list[str] = []
        for lo in range(0, len(column), 256):
            out += extract_texts(held.value, ["" if p is None else p for p in column[lo : lo + 256].to_pylist()])
        return pa.array(out, pa.string())

    text = arrow_udf(run, "string").asNondeterministic()(F.col(html_col))
    out = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), text.alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
