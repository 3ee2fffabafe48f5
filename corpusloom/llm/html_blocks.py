"""Main text of web pages by a recurrent block labeller.

A page is cut into blocks: stretches of text under one block-level element, in page order, each
with the path of open elements above it. Scripts, styles, comments and the head are no text. Each
block becomes a vector of hashed path parts (element names, and the parts of class, id and role),
hashed words, and a few measures (length, links, punctuation, place). A bidirectional LSTM in numpy
reads the vectors of the whole page and gives every block the chance to be main text; blocks at 0.5
or more are kept. Pages of more than ``LONG`` blocks are read in stretches, forward and then backward,
so what is held is the blocks and one number for each, and no page is cut.

The weights are trained here, on the driver, from a fixed seed, on pages that :func:`made_page`
invents: layouts of articles among menus, headers, footers, sidebars, notices, adverts, forms and
reader comments, with blocks that tell their kind by name and blocks that only their neighbours tell. No
row of the input is used for training.

Defined cases: null, empty or text-free html gives empty text; unclosed elements end with what holds
them, but an unclosed script or style goes to the end of the page, as in browsers; a page without any
markup is one block; elements may be nested to any depth; repeated rows give equal results; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import html
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship
from .workers import tidied

PATH_DIMS, WORD_DIMS, MEASURES = 320, 32, 9
WIDTH = PATH_DIMS + WORD_DIMS + MEASURES
HIDDEN = 16
#: Training: invented pages, passes over them, pages a step, rate.
PAGES, PASSES, STEP, RATE, SEED = 1500, 6, 30, 0.015, 7

#: Blocks of the longest page that is read at once, and blocks of the pages that are read side by side.
LONG, TOGETHER = 20_000, 30_000

INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that hold no text of the page: those whose content is raw up to the end tag, and those that hold elements.
RAW = frozenset("script style title iframe textarea xmp noembed noframes".split())
NESTED = frozenset("noscript template svg math object canvas audio video".split())
#: Elements whose start ends an open one of these, looked for up to the nearest holder.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "body": ("head",)}
ENDED = frozenset(["p", *(x for names in ENDS.values() for x in names)])
HOLDERS = frozenset("ul ol dl table tbody thead tfoot select body html div section article aside form blockquote".split())
#: Attributes by the states of HTML: a quote opens a value right after the equals sign only, and a name or a plain value may hold
#: quotes. A quoted value that never ends is none, so the tag ends at the next ``>`` and what follows stays.
BLANK = r"[ \t\n\f\r]"
ATTRIBUTE = rf"""([^ \t\n\f\r/>][^ \t\n\f\r/>=]*+)(?:{BLANK}*+={BLANK}*+(?:"([^"]*)"|'([^']*)'|(?=>|\Z)|([^ \t\n\f\r>"'][^ \t\n\f\r>]*+)))?+"""
UNNAMED = re.sub(r"(?<!\\)\((?!\?)", "(?:", ATTRIBUTE)
COMMENT = r"<!--(?:-?>|.*?(?:--!?>|\Z))"
MARKUP = re.compile(rf"{COMMENT}|<(/?)([a-zA-Z][^ \t\n\f\r/>]*+)((?:[ \t\n\f\r/]++|{UNNAMED})*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)|([^<]+|<)", re.S)
ATTRIBUTES = re.compile(ATTRIBUTE)
NAMING = frozenset(("class", "id", "role"))
PARTS = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")
HEAD_ENDS = re.compile(r"</head|<body", re.I | re.A)


@lru_cache(maxsize=64)
def end_of(tag: str) -> re.Pattern:
    """The start of an element's end tag, by ASCII letters of either case."""
    return re.compile(rf"</{tag}(?=[ \t\n\f\r/>])", re.I | re.A)


def behind(page: str, tag: str, at: int) -> int:
    """Where a hidden element that starts right before ``at`` ends; -1 if it never does.

    Raw content ends at the first end tag. Other content is read tag by tag, as an end tag may stand in a value or a comment.
    """
    if tag in RAW:
        found = end_of(tag).search(page, at)
        return MARKUP.match(page, found.start()).end() if found else -1
    depth = 1
    while at < len(page):
        m = MARKUP.match(page, at)
        at = m.end()
        name = m[2].lower() if m[2] else ""
        if name == tag:
            depth += -1 if m[1] else 0 if m[0].endswith("/>") else 1
            if not depth:
                return at
        elif name in RAW and not m[1] and not m[0].endswith("/>"):
            at = behind(page, name, at)
            if at < 0:
                return -1
    return -1


def naming(attributes: str) -> str:
    """The values of class, id and role."""
    return " ".join(html.unescape(a or b or c) for name, a, b, c in ATTRIBUTES.findall(attributes) if name.lower() in NAMING)


class Node:
    """An open element: bits of its own path parts, and of all that hold it."""

    __slots__ = ("above", "depth", "ended", "own", "parent", "tag")

    def __init__(self, parent: "Node | None", tag: str, own: int):
        self.parent, self.tag, self.own = parent, tag, own
        self.depth, self.above = (parent.depth + 1, parent.above | parent.own) if parent else (1, 0)
        #: The nearest element here or above that a start tag may end.
        self.ended = self if tag in ENDED else None if tag in HOLDERS or parent is None else parent.ended


class Block:
    __slots__ = ("linked", "node", "text")

    def __init__(self, node: Node | None, text: str, linked: int):
        self.node, self.text, self.linked = node, text, linked


@lru_cache(maxsize=50_000)
def part_bits(tag: str, names: str) -> int:
    """The slots of an element's name and of the parts of its naming attributes."""
    bits = 0
    if tag not in ("html", "body", "div", "section"):
        bits |= 1 << slot("<" + tag, PATH_DIMS)
    for name in {x.lower() for x in PARTS.findall(names)}:
        bits |= 1 << slot("." + name, PATH_DIMS)
    return bits


def blocks(page: str) -> list[Block]:
    """The blocks with text, in page order, each with the element that holds it."""
    found: list[Block] = []
    node: Node | None = None
    opened: Counter = Counter()
    parts: list[str] = []
    links = linked = 0

    def close() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                found.append(Block(node, text, linked))
            parts.clear()
        linked = 0

    def leave(last: Node) -> None:
        """Close elements up to and with ``last``."""
        nonlocal node
        while True:
            opened[node.tag] -= 1
            gone, node = node, node.parent
            if gone is last:
                return

    at = 0
    shut: set[str] = set()  # hidden elements of which the rest of the page has no end
    while at < len(page):
        m = MARKUP.match(page, at)
        at = m.end()
        text = m[4]
        if text is not None:
            parts.append(text)
            if links:
                linked += len(text)
            continue
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in INLINE and not (tag == "ins" and opened[tag]):
                if tag == "a" and links:
                    links -= 1
                elif tag == "br":
                    parts.append(" ")
                continue
            if opened[tag]:
                close()
                last = node
                while last.tag != tag:
                    last = last.parent
                leave(last)
                links = 0
            elif tag == "p":
                close()
            continue
        if tag in RAW or tag in NESTED:
            if not m[0].endswith("/>") and tag not in shut:
                end = behind(page, tag, at)
                if end >= 0:
                    at = end
                elif tag in RAW:
                    at = len(page)
                else:
                    shut.add(tag)
            continue
        if tag == "head":
            if ends := HEAD_ENDS.search(page, at):
                at = ends.start()
            continue
        if tag in INLINE and not (tag == "ins" and m[3].strip()):  # a named ins is a slot for adverts
            if tag == "a":
                links += 1
            elif tag == "br":
                parts.append(" ")
            continue
        close()
        links = 0
        if tag in VOID:
            continue
        ending = ENDS.get(tag, ())
        near = node.ended if node else None
        while near:
            if near.tag in ending or near.tag == "p":
                leave(near)
                if not ending or near.tag in ending and tag != "tr":
                    break
                near = node.ended if node else None
            else:
                near = near.parent.ended if near.parent else None
        node = Node(node, tag, part_bits(tag, naming(m[3]) if m[3] else ""))
        opened[tag] += 1
    close()
    return found


def slot(word: str, size: int) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % size


def weights(bits: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bits.to_bytes(PATH_DIMS // 8, "little"), np.uint8), bitorder="little").astype(np.float32)


class Reader:
    """Blocks to vectors; paths are looked up once."""

    def __init__(self):
        self.paths: dict[tuple[str, int, int], np.ndarray] = {}

    def path(self, node: Node | None) -> np.ndarray:
        """Slots of the element and the two above it weigh 1, all others above 0.7."""
        if node is None:
            return np.zeros(PATH_DIMS, np.float32)
        near, top = node.own | 1 << slot("<<" + node.tag, PATH_DIMS), node
        for _ in range(2):
            if top.parent:
                top = top.parent
                near |= top.own
        key = (node.tag, near, top.above)
        found = self.paths.get(key)
        if found is None:
            found = np.maximum(weights(near), np.float32(0.7) * weights(top.above))
            if len(self.paths) > 50_000:
                self.paths.clear()
            self.paths[key] = found
        return found

    def page(self, page: list[Block], first: int = 0, last: int | None = None) -> np.ndarray:
        """The vectors of the blocks from ``first`` up to ``last``."""
        last = len(page) if last is None else min(last, len(page))
        out = np.zeros((last - first, WIDTH), np.float32)
        for k, i in enumerate(range(first, last)):
            b = page[i]
            text = b.text
            words = text.lower().split()
            n, chars = len(words), len(text)
            out[k, :PATH_DIMS] = self.path(b.node)
            hashed = np.bincount([slot(w, WORD_DIMS) for w in words], minlength=WORD_DIMS)
            out[k, PATH_DIMS : PATH_DIMS + WORD_DIMS] = 0.5 * hashed / np.linalg.norm(hashed)
            ends = text.count(". ") + text.count("! ") + text.count("? ") + (text[-1] in ".!?")
            out[k, PATH_DIMS + WORD_DIMS :] = (
                math.log1p(n) / 4, math.log1p(chars) / 6, min(1, b.linked / chars), min(1, ends / 3), text.count(",") / n, (i + 1) / len(page), 1 / (i + 1), 1 / (len(page) - i), min(2, (b.node.depth if b.node else 0) / 10),
            )
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """A bidirectional LSTM with one output a block."""

    def __init__(self, seed: int = SEED, hidden: int = HIDDEN):
        rng = np.random.default_rng(seed)
        h = self.hidden = hidden
        self.w: dict[str, np.ndarray] = {}
        for d in "fb":
            self.w["x" + d] = rng.normal(0, 0.1, (WIDTH, 4 * h))
            self.w["h" + d] = rng.normal(0, 0.2, (h, 4 * h))
            self.w["b" + d] = np.concatenate((np.zeros(h), np.ones(h), np.zeros(2 * h)))
        self.w["o"], self.w["c"] = rng.normal(0, 0.2, 2 * h), np.zeros(1)
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}

    def run(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        """x: (time, page, WIDTH), mask: (time, page). Chances; with ``keep`` also what the gradient needs."""
        h, (time, n) = self.hidden, mask.shape
        both, kept = np.zeros((time, n, 2 * h), np.float32), {}
        for k, d in enumerate("fb"):
            gates_in = x.reshape(-1, WIDTH) @ self.w["x" + d] + self.w["b" + d]
            gates_in = gates_in.reshape(time, n, 4 * h)
            state, cell, steps = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32), []
            for t in range(time) if d == "f" else range(time - 1, -1, -1):
                g = gates_in[t] + state @ self.w["h" + d]
                s = sigmoid(g[:, : 3 * h])
                i, f, o, u = s[:, :h], s[:, h : 2 * h], s[:, 2 * h :], np.tanh(g[:, 3 * h :])
                m = mask[t][:, None]
                old_state, old_cell = state, cell
                cell = m * (f * cell + i * u) + (1 - m) * cell
                tan = np.tanh(cell)
                state = m * (o * tan) + (1 - m) * state
                both[t, :, k * h : (k + 1) * h] = state
                if keep:
                    steps.append((t, i, f, o, u, tan, old_state, old_cell, m))
            kept[d] = steps
        chance = sigmoid(both @ self.w["o"] + self.w["c"])
        return (chance, both, kept) if keep else chance

    def gradient(self, x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> dict[str, np.ndarray]:
        h = self.hidden
        chance, both, kept = self.run(x, mask, keep=True)
        error = (chance - y) * mask / max(1, mask.sum())
        out = {"o": np.tensordot(error, both, 2), "c": np.array([error.sum()])}
        back = error[..., None] * self.w["o"]
        for k, d in enumerate("fb"):
            gates = np.zeros((*mask.shape, 4 * h), np.float32)
            d_state, d_cell = np.zeros((mask.shape[1], h), np.float32), np.zeros((mask.shape[1], h), np.float32)
            out["h" + d] = np.zeros_like(self.w["h" + d])
            for t, i, f, o, u, tan, old_state, old_cell, m in reversed(kept[d]):
                s = d_state + back[t, :, k * h : (k + 1) * h]
                inner = m * s
                c = d_cell + inner * o * (1 - tan**2)
                g = gates[t]
                g[:, :h] = m * c * u * i * (1 - i)
                g[:, h : 2 * h] = m * c * old_cell * f * (1 - f)
                g[:, 2 * h : 3 * h] = inner * tan * o * (1 - o)
                g[:, 3 * h :] = m * c * i * (1 - u**2)
                out["h" + d] += old_state.T @ g
                d_state = g @ self.w["h" + d].T + (1 - m) * s
                d_cell = m * c * f + (1 - m) * c
            flat = gates.reshape(-1, 4 * h)
            out["x" + d], out["b" + d] = x.reshape(-1, WIDTH).T @ flat, flat.sum(0)
        return out

    def chances(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """The chance of each block of pages given as vectors."""
        x, mask = padded(pages)
        chance = self.run(x, mask)
        return [chance[: len(p), k] for k, p in enumerate(pages)]

    def labelled(self, pages: list[list[Block]], reader: Reader) -> list[np.ndarray]:
        """The chance of each block of each page; pages of like length run together, vectors are made as they are needed."""
        out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
        order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            some = order[at : at + 128]
            while len(some) > 1 and len(some) * len(pages[some[-1]]) > TOGETHER:
                some = some[: len(some) // 2]
            if len(pages[some[0]]) > LONG:
                some = some[:1]
                out[some[0]] = self.streamed(pages[some[0]], reader)
            else:
                for i, chance in zip(some, self.chances([reader.page(pages[i]) for i in some]), strict=True):
                    out[i] = chance
            at += len(some)
        return out

    def streamed(self, page: list[Block], reader: Reader, step: int = 4096) -> np.ndarray:
        """The chances of one page's blocks, read in stretches of ``step``, once in either direction."""
        h = self.hidden
        total = np.full(len(page), self.w["c"][0], np.float32)
        for k, d in enumerate("fb"):
            state, cell = np.zeros(h, np.float32), np.zeros(h, np.float32)
            out, w = self.w["o"][k * h : (k + 1) * h], self.w["h" + d]
            firsts = range(0, len(page), step)
            for first in firsts if d == "f" else reversed(firsts):
                gates = reader.page(page, first, first + step) @ self.w["x" + d] + self.w["b" + d]
                for t in range(len(gates)) if d == "f" else range(len(gates) - 1, -1, -1):
                    g = gates[t] + state @ w
                    s = sigmoid(g[: 3 * h])
                    cell = s[h : 2 * h] * cell + s[:h] * np.tanh(g[3 * h :])
                    state = s[2 * h :] * np.tanh(cell)
                    total[first + t] += state @ out
        return sigmoid(total)


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    time = max(map(len, pages))
    x, mask = np.zeros((time, len(pages), WIDTH), np.float32), np.zeros((time, len(pages)), np.float32)
    for k, p in enumerate(pages):
        x[: len(p), k], mask[: len(p), k] = p, 1
    return x, mask


# ---- invented pages --------------------------------------------------------------------------

#: Names by kind of clutter: (elements, class or id words, words of the text).
CLUTTER = {
    "menu": (("nav", "div", "ul", "menu"), ("nav", "navbar", "navigation", "menu", "main-menu", "topnav", "breadcrumb", "breadcrumbs", "site-nav", "pagination", "pager"), ("home", "about", "contact", "news", "products", "login", "search")),
    "header": (("header", "div"), ("header", "site-header", "masthead", "top-bar", "topbar", "branding", "logo", "page-header"), ("welcome", "home", "subscribe", "login")),
    "footer": (("footer", "div"), ("footer", "site-footer", "bottom", "colophon", "copyright", "legal", "page-footer"), ("©", "copyright", "rights", "reserved", "privacy", "terms", "·")),
    "sidebar": (("aside", "div"), ("sidebar", "side", "widget", "widgets", "related", "related-posts", "recommended", "popular", "trending", "most-read", "tags", "rail", "right-column"), ("more", "popular", "related", "recent", "read")),
    "notice": (("div", "section", "p"), ("notice", "cookie", "cookie-banner", "cookie-notice", "consent", "gdpr", "alert", "banner", "popup", "modal", "newsletter", "subscribe", "signup", "paywall", "message"), ("cookies", "accept", "consent", "privacy", "subscribe", "newsletter")),
    "advert": (("div", "section", "ins", "aside"), ("ad", "ads", "advert", "advertisement", "adsbygoogle", "sponsor", "sponsored", "promo", "promotion", "ad-slot", "ad-container", "banner-ad", "commercial"), ("buy", "sale", "offer", "sponsored", "advertisement", "now", "free")),
    "form": (("form",), ("form", "search-form", "login-form", "contact-form", "signup", "search"), ("name", "email", "password", "submit", "search", "send")),
    "comments": (("section", "div", "ol", "ul"), ("comments", "comment-list", "commentlist", "comment", "responses", "discussion", "disqus", "replies", "reply", "user-comments", "reader-comments"), ("reply", "says", "posted", "comment", "ago", "report")),
    "share": (("div", "ul"), ("share", "social", "sharing", "social-links", "share-buttons", "follow", "toolbar", "meta", "byline-tools", "print"), ("share", "tweet", "print", "email", "follow")),
}
MAIN = (("article", "main", "div", "section", "div", "article"), ("content", "article", "post", "entry", "entry-content", "article-body", "post-content", "story", "main", "main-content", "text", "body-text", "post-body", "page-content", "td-post-content", ""))
PLAIN = ("row", "col", "wrap", "wrapper", "container", "inner", "block", "box", "box1", "c12", "x7", "module", "grid", "")


def made_page(rng: np.random.Generator) -> tuple[str, list[str]]:
    """An invented page and its main blocks."""
    letters = "aeioubcdfghlmnprstvwyzéüñ"
    words = ["".join(rng.choice(list(letters), rng.integers(1, 9))) for _ in range(60)]
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    serial = iter(range(10**6))

    def phrase(lo: int, hi: int, hints: tuple[str, ...] = ()) -> str:
        out = [pick(words) for _ in range(int(rng.integers(lo, hi)))]
        for _ in range(2 if hints and rng.random() < 0.6 else 0):
            out[int(rng.integers(len(out)))] = pick(hints)
        return " ".join(out)

    def sentences(lo: int, hi: int) -> str:
        return " ".join(phrase(3, 18).capitalize() + pick((".", ".", ".", "!", "?")) for _ in range(int(rng.integers(lo, hi))))

    def named(tag: str, names: tuple[str, ...] | list[str], known: float = 0.92) -> tuple[str, str]:
        name = pick(names) if rng.random() < known else pick(PLAIN)
        if name and rng.random() < 0.3:
            name = pick((f"{name} {pick(PLAIN)}", f"{pick(PLAIN)} {name}", f"js-{name}"))
        attr = f' {pick(("class", "class", "id"))}="{name}"' if name else ""
        return f"<{tag}{attr}>", f"</{tag}>"

    def clutter(kind: str) -> str:
        tags, names, hints = CLUTTER[kind]
        tag = pick(tags)
        plain = tag in ("nav", "header", "footer", "aside", "form", "menu") and rng.random() < 0.6
        start, end = (f"<{tag}>", f"</{tag}>") if plain else named(tag, names, 1.0 if rng.random() < 0.97 else 0)
        out = []
        for _ in range(int(rng.integers(1, 6))):
            text = phrase(1, 6, hints) if kind not in ("comments", "notice", "advert", "sidebar", "footer") else pick((phrase(2, 14, hints), sentences(1, 4)))
            if tag in ("ul", "ol", "menu") or kind in ("menu", "share") and rng.random() < 0.6:
                out.append(f'<li><a href="/{next(serial)}">{text}</a></li>')
            elif kind == "form":
                out.append(pick((f"<label>{text}</label><input>", f"<p>{text}</p>", f"<button>{text}</button>", f"<select><option>{text}<option>{phrase(1, 3)}</select>", f"<textarea>{text}</textarea>", f"<legend>{text}</legend>")))
            elif kind == "comments":
                a, b = named(pick(("div", "li", "article")), ("comment", "comment-body", "reply", "response", "commenter"), 0.8)
                out.append(f"{a}<b>{phrase(1, 3)}</b> <p>{sentences(1, 4)}</p>{b}")
            else:
                out.append(pick((f"<p>{text}</p>", text, f'<a href="#">{text}</a>', f"<div>{text}</div>", f"<h3>{text}</h3>", f"<span>{text}</span>")))
        body = "".join(out)
        if tag not in ("ul", "ol", "menu") and "<li>" in body and rng.random() < 0.8:
            body = f"<ul>{body}</ul>"
        return start + body + end

    main: list[str] = []

    def kept(text: str) -> str:
        main.append(text)
        return text

    def article() -> str:
        out = [f"<h1>{kept(phrase(2, 12))}</h1>"] if rng.random() < 0.8 else []
        for _ in range(int(rng.integers(1, 12) if rng.random() < 0.88 else rng.integers(15, 40))):
            r = rng.random()
            if r < 0.62:
                text = main[-1] if main and rng.random() < 0.12 else pick((sentences(1, 7), sentences(1, 7), sentences(1, 2), phrase(1, 5)))
                out.append(f"<p>{kept(text)}" + pick(("</p>", "</p>", "", "\n")))
            elif r < 0.7:
                out.append(f"<p><b>{kept(pick((sentences(1, 2), phrase(1, 10))))}<br>" + pick(("", "</b></p>")) + ("<p>" + kept(sentences(1, 3)) if rng.random() < 0.5 else ""))
            elif r < 0.77:
                tag = pick(("h2", "h3", "h4"))
                out.append(f"<{tag}>{kept(phrase(1, 9))}</{tag}>")
            elif r < 0.82:
                tag = pick(("ul", "ol"))
                out.append(f"<{tag}>" + "".join(f"<li>{kept(pick((phrase(2, 14), sentences(1, 2))))}" + pick(("</li>", "")) for _ in range(int(rng.integers(1, 5)))) + f"</{tag}>")
            elif r < 0.86:
                out.append(f"<blockquote><p>{kept(sentences(1, 4))}</p></blockquote>")
            elif r < 0.89:
                out.append("<table>" + "".join("<tr>" + "".join(f"<td>{kept(phrase(1, 4))}</td>" for _ in range(2)) + "</tr>" for _ in range(2)) + "</table>")
            elif r < 0.92:
                start, end = pick((("<pre>", "</pre>"), ("<div>", "</div>"), ("<figure><figcaption>", "</figcaption></figure>")))
                out.append(start + kept(pick((phrase(3, 12), sentences(1, 4)))) + end)
            else:
                out.append(clutter(pick(("advert", "share", "sidebar", "notice", "form", "advert"))))
        if not main:
            out.append(f"<p>{kept(sentences(2, 5))}</p>")
        if rng.random() < 0.15:
            out.append(clutter("comments"))
        tags, names = MAIN
        tag = pick(tags)
        start, end = (f"<{tag}>", f"</{tag}>") if tag in ("article", "main") and rng.random() < 0.6 else named(tag, names, 0.9)
        return start + "".join(out) + (end if rng.random() < 0.95 else "")

    before = [clutter(k) for k in ("notice", "header", "menu", "advert", "menu", "form", "sidebar") if rng.random() < 0.4]
    after = [clutter(k) for k in ("share", "sidebar", "comments", "advert", "form", "notice", "menu", "footer", "footer") if rng.random() < 0.4]
    body = "".join([*before, article(), *after])
    if rng.random() < 0.3:
        a, b = named("div", PLAIN)
        body = a + body + b
    return f"<!DOCTYPE html><html><head><title>{phrase(1, 6)}</title></head><body>{body}" + pick(("</body></html>", "")), main


@lru_cache(maxsize=2)
def trained(seed: int = SEED, pages: int = PAGES, passes: int = PASSES) -> Labeller:
    rng = np.random.default_rng(seed)
    reader, xs, ys = Reader(), [], []
    for _ in range(pages):
        page, main = made_page(rng)
        found = blocks(page)
        left = [" ".join(m.split()) for m in main]
        marks = []
        for b in found:
            mine = b.text in left
            if mine:
                left.remove(b.text)
            marks.append(mine)
        if found:
            xs.append(reader.page(found))
            ys.append(np.array(marks, np.float32))
    net = Labeller(seed)
    first, second, step = {k: np.zeros_like(v) for k, v in net.w.items()}, {k: np.zeros_like(v) for k, v in net.w.items()}, 0
    for turn in range(passes):
        order = sorted(range(len(xs)), key=lambda i: (len(xs[i]) // 6, rng.random()))
        groups = [order[i : i + STEP] for i in range(0, len(order), STEP)]
        rng.shuffle(groups)
        for group in groups:
            x, mask = padded([xs[i] for i in group])
            y = np.zeros_like(mask)
            for k, i in enumerate(group):
                y[: len(ys[i]), k] = ys[i]
            step += 1
            rate = RATE * (1 - 0.9 * turn / passes)
            for k, g in net.gradient(x, y, mask).items():
                g = np.clip(g, -1, 1)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                net.w[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def main_text(pages: list[str | None], net: Labeller, reader: Reader, cut: float = 0.5) -> list[str]:
    found = [blocks(p or "") for p in pages]
    chances = net.labelled(found, reader)
    return ["\n".join(b.text for b, c in zip(f, chance, strict=True) if c >= cut) for f, chance in zip(found, chances, strict=True)]


def extract(pages: DataFrame, net: Labeller, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """page_id, the columns of ``keep``, text, n_chars."""
    ship(pages.sparkSession)
    shared = pages.sparkSession.sparkContext.broadcast(net)
    names = ["page_id", *keep, "text", "n_chars"]

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = main_text(part.column(part.num_columns - 1).to_pylist(), shared.value, reader)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names)

    rows = pages.select(F.col(id_col).alias("page_id"), *keep, F.col(html_col).alias("__html"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "__html")
    return rows.mapInArrow(run, f"{schema}, text string, n_chars long")
