"""Leaf blocks of web pages, and the numbers by which a labeller reads them (part of operator 13).

A leaf is a run of text between the edges of block elements; inline tags do not end it, and a line break is white space. The
reader is forgiving: open paragraphs, list items and cells are closed by the next one, an unknown end tag is skipped, what is
cut off ends with the page. What is no text of a page never becomes a leaf: markup, page comments, scripts, styles, titles.
"""

from __future__ import annotations

import re
from html import unescape
from zlib import crc32

import numpy as np

#: Elements without an end tag, elements whose content is no running text, inline elements.
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style noscript template iframe svg canvas object title textarea select".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
#: What a start tag closes, and the elements beyond which it does not look.
CLOSES = {"li": (("li",), ("ul", "ol")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table"))}
TAG = re.compile(r"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*+(?:>|\Z)|/([a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)|([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z))""", re.S)
ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
PATHS, WORDS = 1 << 13, 1 << 12
#: Open elements beyond which further ones are read as if side by side, as browsers do, and innermost ones that make a path.
DEPTH, ABOVE = 512, 48
NUMBERS = 12


def _bucket(kind: str, name: str, buckets: int = PATHS) -> int:
    return crc32(f"{kind}:{name}".encode("utf-8", "surrogatepass")) % buckets


class Leaf:
    __slots__ = ("linked", "path", "tags", "text")

    def __init__(self, tags: tuple[str, ...], path: list[int]):
        self.tags, self.path, self.text, self.linked = tags, path, "", 0


def _names(attributes: str) -> list[int]:
    """Buckets of the words in an element's class, id and role."""
    return [_bucket("name", w.lower()) for m in ATTRIBUTE.finditer(attributes) for w in NAME.findall(m[2] or m[3] or m[4] or "")]


def leaves(html: str) -> list[Leaf]:
    """The leaves of a page in order, each with its text (references decoded, runs of white space made one space, trimmed), the
    tags above it (the innermost ABOVE), the buckets of its tag path, and how many of its characters stand in links."""
    out: list[Leaf] = []
    stack: list[tuple[str, list[int]]] = []
    parts: list[str] = []
    leaf: Leaf | None = None
    linked = 0

    def close() -> None:
        nonlocal leaf, linked
        if leaf:
            leaf.text, leaf.linked = " ".join("".join(parts).split()), linked
            out.append(leaf)
        parts.clear()
        leaf, linked = None, 0

    def say(raw: str) -> None:
        nonlocal leaf, linked
        if not raw:
            return
        text = unescape(raw) if "&" in raw else raw
        if leaf is None and not text.isspace():
            near = stack[-ABOVE:]
            path = [b for _, own in near for b in own]
            blocks = [t for t, _ in near if t not in INLINE]
            path += [_bucket("leaf", blocks[-1] if blocks else ""), _bucket("path", "/".join(blocks))]
            leaf = Leaf(tuple(t for t, _ in near), path)
        parts.append(text)
        if leaf and any(t == "a" for t, _ in stack[-ABOVE:]):
            linked += len(text.strip())

    def pop(names: tuple[str, ...], beyond: tuple[str, ...]) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                del stack[i:]
                return
            if stack[i][0] in beyond:
                return

    at, end = 0, len(html)
    while at < end:
        m = TAG.search(html, at)
        if m is None:
            say(html[at:])
            break
        say(html[at : m.start()])
        at = m.end()
        if m[1]:
            name = m[1].lower()
            if name not in INLINE:
                close()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    if name in INLINE and any(t not in INLINE for t, _ in stack[i:]):
                        del stack[i]
                    else:
                        del stack[i:]
                    break
            continue
        name, attributes = (m[2] or m[4] or "").lower(), m[3] or m[5] or ""
        if not name:
            continue
        if name in SKIPPED:
            if not attributes.endswith("/") or name in ("script", "style", "title", "textarea"):
                found = re.compile(f"</{name}(?![a-zA-Z0-9-])[^>]*>?", re.I).search(html, at)
                at = found.end() if found else end
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name not in INLINE and name not in ("img", "wbr", "input", "link", "meta"):
            close()
            if name in CLOSES:
                pop(*CLOSES[name])
            else:
                pop(("p",), ("table", "button", "div", "article", "section", "main", "aside"))
        if name not in VOID and not attributes.endswith("/") and len(stack) < DEPTH:
            stack.append((name, [_bucket("tag", name), *_names(attributes)]))
    close()
    return out


def _shares(texts: list[str]) -> np.ndarray:
    """Shares of capitals, of digits and of signs among each text's characters; no text is empty."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    size = np.array([len(t) for t in texts])
    kinds = ((codes >= 65) & (codes <= 90), (codes >= 48) & (codes <= 57), (codes > 32) & (codes <= 191) & ~_WORDY[np.minimum(codes, 191)])
    return np.stack([np.add.reduceat(k, np.cumsum(size) - size, dtype=np.int64) / size for k in kinds], axis=1)


_WORDY = np.array([chr(i).isalnum() for i in range(192)])
_held: dict[str, int] = {}


def _words(text: str) -> list[int]:
    """Buckets of the lower-cased words; a bounded table remembers them."""
    out = []
    for w in text.lower().split():
        b = _held.get(w)
        if b is None:
            if len(_held) >= 200_000:
                _held.clear()
            b = _held[w] = _bucket("word", w.strip(".,;:!?()\"'|"), WORDS)
        out.append(b)
    return out


class Page:
    """What the labeller reads of one page: buckets of paths and words with where each leaf's begin, and numbers by leaf."""

    __slots__ = ("numbers", "path_starts", "paths", "size", "word_starts", "words")

    def __init__(self, found: list[Leaf]):
        self.size = n = len(found)
        words = [_words(x.text) for x in found]
        self.paths = np.array([b for x in found for b in x.path], dtype=np.int64)
        self.words = np.array([b for x in words for b in x], dtype=np.int64)
        self.path_starts = np.cumsum([0, *[len(x.path) for x in found]][:-1] if n else [], dtype=np.int64)
        self.word_starts = np.cumsum([0, *[len(x) for x in words]][:-1] if n else [], dtype=np.int64)
        self.numbers = np.zeros((n, NUMBERS), dtype=np.float32)
        if n:
            size, count, linked, depth = (np.array(x, dtype=np.float64) for x in ([len(x.text) for x in found], [len(w) for w in words], [x.linked for x in found], [len(x.tags) for x in found]))
            place, last = np.arange(n), np.array([x.text[-1] in ".!?\u2026\u3002" for x in found])
            columns = [np.minimum(2, np.log1p(size) / 6), np.minimum(2, np.log1p(count) / 4), np.minimum(1, linked / size), *_shares([x.text for x in found]).T, last, place / n, 1 - (place + 1) / n, 1 / (1 + place), 1 / (n - place), np.minimum(2, depth / 8)]
            self.numbers[:] = np.stack(columns, axis=1)
