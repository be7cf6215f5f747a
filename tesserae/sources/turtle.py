"""Turtle files as triples: (s, p, o, s_kind, o_kind, datatype, lang, file), as the N-Triples reader gives them.

Spark reads each file whole and parses it where it was read; triples leave the parser in batches. The grammar is met by one
loop over tokens with a stack of open subjects, so nesting may be as deep as it likes. Blank nodes are named by file, so
graphs of several files can be put together. A file that cannot be parsed gives one row of kind `error` (o says where and
why) and nothing else.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import urljoin, urlsplit
from zlib import crc32

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TRIPLE = "s string, p string, o string, s_kind string, o_kind string, datatype string, lang string, file string"
#: Fixed values of the language.
RDF, XSD = "http://www.w3.org/1999/02/22-rdf-syntax-ns#", "http://www.w3.org/2001/XMLSchema#"
ESCAPES = {"t": "\t", "b": "\b", "n": "\n", "r": "\r", "f": "\f", '"': '"', "'": "'", "\\": "\\"}
TOKEN = re.compile(
    r"""(?P<space>(?:\s++|\#[^\n\r]*+)++)
    |<(?P<iri>(?:[^\x00-\x20<>"{}|^`\\]|\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8})*+)>
    |\"\"\"(?P<long2>(?:\"{0,2}(?:[^"\\]|\\.))*+)\"\"\"
    |'''(?P<long1>(?:'{0,2}(?:[^'\\]|\\.))*+)'''
    |"(?P<text2>(?:[^"\\\n\r]|\\.)*+)"
    |'(?P<text1>(?:[^'\\\n\r]|\\.)*+)'
    |@(?P<at>prefix|base)\b
    |@(?P<lang>[a-zA-Z]++(?:-[a-zA-Z0-9]++)*+)
    |(?P<type>\^\^)
    |(?P<double>[+-]?(?:\d+\.\d*|\.?\d+)[eE][+-]?\d+)
    |(?P<decimal>[+-]?\d*\.\d+)
    |(?P<integer>[+-]?\d+)
    |_:(?P<label>\w(?:[\w.\-\u00b7]*[\w\-\u00b7])?)
    |(?P<name>(?:[^\W\d_](?:[\w.\-\u00b7]*[\w\-\u00b7])?)?:(?:(?:[\w:\-\u00b7]|%[0-9A-Fa-f]{2}|\\[_~.\-!$&'()*+,;=/?\#@%])(?:(?:[\w.:\-\u00b7]|%[0-9A-Fa-f]{2}|\\[_~.\-!$&'()*+,;=/?\#@%])*(?:[\w:\-\u00b7]|%[0-9A-Fa-f]{2}|\\[_~.\-!$&'()*+,;=/?\#@%]))?)?)
    |(?P<word>[a-zA-Z]+)
    |(?P<mark>[\[\]();,.])""",
    re.X | re.S,
)
ESCAPE = re.compile(r"\\(?:u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|(.))", re.S)

Term = tuple[str, str, str | None, str | None]


def unescaped(text: str) -> str:
    def one(m: re.Match) -> str:
        if m[3]:
            if m[3] not in ESCAPES:
                raise ValueError(f"escape \\{m[3]}")
            return ESCAPES[m[3]]
        return chr(int(m[1] or m[2], 16))

    return ESCAPE.sub(one, text) if "\\" in text else text


def resolved(iri: str, base: str) -> str:
    """An address against the base; one with a scheme stands for itself."""
    if not base or re.match(r"[A-Za-z][A-Za-z0-9+.\-]*:", iri):
        return iri
    if not iri:
        return base.partition("#")[0]
    return urljoin(base, iri) if urlsplit(base).netloc or base.startswith("file:") else base.rpartition("#" if iri[0] == "#" else "/")[0] + ("" if iri[0] == "#" else "/") + iri


class _Open:
    """An open subject: the document's current one, a [ ] or a ( ). `want` is what may come next."""

    __slots__ = ("first", "kind", "may_end", "predicate", "subject", "want")

    def __init__(self, kind: str, subject: Term | None = None, want: str = "subject"):
        self.kind, self.subject, self.want, self.predicate, self.may_end, self.first = kind, subject, want, "", False, None


def parse(text: str, base: str = "", mark: str = "") -> Iterator[tuple]:
    """(s, p, o, s_kind, o_kind, datatype, lang) of a document; raises ValueError with a line where the grammar is not met."""
    prefixes: dict[str, str] = {}
    stack = [_Open("top")]
    count, at, pending = 0, 0, None  # pending: a literal that a language or a type may follow
    directive: list | None = None

    def fresh() -> Term:
        nonlocal count
        count += 1
        return f"_:{mark}.-{count}", "bnode", None, None  # no label begins with a dash

    def put(term: Term) -> Iterator[tuple]:
        top = stack[-1]
        if term[2] == XSD + "string":  # what a plain literal is
            term = (*term[:2], None, None)
        if top.kind == "list":
            node = fresh()
            if top.first is None:
                top.first = node
            else:
                yield top.subject[0], RDF + "rest", node[0], "bnode", "bnode", None, None
            yield node[0], RDF + "first", term[0], "bnode", term[1], *term[2:]
            top.subject = node
        elif top.want == "subject":
            if term[1] == "literal":
                raise ValueError("a literal as subject")
            top.subject, top.want, top.may_end = term, "verb", False
        elif top.want == "verb":
            if term[1] != "iri":
                raise ValueError("a predicate must be an IRI")
            top.predicate, top.want = term[0], "object"
        elif top.want == "object":
            yield top.subject[0], top.predicate, term[0], top.subject[1], term[1], *term[2:]
            top.want = "after"
        else:
            raise ValueError(f"{term[0]!r} without a mark before it")

    def named(name: str) -> str:
        prefix, _, local = name.partition(":")
        if prefix not in prefixes:
            raise ValueError(f"unknown prefix {prefix!r}")
        return prefixes[prefix] + re.sub(r"\\(.)", r"\1", local)

    try:
        while at < len(text) or pending:
            m = TOKEN.match(text, at) if at < len(text) else None
            if m is None and at < len(text):
                raise ValueError(f"unexpected {text[at]!r}")
            kind, value = (m.lastgroup, m[m.lastgroup]) if m else ("end", "")
            if kind == "space":
                at = m.end()
                continue
            if pending:
                typed = pending[2] == "?"
                if typed and kind not in ("iri", "name"):
                    raise ValueError("^^ without a type")
                if kind == "lang" and not typed:
                    yield from put((pending[0], "literal", None, value))
                elif kind == "type" and not typed:
                    pending = (pending[0], "literal", "?", None)
                    at = m.end()
                    continue
                elif typed:
                    yield from put((pending[0], "literal", resolved(unescaped(value), base) if kind == "iri" else named(value), None))
                else:
                    yield from put(pending)
                    pending = None
                    continue
                pending, at = None, m.end()
                continue
            at = m.end()
            if directive is not None:
                directive.append((kind, value))
                what, dotted = directive[0]
                need = 2 if what == "base" else 3
                if len(directive) == need + (1 if dotted else 0):
                    kinds = [k for k, _ in directive[1:]]
                    if kinds != (["iri"] if what == "base" else ["name", "iri"]) + (["mark"] if dotted else []) or (dotted and directive[-1][1] != ".") or (what == "prefix" and not directive[1][1].endswith(":")):
                        raise ValueError(f"{what} directive")
                    address = resolved(unescaped(directive[need - 1][1]), base)
                    if what == "base":
                        base = address
                    else:
                        prefixes[directive[1][1][:-1]] = address
                    directive = None
                continue
            top = stack[-1]
            if kind == "at" or (kind == "word" and value.lower() in ("prefix", "base") and top.want == "subject"):
                if top.kind != "top" or top.want != "subject":
                    raise ValueError("a directive inside a statement")
                directive = [(value.lower(), kind == "at")]
            elif kind == "iri":
                yield from put((resolved(unescaped(value), base), "iri", None, None))
            elif kind == "name":
                yield from put((named(value), "iri", None, None))
            elif kind == "label":
                yield from put((f"_:{mark}.{value}" if mark else f"_:{value}", "bnode", None, None))
            elif kind in ("long1", "long2", "text1", "text2"):
                pending = (unescaped(value), "literal", None, None)
            elif kind in ("double", "decimal", "integer"):
                yield from put((value, "literal", XSD + kind, None))
            elif kind == "word" and value in ("true", "false"):
                yield from put((value, "literal", XSD + "boolean", None))
            elif kind == "word" and value == "a" and top.kind != "list" and top.want == "verb":
                yield from put((RDF + "type", "iri", None, None))
            elif kind != "mark":
                raise ValueError(f"unexpected {value!r}")
            elif value == "[":
                if top.kind != "list" and top.want not in ("subject", "object"):
                    raise ValueError("unexpected '['")
                stack.append(_Open("node", fresh(), "verb"))
                stack[-1].may_end = True
            elif value == "(":
                if top.kind != "list" and top.want not in ("subject", "object"):
                    raise ValueError("unexpected '('")
                stack.append(_Open("list"))
            elif value == "]":
                if top.kind != "node" or not (top.want == "after" or (top.want == "verb" and top.may_end)):
                    raise ValueError("unexpected ']'")
                stack.pop()
                yield from put(top.subject)
                if stack[-1].kind == "top" and stack[-1].want == "verb":
                    stack[-1].may_end = bool(top.predicate)  # [ p o ] may stand alone
            elif value == ")":
                if top.kind != "list":
                    raise ValueError("unexpected ')'")
                stack.pop()
                nil = (RDF + "nil", "iri", None, None)
                if top.first:
                    yield top.subject[0], RDF + "rest", nil[0], "bnode", "iri", None, None
                yield from put(top.first or nil)
            elif value == ";" and top.kind != "list" and (top.want == "after" or (top.want == "verb" and top.may_end and top.predicate)):
                top.want, top.may_end = "verb", True
            elif value == "," and top.kind != "list" and top.want == "after":
                top.want = "object"
            elif value == "." and top.kind == "top" and (top.want == "after" or (top.want == "verb" and top.may_end)):
                stack[-1] = _Open("top")
            else:
                raise ValueError(f"unexpected {value!r}")
        if len(stack) > 1 or stack[0].want != "subject" or directive is not None:
            raise ValueError("the document ends inside a statement")
    except ValueError as e:
        raise ValueError(f"line {text.count(chr(10), 0, at) + 1}: {e}") from None


def file_mark(path: str) -> str:
    return f"f{crc32(path.encode()):08x}"


def _rows(path: str, text: str) -> list[tuple]:
    try:
        return [(*t, path) for t in parse(text.removeprefix("\ufeff"), path, file_mark(path))]
    except ValueError as e:
        return [(path, None, str(e), "error", "error", None, None, path)]


def read_turtle(spark: SparkSession, path: str, glob: str = "*.ttl") -> DataFrame:
    """All Turtle files under path. Addresses without a base are resolved against their file's."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(path, wholetext=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, text in zip(batch["file"], batch["value"], strict=True):
                rows = _rows(file, text)
                for lo in range(0, len(rows), 50_000):
                    yield pd.DataFrame(rows[lo : lo + 50_000], columns=[c.split(" ")[0] for c in TRIPLE.split(", ")])

    return files.select("value", F.col("_metadata.file_path").alias("file")).mapInPandas(run, TRIPLE)


def parsed(rows: DataFrame, text: str, name: str) -> DataFrame:
    """Triples of the Turtle documents in a column; `file` is the document's name.

    Documents are dealt out before they are parsed: a compressed table of few splits is parsed by as many tasks as its texts
    need. Triples are joined by sorting, which spills: Spark takes them to be as small as the file they come from and would
    broadcast them whole to every task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [t for file, text in zip(batch["file"], batch["value"], strict=True) for t in _rows(file, text or "")]
            yield pd.DataFrame(out, columns=[c.split(" ")[0] for c in TRIPLE.split(", ")])

    dealt = rows.select(F.col(name).cast("string").alias("file"), F.col(text).alias("value")).repartition("file", "value")
    return dealt.mapInPandas(run, TRIPLE).hint("merge")
