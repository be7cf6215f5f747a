"""Personal data: base patterns and gradient-boosted candidates (operator 4).

One narrow pass over whole texts finds the base spans and, with high-recall generators, overlapping candidate spans with
format and context features; only spans and features leave it. Boosted trees are fitted with MLlib on all candidates.

Labels come from evidence that the features do not hold. A number or address is labelled by a base span under it; its
features leave out what validates one (checksum, leading plus, at-sign), so that what is written like it but not matched by
the base patterns scores alike. A secret is labelled by a credential's name before it; its features hold no names. Labelled
candidates are some of the true ones only, so a score is divided by the mean score of labelled candidates on held-out
documents to give a probability, and a kind's threshold is the lowest at which the mean probability of what it selects there
is PRECISION or more. A candidate that a base pattern matches and then drops (checksum, range, length) is none.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import materialize, text_or_empty

BASE = ("email", "ip", "card", "phone")
#: Kinds that only the trees add.
ADDED = ("address", "number", "secret")
#: Steps of a score between 0 and 1 by which thresholds are set.
SCORES = 65_536
#: A kind is left out with fewer labelled or unlabelled candidates.
LEAST_ROWS = 20
TREES, DEPTH = 12, 4
PRECISION = 0.95

DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOTTED = re.compile(r"[0-9][0-9.]*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]+")
#: Generators. Each pattern reads a character a bounded number of times, however long the text's runs are.
SECRET = re.compile(r"[A-Za-z0-9_+/=-]{16,}")
NUMBER = re.compile(r"[+(]?[0-9][0-9\x20().+/-]*[0-9]")
TOKEN = re.compile(r"[^\s\"'<>|]+")
SPELT = re.compile(r"\bat\b[\])]?\s{0,3}[\w-]{1,63}\s{0,3}[\[(]?\bdot\b[\])]?\s{0,3}\w{2,63}", re.I)
AT, DOT = re.compile(r"\s*[\[(]?\bat\b[\])]?\s*", re.I), re.compile(r"\s*[\[(]?\bdot\b[\])]?\s*", re.I)
#: What a phone number has before its national part, and a base span's plus.
COUNTRY = re.compile(r"\A\+?(?:[0-9]{1,3}[\x20.-]+(?=[(]?[0-9]{3}[^0-9]))?")
CREDENTIAL = re.compile(r"(?:token|secret|passw(?:or)?d|api[_-]?key|key|auth)\w*\s*[=:]\s*[\"']?\Z", re.I)
CONTEXT = re.compile(r"(?:phone|tel|call|mobile|fax)|(card|visa|iban|account)|(mail|contact)|(ssn|passport|social)", re.I)
#: Characters before a span in which context is looked for.
BEFORE = 40
FEATURES = 20


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(DIGITS.findall(s))


def _quads(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """Leftmost non-overlapping runs of four dot-joined numbers; a run of digits and dots is read once."""
    for run in DOTTED.finditer(text):
        if run.group().count(".") < 3:
            continue
        parts, at = [], run.start()
        for p in [*run.group().split("."), ""]:
            if p:
                parts.append((at, p))
            if len(parts) == 4 or not p:
                if len(parts) == 4:
                    yield parts[0][0], at + len(p), [x for _, x in parts]
                parts = []
            at += len(p) + 1


def matches(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int]]]:
    """(start, end, kind) of the base patterns, by start, then kind as listed; and what they matched but dropped."""
    found, dropped, last = [], [], 0
    if "@" in text:
        for m in DOMAIN.finditer(text):
            start = m.start()
            while start > last and text[start - 1] in LOCAL:
                start -= 1
            if start < m.start():
                found.append((start, m.end(), 0))
                last = m.end()
    if DIGITS.search(text):
        for start, end, parts in _quads(text):
            if all(len(q := p.lstrip("0")) <= 3 and int(q or 0) <= 255 for p in parts):
                found.append((start, end, 1))
            else:
                dropped.append((start, end))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 12 and len(d := _digits(m.group())) >= 12:
                if len(d) <= 19 and luhn(d):
                    found.append((m.start(), m.end(), 2))
                else:
                    dropped.append(m.span())
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= len(_digits(m.group())) <= 15:
                    found.append((m.start(), m.end(), 3))
                else:
                    dropped.append(m.span())
    return [(a, b, BASE[k]) for a, b, k in sorted(found, key=lambda x: (x[0], x[2]))], dropped


def base_spans(text: str) -> list[tuple[int, int, str]]:
    return matches(text)[0]


class Taken:
    """Disjoint spans, asked for overlap by bisection; overlapping ones are merged."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.start, self.end = [], []
        for a, b in sorted(spans):
            if self.end and a < self.end[-1]:
                self.end[-1] = max(self.end[-1], b)
            else:
                self.start.append(a)
                self.end.append(b)

    def meets(self, a: int, b: int) -> bool:
        return bisect_right(self.end, a) < bisect_left(self.start, b)

    def add(self, a: int, b: int) -> None:
        """Of a span that meets none."""
        at = bisect_left(self.start, b)
        self.start.insert(at, a)
        self.end.insert(at, b)


def candidates(text: str) -> list[tuple[int, int, str]]:
    """Spans that may be personal data, overlapping each other and the base spans."""
    found = {(m.start(), m.end(), "secret") for m in SECRET.finditer(text)}
    if DIGITS.search(text):
        found.update((m.start(), m.end(), "number") for m in NUMBER.finditer(text) if len(_digits(m.group())) >= 7)
    if "@" in text:
        found.update((m.start(), m.end(), "address") for m in TOKEN.finditer(text) if "@" in m.group() and m.end() - m.start() > 3)
    last = 0
    for m in SPELT.finditer(text):
        start = m.start()
        start -= start > last and text[start - 1] in "[("
        while start > max(last, m.start() - 4) and text[start - 1].isspace():
            start -= 1
        name = start
        while name > last and (text[name - 1].isalnum() or text[name - 1] in "_.+-"):
            name -= 1
        if name < start:
            found.add((name, m.end(), "address"))
            last = m.end()
    return sorted(found)


def features(text: str, start: int, end: int, kind: str) -> list[float]:
    """Format of the span and what stands around it, without what labels are made of: an address is read with its at-sign
    and dots in one writing, a number without its plus and country code, and no kind by the name of a credential before it."""
    s, before, after = text[start:end], text[max(0, start - BEFORE) : start], text[end : end + 2]
    if kind == "address":
        s = DOT.sub(".", AT.sub("@", s, count=1)) if "@" not in s else s
        before = before.rstrip("[(")
    elif kind == "number":
        s = COUNTRY.sub("", s)
    n, count = max(1, len(s)), Counter(s)
    digits, runs = _digits(s), [len(x) for x in DIGITS.findall(s)]
    context = CONTEXT.search(before)
    name, _, host = s.rpartition("@")
    labels = host.split(".")
    return [
        float(ADDED.index(kind)), float(min(n, 1_000)), len(digits) / n, sum(map(str.isalpha, s)) / n, sum(map(str.isupper, s)) / n, sum(count[c] for c in "0123456789abcdefABCDEF") / n,
        -sum(v / n * log2(v / n) for v in count.values()), len(count) / n, float(min(len(digits), 1_000)), float(min(len(runs), 1_000)), float(min(max(runs, default=0), 1_000)), float(min(runs[-1], 1_000) if runs else 0),
        float(min(count["-"], 1_000)), float(min(count[" "], 1_000)), float("(" in s), float(min(len(name), 1_000)), float(min(len(labels), 1_000)) if name else 0.0, float(len(labels[-1]) if name and labels[-1].isalpha() else 0),
        float(before[-1:] in ('"', "'")) + 2 * float(after[:1] in ('"', "'")), float(context.lastindex or 5) if context and kind != "address" else 0.0,
    ]


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


_FOUND = "n array<long>, base_sha256 string, base string, start array<int>, end array<int>, kind array<int>, label array<int>, x array<float>"


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: dict[str, list] = {k: [] for k in ("n", "base_sha256", "base", "start", "end", "kind", "label", "x")}
        for value in batch.column("text"):
            text = value.as_py()
            base, dropped = matches(text)
            own, none = Taken([(a, b) for a, b, _ in base]), Taken(dropped)
            near = [c for c in candidates(text) if c[2] != "number" or own.meets(*c[:2]) or not none.meets(*c[:2])]
            joined = _joined(base)
            out["n"].append([sum(k == b for *_, k in base) for b in BASE])
            out["base_sha256"].append(hashlib.sha256(joined.encode()).hexdigest())
            out["base"].append(joined)
            out["start"].append([a for a, _, _ in near])
            out["end"].append([b for _, b, _ in near])
            out["kind"].append([ADDED.index(k) for *_, k in near])
            x = [features(text, *c) for c in near]
            named = lambda a: bool(CREDENTIAL.search(text[max(0, a - BEFORE) : a]))
            out["label"].append([int(named(a) if k == "secret" else own.meets(a, b)) for a, b, k in near])
            out["x"].append([v for f in x for v in f])
        kinds = (pa.list_(pa.int64()), pa.string(), pa.string(), *[pa.list_(pa.int32())] * 4, pa.list_(pa.float32()))
        yield pa.RecordBatch.from_arrays([batch.column("id"), *[pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)]], ["id", *out])


# --- boosted trees --------------------------------------------------------------------------------------------------


def _nodes(node, into: list) -> int:
    """Flattens an MLlib tree: (feature, threshold, left, right, value) per node; feature -1: leaf."""
    at = len(into)
    into.append(None)
    if node.subtreeDepth() == 0:
        into[at] = (-1, 0.0, at, at, node.prediction())
    else:
        split = node.split()
        left, right = _nodes(node.leftChild(), into), _nodes(node.rightChild(), into)
        into[at] = (split.featureIndex(), split.threshold(), left, right, 0.0)
    return at


def score(trees: list[tuple[float, np.ndarray]], x: np.ndarray) -> np.ndarray:
    """Probability of each row of x."""
    margin = np.zeros(len(x))
    for weight, nodes in trees:
        at = np.zeros(len(x), dtype=np.int64)
        while (inner := nodes[at, 0] >= 0).any():
            node = nodes[at]
            left = x[np.arange(len(x)), np.maximum(0, node[:, 0]).astype(int)] <= node[:, 1]
            at = np.where(inner, np.where(left, node[:, 2], node[:, 3]), at).astype(np.int64)
        margin += weight * nodes[at, 4]
    return 1 / (1 + np.exp(-2 * margin))


def threshold(score: np.ndarray, label: np.ndarray, precision: float = PRECISION, weight: np.ndarray | None = None) -> float:
    """The lowest score at which those selected are true with mean probability `precision`; 2, which none reaches, if there
    is none. A probability is a score over the mean score of labelled rows, as labels are some of the true ones only. weight:
    candidates that each row stands for, 1 if not given."""
    weight = np.ones(len(score)) if weight is None else weight
    if not label.any() or label.all():
        return 2.0
    mean = float(np.average(score[label > 0], weights=weight[label > 0]))
    order = np.argsort(-score, kind="stable")
    true = np.minimum(1.0, score[order] / mean) * weight[order]
    fine = np.flatnonzero(np.cumsum(true) / np.cumsum(weight[order]) >= precision)
    return max(0.5 * mean, float(score[order][fine[-1]])) if len(fine) else 2.0


def fit(found: DataFrame) -> tuple[list[tuple[float, np.ndarray]], list[float]]:
    """Trees, and a threshold for each kind, from all candidates of found, a materialised table. A kind with too few
    candidates of either label gets a threshold above 1; documents in the held-out fold are not trained on."""
    none: tuple[list, list[float]] = ([], [2.0] * len(ADDED))
    some = found.where(F.size("start") > 0).withColumn("doc", F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit(""))))
    flat = some.select("doc", F.posexplode("label").alias("k", "label"), "kind", "x")
    flat = flat.select("doc", "label", F.element_at("kind", F.col("k") + 1).alias("kind"), F.slice("x", F.col("k") * FEATURES + 1, FEATURES).alias("x"))
    of = {(r["kind"], r["label"]): r["count"] for r in flat.groupBy("kind", "label").count().collect()}  # six rows at most
    kinds = [k for k in range(len(ADDED)) if min(of.get((k, 0), 0), of.get((k, 1), 0)) >= LEAST_ROWS]
    if not kinds:
        return none
    held = F.pmod(F.col("doc"), F.lit(5)) == 0
    ready = flat.where(F.col("kind").isin(kinds)).withColumn("features", array_to_vector(F.col("x").cast("array<double>"))).withColumn("label", F.col("label").cast("double"))
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, minInstancesPerNode=LEAST_ROWS, seed=1).fit(ready.where(~held).select("features", "label"))
    trees = []
    for tree, weight in zip(model.trees, model.treeWeights, strict=True):
        into: list = []
        _nodes(tree._java_obj.rootNode(), into)
        trees.append((float(weight), np.array(into, dtype=np.float64)))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, FEATURES)
            cell = np.floor(score(trees, x) * SCORES).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("kind"), batch.column("label"), pa.array(cell, pa.int32())], ["kind", "label", "cell"])

    # counted by score before they are collected, so that the driver gets SCORES rows of each kind and label at most
    counts = flat.where(held & F.col("kind").isin(kinds)).select("kind", "label", "x").mapInArrow(cells, "kind int, label int, cell int")
    rest = counts.groupBy("kind", "label", "cell").count().toPandas().sort_values(["kind", "cell", "label"])
    thresholds = [2.0] * len(ADDED)
    for k in kinds:
        own = rest[rest["kind"] == k]
        thresholds[k] = threshold(own["cell"].to_numpy() / SCORES, own["label"].to_numpy(), weight=own["count"].to_numpy().astype(np.float64))
    return trees, thresholds


def find(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Per row of docs: id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans ("kind:start:end", code
    points, end exclusive, by start; base and added ones), n_address, n_number, n_secret (added ones), n_spans (all).

    Null and empty texts have no spans. Added spans (address, number, secret) overlap no base span, and each other never:
    the higher score wins. Repeated rows and null ids are kept; extra columns are ignored; an empty table gives no rows.
    """
    packed = docs.select(F.col(id).alias("id"), text_or_empty(text).alias("text"))
    kind = packed.schema["id"].dataType.simpleString()
    found = materialize(packed.mapInArrow(_find, f"id {kind}, {_FOUND}"))
    trees, thresholds = fit(found)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, more = [], []
            flat = [batch.column(c).to_pylist() for c in ("base", "start", "end", "kind")]
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, FEATURES)
            p = score(trees, x) if trees else np.zeros(len(x))
            at = 0
            for base, start, end, kinds in zip(*flat, strict=True):
                spans = [(int(a), int(b), k) for k, a, b in (s.split(":") for s in base.split(",") if s)]
                own = p[at : at + len(start)]
                at += len(start)
                taken, added = Taken([(a, b) for a, b, _ in spans]), [0] * len(ADDED)
                for i in sorted((i for i in range(len(start)) if own[i] >= thresholds[kinds[i]]), key=lambda i, own=own: (-own[i], i)):
                    if not taken.meets(start[i], end[i]):
                        taken.add(start[i], end[i])
                        spans.append((start[i], end[i], ADDED[kinds[i]]))
                        added[kinds[i]] += 1
                spans.sort(key=lambda s: (s[0], (*BASE, *ADDED).index(s[2])))
                out.append(_joined(spans))
                more.append([*added, len(spans)])
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("id", "n", "base_sha256")] + [pa.array(out, pa.string()), pa.array(more, pa.list_(pa.int64()))], ["id", "n", "base_sha256", "spans", "more"])

    scored = found.mapInArrow(add, f"id {kind}, n array<long>, base_sha256 string, spans string, more array<long>")
    counts = [F.col("more")[i].alias(f"n_{k}") for i, k in enumerate((*ADDED, "spans"))]
    return scored.select(F.col("id").alias(id), *[F.col("n")[i].alias(f"n_{k}") for i, k in enumerate(BASE)], "base_sha256", "spans", *counts)


def redact(text: str, spans: str) -> str:
    """The text with every span of `spans` replaced by its kind in brackets."""
    out, last = [], 0
    for kind, a, b in sorted((s.split(":") for s in spans.split(",") if s), key=lambda s: int(s[1])):
        if int(a) >= last:
            out += [text[last : int(a)], f"[{kind}]"]
            last = int(b)
    return "".join([*out, text[last:]])
