"""Main text of web pages by a recurrent block labeller (operator 13).

A page is read into its leaf blocks. Each leaf is a vector: the sum of the embeddings of its tag path (tags, and the words of
classes, ids and roles, hashed), the mean of those of its hashed words, and a few numbers of its shape. A bidirectional LSTM
(NumPy, trained here) runs over all leaves of the page and labels every one with the whole page as context; the text of the
leaves labelled as article is joined.

Training takes a bounded sample of pages: those that mark their article by `article` or `main` teach by their own markup, and
the texts of all of them are put into layouts drawn at random (html_layouts), whose main text is known.
"""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, IntegerType, LongType, StringType, StructField, StructType

from tesserae.llm.common import slices
from tesserae.llm.html_layouts import Layout, marked
from tesserae.llm.html_leaves import NUMBERS, PATHS, WORDS, Leaf, Page, leaves

#: Pages that the labeller is fitted on at most, their characters together, and layouts drawn in all.
SAMPLE_PAGES, SAMPLE_CHARS, LAYOUTS = 300, 4_000_000, 1_500
EMBED, HIDDEN = 16, 24
EPOCHS, BATCH, RATE, WINDOW = 6, 32, 0.01, 80
#: Leaves that are labelled at a time, padding included, and characters of pages that are read at a time.
CELLS, BATCH_CHARS = 40_000, 4_000_000
#: Elements inside an article that hold none of it, for the labels that pages bring along.
OUTSIDE = frozenset("nav header footer aside form".split())

Batch = tuple[np.ndarray, np.ndarray, np.ndarray]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Embeddings, a bidirectional LSTM, and a logistic output; all weights in `w`."""

    def __init__(self, seed: int = 0, w: dict[str, np.ndarray] | None = None, kind=np.float32):
        r, d = np.random.default_rng(seed), 2 * EMBED + NUMBERS
        made = {"paths": np.zeros((PATHS, EMBED)), "words": np.zeros((WORDS, EMBED)), "out": r.normal(0, 0.3, (2 * HIDDEN + d, 1)), "bias": np.zeros(1)}
        for side in ("f", "b"):
            made |= {f"x{side}": r.normal(0, 1 / np.sqrt(d), (d, 4 * HIDDEN)), f"h{side}": r.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN)), f"c{side}": np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN)}
        # an embedding of what training never saw stays zero and says nothing
        self.seed = r.normal(0, 0.1, (PATHS + WORDS, EMBED))
        self.w = w or {k: v.astype(kind) for k, v in made.items()}

    def begin(self, pages: Sequence[Page]) -> None:
        """Gives the buckets that occur in training their first embedding."""
        for name, at, lo in (("paths", np.unique(np.concatenate([p.paths for p in pages])), 0), ("words", np.unique(np.concatenate([p.words for p in pages])), PATHS)):
            self.w[name][at] = self.seed[lo + at]

    def inputs(self, pages: Sequence[Page]) -> Batch:
        """(vectors of all leaves, page and place of each)."""
        shift = lambda starts, sizes: np.concatenate([s + o for s, o in zip(starts, np.cumsum([0, *sizes[:-1]]), strict=True)])
        path = np.add.reduceat(self.w["paths"][np.concatenate([p.paths for p in pages])], shift([p.path_starts for p in pages], [len(p.paths) for p in pages]), axis=0)
        starts, words = shift([p.word_starts for p in pages], [len(p.words) for p in pages]), np.concatenate([p.words for p in pages])
        word = np.add.reduceat(self.w["words"][words], starts, axis=0) / np.diff(np.append(starts, len(words)))[:, None].astype(np.float32)
        sizes = [p.size for p in pages]
        return np.concatenate([path, word, np.concatenate([p.numbers for p in pages])], axis=1), np.repeat(np.arange(len(pages)), sizes), np.concatenate([np.arange(n) for n in sizes])

    def run(self, side: str, x: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Hidden states of a batch (pages x places x vector), and what the way back needs."""
        w, u, c = self.w[f"x{side}"], self.w[f"h{side}"], self.w[f"c{side}"]
        n, length, _ = x.shape
        pre = x @ w + c
        h, s = np.zeros((n, length + 1, HIDDEN), x.dtype), np.zeros((n, length + 1, HIDDEN), x.dtype)
        gates = np.zeros((n, length, 4 * HIDDEN), x.dtype)
        for t in range(length):
            a = pre[:, t] + h[:, t] @ u
            a[:, : 3 * HIDDEN] = _sigmoid(a[:, : 3 * HIDDEN])
            a[:, 3 * HIDDEN :] = np.tanh(a[:, 3 * HIDDEN :])
            i, f, o, g = np.split(a, 4, axis=1)
            s[:, t + 1] = f * s[:, t] + i * g
            h[:, t + 1] = o * np.tanh(s[:, t + 1])
            gates[:, t] = a
        return h[:, 1:], (x, h, s, gates)

    def back(self, side: str, held: tuple, out: np.ndarray, grad: dict[str, np.ndarray]) -> np.ndarray:
        """Gradients of the weights, added to grad, and of x, from that of the hidden states."""
        x, h, s, gates = held
        u = self.w[f"h{side}"]
        da, dh, ds = np.zeros_like(gates), np.zeros_like(h[:, 0]), np.zeros_like(h[:, 0])
        for t in range(x.shape[1] - 1, -1, -1):
            i, f, o, g = np.split(gates[:, t], 4, axis=1)
            dh = dh + out[:, t]
            th = np.tanh(s[:, t + 1])
            ds = ds + dh * o * (1 - th * th)
            da[:, t] = np.concatenate([ds * g * i * (1 - i), ds * s[:, t] * f * (1 - f), dh * th * o * (1 - o), ds * i * (1 - g * g)], axis=1)
            dh, ds = da[:, t] @ u.T, ds * f
        flat = da.reshape(-1, da.shape[2])
        grad[f"x{side}"] += x.reshape(-1, x.shape[2]).T @ flat
        grad[f"h{side}"] += h[:, :-1].reshape(-1, HIDDEN).T @ flat
        grad[f"c{side}"] += flat.sum(axis=0)
        return da @ self.w[f"x{side}"].T

    def forward(self, pages: Sequence[Page]) -> tuple[np.ndarray, tuple]:
        """Logits of all leaves. A page's padding stands at its end, for the way back to front as well, so it changes nothing."""
        flat, page, place = self.inputs(pages)
        sizes = np.array([p.size for p in pages])
        x = np.zeros((len(pages), sizes.max(), flat.shape[1]), flat.dtype)
        x[page, place] = flat
        mirror = sizes[page] - 1 - place
        y = np.zeros_like(x)
        y[page, mirror] = flat
        (hf, held_f), (hb, held_b) = self.run("f", x), self.run("b", y)
        joined = np.concatenate([hf[page, place], hb[page, mirror], flat], axis=1)
        return (joined @ self.w["out"])[:, 0] + self.w["bias"][0], (flat, page, place, mirror, held_f, held_b, joined)

    def gradients(self, pages: Sequence[Page], truth: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean logistic loss over the leaves, and its gradients."""
        logit, (flat, page, place, mirror, held_f, held_b, joined) = self.forward(pages)
        p = _sigmoid(logit)
        loss = float(-np.mean(np.where(truth, np.log(p + 1e-12), np.log(1 - p + 1e-12))))
        d = ((p - truth) / len(truth)).astype(flat.dtype)
        grad = {k: np.zeros_like(v) for k, v in self.w.items()}
        grad["out"], grad["bias"] = joined.T @ d[:, None], np.array([d.sum()], dtype=flat.dtype)
        dj = d[:, None] * self.w["out"][:, 0]
        out = np.zeros(held_f[0].shape[:2] + (HIDDEN,), flat.dtype)
        out[page, place] = dj[:, :HIDDEN]
        dx = dj[:, 2 * HIDDEN :] + self.back("f", held_f, out, grad)[page, place]
        out = np.zeros_like(out)
        out[page, mirror] = dj[:, HIDDEN : 2 * HIDDEN]
        dx = dx + self.back("b", held_b, out, grad)[page, mirror]
        counts = lambda starts, ids: np.concatenate([np.diff(np.append(s, len(i))) for s, i in zip(starts, ids, strict=True)])
        n_paths, n_words = counts([p.path_starts for p in pages], [p.paths for p in pages]), counts([p.word_starts for p in pages], [p.words for p in pages])
        for name, part, n in (("paths", dx[:, :EMBED], n_paths), ("words", dx[:, EMBED : 2 * EMBED] / n_words[:, None], n_words)):
            ids, rows = np.concatenate([getattr(p, name) for p in pages]), np.repeat(np.arange(len(n)), n)
            for c in range(EMBED):
                grad[name][:, c] = np.bincount(ids, weights=part[rows, c], minlength=len(grad[name]))
        return loss, grad

    def fit(self, pages: Sequence[Page], truths: Sequence[np.ndarray], epochs: int = EPOCHS, seed: int = 0) -> Labeller:
        """Adam over batches of pages of like length; the order is fixed by the seed."""
        self.begin(pages)
        r = np.random.default_rng(seed)
        first, second = ({k: np.zeros_like(v) for k, v in self.w.items()} for _ in range(2))
        order = np.argsort([p.size for p in pages], kind="stable")
        batches = [order[i : i + BATCH] for i in range(0, len(order), BATCH)]
        step, steps = 0, epochs * len(batches)
        for _ in range(epochs):
            for b in r.permutation(len(batches)):
                step += 1
                _, grad = self.gradients([pages[i] for i in batches[b]], np.concatenate([truths[i] for i in batches[b]]))
                rate = RATE * (1 - 0.9 * step / steps)
                norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
                for k, g in grad.items():
                    g *= min(1.0, 1 / (norm + 1e-9))
                    if k in ("paths", "words"):
                        g += 1e-6 * self.w[k]
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.002 * (g * g - second[k])
                    self.w[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.998**step)) + 1e-8)).astype(self.w[k].dtype)
        return self

    def label(self, pages: Sequence[Page]) -> list[np.ndarray]:
        """The probability of each leaf to be the article's, by page; pages of like length are read together."""
        out = [np.zeros(0, np.float32) for _ in pages]
        order = [i for i in np.argsort([p.size for p in pages], kind="stable").tolist() if pages[i].size]
        while order:
            n = next((n for n in range(len(order), 1, -1) if n * pages[order[n - 1]].size <= CELLS), 1)
            group, order = order[:n], order[n:]
            found = _sigmoid(self.forward([pages[i] for i in group])[0])
            for i, part in zip(group, np.split(found, np.cumsum([pages[i].size for i in group])[:-1]), strict=True):
                out[i] = part.astype(np.float32)
        return out


def by_markup(found: list[Leaf]) -> np.ndarray | None:
    """Which leaves a page itself marks as its article's; nothing if it marks none."""
    inside = [any(t in ("article", "main") for t in x.tags) for x in found]
    return np.array([i and not OUTSIDE & set(x.tags) for i, x in zip(inside, found, strict=True)], dtype=bool) if any(inside) else None


def train(htmls: Sequence[str], layouts: int = LAYOUTS, seed: int = 0) -> Labeller:
    """A labeller fitted on pages and on layouts of their texts; without any page, on layouts of made-up words."""
    examples: list[tuple[list[Leaf], np.ndarray]] = []
    paragraphs: list[str] = []
    for html in htmls:
        found = leaves(html)
        own = by_markup(found)
        paragraphs += [x.text for i, x in enumerate(found) if own is None or own[i] or not i % 4]
        if own is not None:
            examples += [(found, own)] * 2  # they weigh more than a drawn layout each
    r = random.Random(seed)
    if len(paragraphs) < 50:
        word = lambda: "".join(r.choice("aeioubcdfglmnprst") for _ in range(r.randint(1, 9)))
        paragraphs += [" ".join(word() for _ in range(r.choice([3, 12, 40, 90]))).capitalize() + "." for _ in range(500)]
    for _ in range(layouts):
        found, truth = marked(Layout(r, paragraphs).html())
        examples.append((found, np.array(truth, dtype=bool)))
    pages, truths = [], []
    for found, truth in examples:
        if len(found):
            lo = r.randrange(max(1, len(found) - WINDOW + 1))
            pages.append(Page(found[lo : lo + WINDOW]))
            truths.append(truth[lo : lo + WINDOW])
    return Labeller(seed).fit(pages, truths, seed=seed)


def learn(pages: DataFrame, html: str = "html", most: int = SAMPLE_PAGES, chars: int = SAMPLE_CHARS, layouts: int = LAYOUTS) -> Labeller:
    """A labeller fitted on at most `most` different pages that have at most chars / most characters each, drawn by a hash of
    their text. The first pass counts pages, so that the second one sends on little more than it draws."""
    short = pages.select(F.col(html).alias("html")).where(F.length("html") <= chars // most).withColumn("hash", F.xxhash64("html"))
    n = short.agg(F.approx_count_distinct("hash")).first()[0]
    drawn = short.where(F.pmod("hash", F.lit(1 << 30)) < (1 << 30) * min(1.0, 3 * most / max(1, n)))
    unlike = drawn.groupBy("hash").agg(F.min("html").alias("html"))  # copies of a page collapse where they are read
    return train([r["html"] for r in unlike.orderBy("hash").limit(most).collect()], layouts)


def extract(pages: DataFrame, labeller: Labeller, html: str = "html", least: float = 0.5) -> DataFrame:
    """row (all columns of pages but html), text, n_chars, n_blocks, blocks (positions of those that are the article's) and
    scores (of all). Narrow.

    Null html counts as empty: no block, empty text. Very long pages are read whole, one at a time; the labeller's memory
    grows with a page's leaves (some 2 KB each). Repeated rows have equal results; an empty table gives none. Columns of any
    name are handed on inside `row`.
    """
    kept = pages.drop(html)
    rows = F.struct(*[kept[f"`{c}`"] for c in kept.columns]) if kept.columns else F.lit(None).cast("struct<none:int>")
    packed = pages.select(rows.alias("row"), F.coalesce(pages[f"`{html}`"], F.lit("")).alias("html"))
    made = StructType([packed.schema["row"], StructField("text", StringType()), StructField("n_chars", LongType()), StructField("n_blocks", IntegerType()), StructField("blocks", ArrayType(IntegerType())), StructField("scores", ArrayType(FloatType()))])
    weights = labeller.w

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Labeller(w=weights)
        for batch in batches:
            lengths = np.diff(batch.column("html").offsets.to_numpy()) if hasattr(batch.column("html"), "offsets") else np.array([len(x.as_py()) for x in batch.column("html")])
            for lo, hi in slices(lengths, BATCH_CHARS):
                found = [leaves(x.as_py()) for x in batch.column("html").slice(lo, hi - lo)]
                scores = model.label([Page(x) for x in found])
                at = [np.flatnonzero(s >= least) for s in scores]
                texts = [" ".join(x[i].text for i in a.tolist()) for x, a in zip(found, at, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(lo, hi - lo), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array([len(x) for x in found], pa.int32()), pa.array([a.tolist() for a in at], pa.list_(pa.int32())), pa.array([s.tolist() for s in scores], pa.list_(pa.float32()))],
                    ["row", "text", "n_chars", "n_blocks", "blocks", "scores"],
                )

    return packed.mapInArrow(run, made)
