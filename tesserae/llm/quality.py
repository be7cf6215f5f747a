"""Quality classifier: interpolated modified Kneser-Ney (operator 1).

One model per language over the bytes of the lower-cased text (any script, no vocabulary to cut), trained on trusted text.
An n-gram of N bytes is one integer, so a prefix is a shift and a suffix a mask, and the whole model is made of counts
joined by integer keys, sharded by n-gram. Documents are dealt into blocks of one language. A block sends its distinct
n-grams, the model answers each distinct n-gram of the corpus once, and the answers come back to the block, where every byte
of every text is looked up. Texts travel compressed, answers are as many as a block's distinct n-grams, and nothing that
grows is broadcast.

A language's threshold is a quantile of the perplexities of trusted documents that were left out of training.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import materialize, slices, small

ORDER = 6
#: Bytes of text in a block, on average; the larger, the fewer n-grams are asked for by several blocks.
BLOCK_BYTES = 32_000_000
LEAST_BLOCKS = 2
#: Rows of one id that may go to one block.
HOT_ROWS = 1_000
QUANTILE = 0.995
#: One trusted document in so many is left out of training and sets the threshold.
HELD_OUT = 5
SLICE = 1_000_000


def grams(texts: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram ending at each byte, first position of each text); every text begins after order - 1 zero bytes."""
    pad = bytes(order - 1)
    data = np.frombuffer(b"".join(x for t in texts for x in (pad, t)), dtype=np.uint8).astype(np.int64)
    length = np.array([len(t) for t in texts], dtype=np.int64)
    begin = np.cumsum(length + order - 1) - length
    if not length.sum():
        return np.zeros(0, dtype=np.int64), np.zeros(len(texts) + 1, dtype=np.int64)
    g = data[order - 1 :].copy()
    for k in range(1, order):
        g |= data[order - 1 - k : len(data) - k] << (8 * k)
    at = np.repeat(begin - (order - 1), length) + np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    return g[at], np.append(0, np.cumsum(length))


def _pack(kind: str):
    """Rows -> one row per batch and block, its texts lower-cased and compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            of: dict[tuple, list[int]] = {}
            for i, k in enumerate(zip(batch.column("lang").to_pylist(), batch.column("slice").to_pylist(), strict=True)):
                of.setdefault(k, []).append(i)
            texts, ids, held = batch.column("text"), batch.column("id"), batch.column("held").to_pylist()
            out: list[list] = [[], [], [], [], [], []]
            for (lang, part), rows in of.items():
                own = [texts[i].as_py().encode().lower() for i in rows]
                for o, x in zip(out, (lang, part, ids.take(pa.array(rows)).to_pylist(), [held[i] for i in rows], [len(t) for t in own], squeeze.compress(b"".join(own))), strict=True):
                    o.append(x)
            types = (pa.string(), pa.int64(), pa.list_(ids.type), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, types, strict=True)], ["lang", "slice", "ids", "held", "bytes", "texts"])

    return run, f"lang string, slice long, ids array<{kind}>, held array<boolean>, bytes array<long>, texts binary"


def _texts(row: dict) -> list[bytes]:
    data = zstandard.ZstdDecompressor().decompress(row["texts"]) if sum(row["bytes"]) else b""
    edge = np.append(0, np.cumsum(row["bytes"])).astype(np.int64).tolist()
    return [data[a:b] for a, b in zip(edge, edge[1:], strict=False)]


def _sliced(texts: list[bytes], order: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, n-grams, first position of each text) in runs of about SLICE bytes."""
    for lo, hi in slices(np.array([len(t) for t in texts]), SLICE):
        yield lo, *grams(texts[lo:hi], order)


def _gather(order: int):
    """A block's documents and trusted ids -> (lang, slice, gram, n): its distinct n-grams, n of them in trained text."""

    def run(docs: pa.Table, trusted: pa.Table) -> pa.Table:
        known = set(trusted.column("id").to_pylist())
        parts = []
        for row in docs.to_pylist():
            texts = _texts(row)
            train = np.array([i in known and not h for i, h in zip(row["ids"], row["held"], strict=True)], dtype=np.int64)
            for lo, g, first in _sliced(texts, order):
                weight = np.repeat(train[lo : lo + len(first) - 1], np.diff(first))
                at = np.argsort(g, kind="stable")
                g, weight = g[at], weight[at]
                new = np.flatnonzero(np.append(True, g[1:] != g[:-1])) if len(g) else g
                parts.append((g[new], np.add.reduceat(weight, new) if len(g) else g))
        g, n = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, dtype=np.int64),) * 2
        at = np.argsort(g, kind="stable")
        g, n = g[at], n[at]
        new = np.flatnonzero(np.append(True, g[1:] != g[:-1])) if len(g) else g
        n = np.add.reduceat(n, new) if len(g) else n
        of = docs if len(docs) else trusted
        lang, part = of.column("lang")[0], of.column("slice")[0]
        return pa.table({"lang": pa.repeat(lang, len(new)), "slice": pa.repeat(part, len(new)), "gram": g[new], "n": n})

    return run, "lang string, slice long, gram long, n long"


def _score(order: int, kind: str):
    """A block's documents and its answers -> (id, lang, held, bytes, logp)."""

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        known, logp = (answers.column(c).to_numpy() for c in ("gram", "logp"))
        slots, shift = _table(known)
        ids, held, size, total = [], [], [], []
        for row in docs.to_pylist():
            ids += row["ids"]
            held += row["held"]
            size += row["bytes"]
            for _, g, first in _sliced(_texts(row), order):
                each = np.append(0.0, np.cumsum(logp[_look_up(known, slots, shift, g)]))
                total += (each[first[1:]] - each[first[:-1]]).tolist()
        type_of = docs.schema.field("ids").type.value_type
        lang = docs.column("lang").to_pylist()[:1] * len(ids)
        return pa.table({"id": pa.array(ids, type_of), "lang": pa.array(lang, pa.string()), "held": pa.array(held, pa.bool_()), "bytes": pa.array(size, pa.int64()), "logp": pa.array(total, pa.float64())})

    return run, f"id {kind}, lang string, held boolean, bytes long, logp double"


_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _table(keys: np.ndarray) -> tuple[np.ndarray, int]:
    """Open-addressing table of positions in keys, four slots a key at least."""
    bits = max(4, int(len(keys) * 4).bit_length())
    slots, shift = np.full(1 << bits, -1, dtype=np.int32), 64 - bits
    left, at = np.arange(len(keys)), ((keys.view(np.uint64) * _MULTIPLIER) >> np.uint64(shift)).astype(np.int64)
    while len(left):
        free = slots[at] < 0
        slots[at[free]] = left[free]  # of several keys for a slot the last one gets it
        lost = slots[at] != left
        left, at = left[lost], (at[lost] + 1) & ((1 << bits) - 1)
    return slots, shift


def _look_up(keys: np.ndarray, slots: np.ndarray, shift: int, g: np.ndarray) -> np.ndarray:
    """Position in keys of each g; every g is there."""
    at = ((g.view(np.uint64) * _MULTIPLIER) >> np.uint64(shift)).astype(np.int64)
    found = slots[at].astype(np.int64)
    wrong = np.flatnonzero(keys[found] != g)
    while len(wrong):
        at[wrong] = (at[wrong] + 1) & (len(slots) - 1)
        found[wrong] = slots[at[wrong]]
        wrong = wrong[keys[found[wrong]] != g[wrong]]
    return found


# --- the model ------------------------------------------------------------------------------------------------------


def _suffix(g: Column, n: int) -> Column:
    return g.bitwiseAND(F.lit((1 << (8 * n)) - 1))


def _discounts(counts: DataFrame) -> DataFrame:
    """Per language D1, D2, D3 of modified Kneser-Ney from the counts of counts; 0.5, 1, 1.5 where those are too thin."""
    n = [F.count_if(F.col("n") == k).cast("double") for k in (1, 2, 3, 4)]
    of = counts.groupBy("lang").agg(*[x.alias(f"n{k}") for k, x in enumerate(n, 1)])
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    ok = (F.col("n1") > 0) & (F.col("n2") > 0) & (F.col("n3") > 0) & (F.col("n4") > 0)
    d = [F.when(ok, F.greatest(F.lit(0.05), k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}"))).otherwise(0.5 * k) for k in (1, 2, 3)]
    return of.select("lang", *[x.alias(f"d{k}") for k, x in enumerate(d, 1)])


def model(counts: DataFrame, order: int = ORDER) -> list[tuple[DataFrame, DataFrame]]:
    """counts (lang, gram, n) of the highest order -> for each order from 1: (lang, gram, own) with the discounted share of
    an n-gram in its context, and (lang, context, back) with the weight that the context leaves to the next lower order.
    Below the highest order an n-gram counts once for each byte that precedes it."""
    out, of = [], counts
    for k in range(order, 0, -1):
        if k < order:
            of = materialize(of.groupBy("lang", _suffix(F.col("gram"), k).alias("gram")).agg(F.count("*").alias("n")))
        d = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        cut = of.join(small(materialize(_discounts(of))), "lang").withColumn("context", F.shiftright("gram", 8)).withColumn("d", F.least(d, F.col("n")))
        back = cut.groupBy("lang", "context").agg((F.sum("d") / F.sum("n")).alias("back"), F.sum("n").alias("total"))
        own = cut.join(back, ["lang", "context"]).select("lang", "gram", ((F.col("n") - F.col("d")) / F.col("total")).alias("own"))
        out.append((own, back.drop("total")))
    return out[::-1]


def answers(asked: DataFrame, levels: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """asked (lang, gram), distinct -> with logp, natural log of the interpolated probability of the last byte. Lower orders
    are answered once per distinct suffix."""
    p: DataFrame | None = None
    for k, (own, back) in enumerate(levels, 1):
        of = asked if k == len(levels) else asked.select("lang", _suffix(F.col("gram"), k).alias("gram")).distinct()
        of = of.withColumns({"c": F.shiftright("gram", 8), "lower": _suffix(F.col("gram"), k - 1)})
        of = of.join(own, ["lang", "gram"], "left").join(back.withColumnRenamed("context", "c"), ["lang", "c"], "left")
        of = of.withColumn("p", F.lit(1 / 256)) if p is None else of.join(p.withColumnRenamed("gram", "lower"), ["lang", "lower"])
        p = of.select("lang", "gram", (F.coalesce("own", F.lit(0.0)) + F.coalesce("back", F.lit(1.0)) * F.col("p")).alias("p"))
        p = materialize(p) if k < len(levels) else p
    return p.select("lang", "gram", F.log("p").alias("logp"))


def _dealt(rows: DataFrame, trusted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """rows with their block (lang, slice), and trusted ids (lang, slice, id) of each block. A block is drawn by id; the rows
    of an id that very many share (null, or repeated rows) are dealt over several blocks, each of which is told the id."""
    sizes = rows.groupBy("lang").agg(F.greatest(F.lit(LEAST_BLOCKS), F.ceil(F.sum(F.octet_length("text")) / BLOCK_BYTES)).alias("slices"))
    sizes = small(materialize(sizes))
    hot = materialize(rows.groupBy("id").count().where(F.col("count") > HOT_ROWS).select("id", F.ceil(F.col("count") / HOT_ROWS).alias("parts")))
    some = not hot.isEmpty()
    split = lambda df: df.alias("d").join(small(hot).alias("h"), F.col("d.id").eqNullSafe(F.col("h.id")), "left").select("d.*", F.coalesce("parts", F.lit(1)).alias("parts")) if some else df.withColumn("parts", F.lit(1).cast("long"))
    slice_of = F.pmod(F.xxhash64("id", "part"), F.col("slices"))
    placed = split(rows.withColumn("place", F.monotonically_increasing_id())).withColumn("part", F.pmod(F.col("place"), F.col("parts")))
    placed = placed.join(sizes, "lang").withColumn("slice", slice_of).drop("place", "part", "parts", "slices")
    known = split(rows.select("lang", "id").join(trusted, "id", "left_semi").distinct()).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    return placed, known.join(sizes, "lang").select("lang", slice_of.alias("slice"), "id").distinct()


def classify(docs: DataFrame, trusted: DataFrame, text: str = "text", id: str = "doc_id", lang: str = "lang", order: int = ORDER, quantile: float = QUANTILE) -> DataFrame:
    """One row per row of docs: id, lang, perplexity (per byte), threshold (of its language), kept.

    trusted: a column of ids. Null lang counts as the language `und`. Null and empty texts have a null perplexity and are
    not kept. Without trusted held-out text in a language its threshold is null and all its other texts are kept; without
    trained text the model is uniform. A null id is never trusted; repeated rows are scored alike. Extra columns are
    ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"))
    trusted = trusted.toDF("id").where("id IS NOT NULL").distinct()
    placed, known = _dealt(rows, trusted)
    placed = placed.withColumn("held", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(HELD_OUT)) == 0)
    kind = rows.schema["id"].dataType.simpleString()
    block = ["lang", "slice"]
    packed = placed.select("lang", "slice", "id", "held", "text").mapInArrow(*_pack(kind))
    found = materialize(packed.groupBy(*block).cogroup(known.groupBy(*block)).applyInArrow(*_gather(order)))
    asked = materialize(found.groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    said = answers(asked.select("lang", "gram"), model(asked.where("n > 0"), order))
    table = found.select("lang", "slice", "gram").join(materialize(said), ["lang", "gram"])
    scored = packed.groupBy(*block).cogroup(table.groupBy(*block)).applyInArrow(*_score(order, kind))
    scored = materialize(scored.withColumn("perplexity", F.when(F.col("bytes") > 0, F.exp(-F.col("logp") / F.col("bytes")))).select("id", "lang", "held", "perplexity"))
    quantiles = scored.where("held").join(trusted, "id", "left_semi").groupBy("lang").agg(F.percentile_approx("perplexity", quantile, 10_000).alias("threshold"))
    out = scored.join(small(materialize(quantiles)), "lang", "left")
    kept = F.col("perplexity").isNotNull() & F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))
    return out.select(F.col("id").alias(id), "lang", "perplexity", "threshold", kept.alias("kept"))
