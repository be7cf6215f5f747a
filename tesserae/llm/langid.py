"""Language identification by rank-order profiles (operator 2).

A profile is the list of the K most frequent letter n-grams (n = 1 to 3, words padded with a boundary) in order. A
document's own profile is compared with each language's: every n-gram costs the difference of its two ranks, or K if the
language's profile lacks it. The language with the least mean cost wins.

An n-gram is packed exactly into 63 bits (three code points), so counting is a sort of integers; no hashing, no cut texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tesserae.llm.common import beside_row, slices, text_or_empty, texts_of

PROFILE = 400
UNKNOWN = "und"
#: A document whose best similarity is lower belongs to no learned language.
LEAST_SCORE = 0.02
BATCH_CHARS = 1_000_000


@cache
def _letters() -> np.ndarray:
    """For each code point: whether it is a letter."""
    known = np.zeros(0x110000, dtype=bool)
    known[[i for i in range(0x110000) if chr(i).isalpha()]] = True
    return known


def grams(text: str) -> np.ndarray:
    """Packed n-grams of the lower-cased text, repeats included; empty if it has no letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    s = np.zeros(len(codes) + 2, dtype=np.int64)
    s[1:-1] = np.where(_letters()[codes], codes, 0)
    s = s[np.append(True, (s[1:] != 0) | (s[:-1] != 0))] + 1  # one boundary (1) between words
    inner = s[1:-1] > 1
    one = s[s > 1]
    two = (s[:-1] << 21) | s[1:]
    three = ((s[:-2] << 42) | (s[1:-1] << 21) | s[2:])[inner]
    return np.concatenate([one, two, three]) if len(one) else one


def counted(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ordered = np.sort(packed)
    at = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else np.zeros(0, dtype=np.int64)
    return ordered[at], np.diff(np.append(at, len(ordered)))


def ranked(packed: np.ndarray, most: int) -> np.ndarray:
    """The `most` most frequent n-grams in order; ties by packed value."""
    unique, n = counted(packed)
    return unique[np.argsort(-n, kind="stable")[:most]]


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", most: int = PROFILE) -> dict[str, np.ndarray]:
    """Profile of each non-null language over all rows of docs. What reaches the driver is `most` rows per language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            texts, langs = batch.column("text"), batch.column("lang").to_pylist()
            for lo, hi in slices(np.array([len(x.as_py()) for x in texts]), BATCH_CHARS):
                of: dict[str, list[str]] = {}
                for i in range(lo, hi):
                    of.setdefault(langs[i], []).append(texts[i].as_py())
                for k, parts in of.items():
                    unique, n = counted(grams("\n".join(parts)))
                    if k in held:
                        unique, n = np.concatenate([held[k][0], unique]), np.concatenate([held[k][1], n])
                        order = np.argsort(unique, kind="stable")
                        unique, n = unique[order], n[order]
                        at = np.flatnonzero(np.append(True, unique[1:] != unique[:-1]))
                        unique, n = unique[at], np.add.reduceat(n, at) if len(n) else n
                    held[k] = unique, n
        for k, (unique, n) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(unique)), pa.array(unique), pa.array(n)], ["lang", "gram", "n"])

    rows = docs.where(F.col(lang).isNotNull()).select(text_or_empty(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    counts = rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    top = counts.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "gram"))).where(F.col("rank") <= most)
    found: dict[str, list] = {}
    for r in top.orderBy("lang", "rank").collect():
        found.setdefault(r["lang"], []).append(r["gram"])
    return {k: np.array(v, dtype=np.int64) for k, v in found.items()}


def similarities(text: str, profiles: dict[str, np.ndarray], most: int = PROFILE) -> dict[str, float]:
    """1 - mean out-of-place cost / most, per language; empty if the text has no letter."""
    own = ranked(grams(text), most)
    return {k: float(x) for k, x in zip(profiles, _compare(own, _indexed(profiles), most), strict=True)} if len(own) else {}


def _indexed(profiles: dict[str, np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    return [(p[order], order) for p in profiles.values() for order in [np.argsort(p)]]


def _compare(own: np.ndarray, indexed: list[tuple[np.ndarray, np.ndarray]], most: int) -> list[float]:
    place, found = np.arange(len(own)), []
    for ordered, rank in indexed:
        at = np.minimum(np.searchsorted(ordered, own), len(ordered) - 1)
        cost = np.where(ordered[at] == own, np.abs(rank[at] - place), most)
        found.append(1 - cost.mean() / most)
    return found


def predict(docs: DataFrame, profiles: dict[str, np.ndarray], text: str = "text", most: int = PROFILE) -> DataFrame:
    """row (all columns of docs), lang_pred, score and margin (score less the second best). Narrow.

    Null or letterless text, or no learned language: `und`, score 0. Ties go to the language first in order.
    """
    names = sorted(profiles)
    indexed = _indexed({k: profiles[k] for k in names})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pred, score, margin = [], [], []
            for x in texts_of(batch, text):
                own = ranked(grams(x.as_py()), most)
                near = np.maximum(0.0, _compare(own, indexed, most)) if len(own) and names else np.zeros(1)
                best = int(np.argmax(near))
                pred.append(names[best] if len(own) and names else UNKNOWN)
                score.append(float(near[best]))
                margin.append(float(near[best] - max(np.delete(near, best), default=0.0)))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(margin, pa.float64())], ["row", "lang_pred", "score", "margin"])

    packed = docs.select(F.struct("*").alias("row"))
    return packed.mapInArrow(run, beside_row(packed, "lang_pred string, score double, margin double"))


def held_out(id: str = "doc_id") -> Column:
    """Rows that are never learned from; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def identify(docs: DataFrame, text: str = "text", id: str = "doc_id", lang: str = "lang") -> DataFrame:
    """Per row of docs: id, held_out, lang_pred, score, margin. Profiles come from the rows that are not held out.

    Null or letterless text gives `und`; null lang is not learned. Repeated rows are predicted alike; extra columns are
    ignored; an empty table gives no rows.
    """
    profiles = learn(docs.where(~held_out(id)), text, lang)
    found = predict(docs.select(F.col(id).alias("id"), F.col(text).alias("text")), profiles)
    return found.select(F.col("row.id").alias("id"), "lang_pred", "score", "margin").withColumn("held_out", held_out("id")).select(F.col("id").alias(id), "held_out", "lang_pred", "score", "margin")


def known(docs: DataFrame, text: str = "text", id: str = "doc_id", lang: str = "lang", least: float = LEAST_SCORE) -> DataFrame:
    """The rows of docs, all columns, whose text is in a learned language: not `und`, similarity `least` or more. Without
    any learned language every row with a letter stays."""
    profiles = learn(docs.where(~held_out(id)), text, lang)
    if not profiles:
        return docs.where(F.regexp_like(text_or_empty(text), F.lit(r"\p{L}")))
    return predict(docs, profiles, text).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select("row.*")
