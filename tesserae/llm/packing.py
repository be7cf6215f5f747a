"""Vector best-fit packing of tokenised documents (operator 8).

A narrow pass tokenises: the tokenizer drops white space and never looks across it, so each distinct run of other
characters is encoded once per worker and a document is the concatenation of its runs. Only piece lengths move from there.
Pieces go to shards of bounded token count by hash. In a shard they are placed longest first into the open sequence that
fits under every capacity (tokens, documents, attention cost) and whose weighted residual is smallest after placing.
Sequences that stay short of full are opened again and their pieces packed together in a second round.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import beside_row, materialize, texts_of

CAPACITY = 4_096
END_ID = 1
SHARD_TOKENS = 2_000_000
#: A sequence with a larger share of free tokens is opened again in the second round.
SLACK = 0.01
#: Words whose ids a worker remembers, at most; about 200 bytes each.
CACHED_WORDS = 800_000
#: Anything but Latin letters, whose lower case is one letter, ASCII and common signs; also white space beyond ASCII.
UNUSUAL = re.compile(r"[^\x00-\x1b\x20-\x84\x86-\x9f\xa1-\u012f\u0131-\u024f]")
OTHER_SPACE = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: A comma or full stop at the end of a word that does not follow a letter or digit: it may belong to a longer mark.
JOINED_MARK = re.compile(r"[.,](?<![^\W_][.,])(?=[ \n]|\Z)")


@cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@cache
def _special(path: str) -> re.Pattern:
    """Tokens that stand for themselves in a text (`<|endoftext|>`), in any case: lower-casing could make or break one."""
    found = sorted(t.content for t in _tokenizer(path).get_added_tokens_decoder().values())
    return re.compile("|".join(map(re.escape, found)) or r"(?!)", re.I)


def split(text: str, special: re.Pattern) -> list[str]:
    """Parts of a text whose ids make up the text's. Usual texts are lower-cased and lose their closing commas and full
    stops to parts of their own, so that there are fewer different ones; only ASCII white space separates. Texts with
    unusual letters or special tokens are cut at white space alone."""
    if UNUSUAL.search(text) or special.search(text):
        return [w.decode() for w in text.encode().split()] if OTHER_SPACE.search(text) else text.split()
    text = text.lower()
    if not JOINED_MARK.search(text):
        for mark in ",.":
            text = text.replace(f"{mark} ", f" {mark} ").replace(f"{mark}\n", f" {mark}\n")
        if text[-1:] in (",", "."):
            text = f"{text[:-1]} {text[-1]}"
    return text.split()


class Encoder:
    """Token ids of whole texts as little-endian unsigned 32-bit integers; what it remembers is bounded."""

    def __init__(self, path: str, most: int = CACHED_WORDS):
        self.tokenizer, self.special, self.words, self.most = _tokenizer(path), _special(path), {}, most

    def _encode(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _encode_letters(self, words: list[str]) -> list[bytes]:
        """The same for words of letters only, in one call: each is one pre-token, whose number marks its ids."""
        if not words:
            return []
        found = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
        ids = np.array(found.ids, dtype="<u4").tobytes()
        cuts = [0, *((np.flatnonzero(np.diff(found.word_ids)) + 1) * 4).tolist(), len(ids)]
        if len(cuts) != len(words) + 1:  # lower case of some letters is more than a letter
            return self._encode(words)
        return [ids[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def learn(self, words: set[str]) -> None:
        """Adds words. One of usual letters and a closing comma or full stop is its letters' ids and the mark's; some other
        letters end in a sign when lower-cased, which would join the mark."""
        known = self.words
        marked = {w for w in words if w[-1] in ".," and w[:-1].isalpha() and not UNUSUAL.search(w)}
        stem = {w: (w[:-1].lower() if w.isascii() else w[:-1]) for w in marked}
        plain = {w: w.lower() if w.isascii() and not self.special.search(w) else w for w in words - marked}
        new = ({*stem.values(), *plain.values(), ".", ","}).difference(known)
        letters = [p for p in new if p.isalpha()]
        for i in range(0, len(letters), 1_000):
            known.update(zip(letters[i : i + 1_000], self._encode_letters(letters[i : i + 1_000]), strict=True))
        other = [p for p in new if not p.isalpha()]
        known.update(zip(other, self._encode(other), strict=True))
        known.update((w, known[x]) for w, x in plain.items())
        known.update((w, known[x] + known[w[-1]]) for w, x in stem.items())

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        for i in range(0, len(texts), 256):
            if len(self.words) > self.most:
                self.words.clear()
            parts = [split(x, self.special) for x in texts[i : i + 256]]
            self.learn(set().union(*parts).difference(self.words))
            get = self.words.__getitem__
            for words in parts:
                yield b"".join(map(get, words))


@cache
def _encoder(path: str, most: int) -> Encoder:
    """One per worker process: tasks that follow find the words known."""
    return Encoder(path, most)


def pieces(docs: DataFrame, path: str, text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, cached_words: int = CACHED_WORDS) -> DataFrame:
    """row (all columns of docs), piece, start, length, ids_crc32: each document's ids and end_id, cut only where it is
    longer than capacity. Null text counts as empty. Narrow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = _encoder(path, cached_words), np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            for lo in range(0, len(batch), 2_000):
                part = batch.slice(lo, 2_000)
                at: list[int] = []
                out: list[tuple[int, int, int, int]] = []
                for i, ids in enumerate(encode(texts_of(part, text).to_pylist())):
                    ids += end
                    for k, start in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[start : start + 4 * capacity]
                        at.append(i)
                        out.append((k, start // 4, len(own) // 4, zlib.crc32(own)))
                k, start, length, crc = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([part.column("row").take(pa.array(at)), pa.array(k, pa.int32()), *[pa.array(x, pa.int64()) for x in (start, length, crc)]], ["row", "piece", "start", "length", "ids_crc32"])

    packed = docs.select(F.struct("*").alias("row"))
    return packed.mapInArrow(run, beside_row(packed, "piece int, start long, length long, ids_crc32 long"))


def best_fit(demand: np.ndarray, capacity: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Bin of each row of demand (tokens, documents, attention cost; all divided by nothing), placed in order of falling
    weighted demand. A bin must fit in every dimension; of those that do, the one with the smallest weighted norm of what
    is left after placing wins, the oldest on ties. A demand that fits no empty bin gets a bin of its own."""
    scale = weight / capacity
    order = np.argsort(-(demand * scale).sum(axis=1), kind="stable")
    least = demand.min(axis=0, initial=0) if not len(demand) else demand.min(axis=0)
    left, names, bins, count = np.zeros((0, demand.shape[1])), np.zeros(0, dtype=np.int64), np.zeros(len(demand), dtype=np.int64), 0
    buffer, owner, used = np.empty((64, demand.shape[1])), np.empty(64, dtype=np.int64), 0
    for i in order.tolist():
        d = demand[i]
        left, names = buffer[:used], owner[:used]
        after = left - d
        fits = (after >= 0).all(axis=1)
        if fits.any():
            norm = np.where(fits, ((after * scale) ** 2).sum(axis=1), np.inf)
            b = int(norm.argmin())
            bins[i] = names[b]
            left[b] = after[b]
        else:
            if used == len(buffer):
                buffer, owner = np.concatenate([buffer, np.empty_like(buffer)]), np.concatenate([owner, np.empty_like(owner)])
            buffer[used], owner[used], b = capacity - d, count, used
            bins[i], count, used = count, count + 1, used + 1
        if (buffer[b] < least).any():  # nothing fits any more
            keep = np.arange(used) != b
            used -= 1
            buffer[:used], owner[:used] = buffer[: used + 1][keep], owner[: used + 1][keep]
    return bins


def _round(rows: DataFrame, tokens: int, round: int, capacity: int, documents: int, attention: float, weights: tuple) -> DataFrame:
    """Packs rows (id, piece, start, length, ids_crc32) in shards; adds sequence_id, offset and fill."""
    shards = max(1, -(-tokens // SHARD_TOKENS))
    most, weight = np.array([capacity, documents, attention], dtype=np.float64), np.array(weights, dtype=np.float64)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "id", "piece", "ids_crc32"], ascending=[False, True, True, True], kind="stable").reset_index(drop=True)
        length = pdf["length"].to_numpy()
        bins = best_fit(np.stack([length, np.ones(len(pdf)), length.astype(np.float64) ** 2], axis=1), most, weight)
        pdf["sequence_id"] = (round << 62) + (int(pdf["shard"].iloc[0]) << 32) + bins
        by = pdf.groupby("sequence_id")["length"]
        pdf["offset"] = by.cumsum() - pdf["length"]
        pdf["fill"] = by.transform("sum")
        return pdf

    kind = rows.schema["id"].dataType.simpleString()
    keyed = rows.withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))  # rows of a written table
    return keyed.groupBy("shard").applyInPandas(run, f"id {kind}, piece int, start long, length long, ids_crc32 long, shard long, sequence_id long, offset long, fill long")


def pack(docs: DataFrame, path: str, text: str = "text", id: str = "doc_id", capacity: int = CAPACITY, end_id: int = END_ID, documents: int = CAPACITY, attention: float = float(CAPACITY) ** 2, weights: tuple = (1.0, 0.05, 0.2), cached_words: int = CACHED_WORDS) -> DataFrame:
    """One row per piece of each row of docs: id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are one piece of one id. Rows with the same id (null among them) are packed apart. A sequence
    holds at most `capacity` tokens, `documents` pieces and `attention` squared piece lengths, except that a piece which
    alone exceeds one of the last two stands alone. Extra columns are ignored; an empty table gives no rows.
    """
    cut = pieces(docs.select(F.col(id).alias("id"), F.col(text).alias("text")).select("id", "text"), path, "text", capacity, end_id, cached_words)
    cut = materialize(cut.select("row.id", "piece", "start", "length", "ids_crc32"))
    names = ["id", "piece", "start", "length", "ids_crc32"]
    tokens = lambda df: df.agg(F.sum("length")).first()[0] or 0
    first = materialize(_round(cut, tokens(cut), 0, capacity, documents, attention, weights))
    short = F.col("fill") < (1 - SLACK) * capacity
    again = first.where(short).select(names)
    second = _round(again, tokens(again), 1, capacity, documents, attention, weights)
    out = [*names, "sequence_id", "offset"]
    return first.where(~short).select(out).unionByName(second.select(out)).withColumnRenamed("id", id)
