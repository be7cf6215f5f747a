"""Substring dedup by relative Lempel-Ziv parsing (operator 10).

Documents are factored greedily, left to right, against indexed reference blocks: a factor is the longest run of words at a
place that also stands elsewhere in the block, and a factor of a window's length or more is a duplicate span. The parse goes
on one window before a factor's end, so windows that cross its boundary are looked up too.

A factor of a window's length holds the anchor of each of its windows: the word sequence of least hash among those in the
window, which a copy chooses at the same place. So a document need not meet a block with which it shares no anchor. Blocks
come in two kinds: what a task holds at a time, parsed against itself; and the passages (the windows around one anchor) that
all tasks send to the anchor's block. A block's index is a suffix array of its words, by content and not by hash; neighbours in
it give each place its longest match, so nothing is compared pair by pair. Longer matches are cut into several factors.

A task settles what repeats inside it and sends a window on once. An anchor from very many places is lengthened to the whole
window (128-bit hash), so neither a frequent passage nor its many different surroundings fill a task. Equal texts (two
64-bit hashes) are parsed once.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import materialize, slices, text_or_empty
from tesserae.llm.simhash import groups, starts
from tesserae.llm.words import Words, mixed, runs_hash, words

WINDOW = 35
SEED = 12
#: Windows of a passage, at most: so many choose one anchor.
MOST_RUN = 63
#: Words that a block of a task holds at a time.
BLOCK_WORDS = 1_000_000
#: Bytes of text that are taken apart at a time, of documents and of passages.
SLICE_BYTES, PASSAGE_BYTES = 250_000, 4_000_000
#: Places of one seed that may meet in one group of rows.
HOT_PLACES = 1_000
SEED_BASE, WINDOW_BASE = 0xD6E8FEB86659FD93, 0xA0761D6478BD642F
_PLACE = np.uint64((1 << 34) - 1)


class Parse:
    """Seeds of a slice of documents. starts: words at which a window starts; owner: the word at which that window's seed
    starts; seed: hash of each seed by its first word."""

    def __init__(self, w: Words, window: int = WINDOW, seed: int = SEED):
        n, span = len(w), window - seed + 1
        count = np.diff(w.of)
        self.starts = np.concatenate([np.arange(a, b - window + 1) for a, b in zip(w.of[:-1].tolist(), w.of[1:].tolist(), strict=True) if b - a >= window] or [np.zeros(0, dtype=np.int64)])
        self.row = np.repeat(np.arange(len(count)), np.maximum(0, count - window + 1))
        if n < window:
            self.seed = np.zeros(0, dtype=np.uint64)
            self.owner = np.zeros(0, dtype=np.int64)
            return
        at = np.arange(n - seed + 1)
        self.seed = mixed(runs_hash(w.hash, at, at + seed, SEED_BASE))
        least, width = (self.seed & ~_PLACE) | at.astype(np.uint64), 1
        while width * 2 <= span:
            least, width = np.minimum(least[:-width], least[width:]), width * 2
        if span > width:
            least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
        self.owner = (least[self.starts] & _PLACE).astype(np.int64)

    def chosen(self) -> tuple[np.ndarray, np.ndarray]:
        """(row, first word) of each chosen seed, in order."""
        new = np.append(True, (self.owner[1:] != self.owner[:-1]) | (self.row[1:] != self.row[:-1])) if len(self.owner) else np.zeros(0, dtype=bool)
        return self.row[new], self.owner[new]


def index(texts: DataFrame, window: int, seed: int) -> DataFrame:
    """texts (id, check, text) -> (id, check, hits): the chosen seeds of each text that the index has from several places,
    each with its first word and the number of groups over which its windows are split. Texts without any are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            keep = []  # two copies of a text tell as much as a thousand
            for k in zip(batch.column("id").to_pylist(), batch.column("check").to_pylist(), strict=True):
                seen[k] += 1
                keep.append(seen[k] <= 2)
            batch = batch.filter(pa.array(keep, pa.bool_()))  # noqa: PLW2901
            for w in words(batch.column("text"), SLICE_BYTES):
                p = Parse(w, window, seed)
                row, at = p.chosen()
                edge = pa.array(np.searchsorted(row, np.arange(w.hi - w.lo + 1)).astype(np.int32))
                seeds = pa.ListArray.from_arrays(edge, pa.array(p.seed[at].view(np.int64)))
                places = pa.ListArray.from_arrays(edge, pa.array((at - w.of[row]).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*[batch.column(c).slice(w.lo, w.hi - w.lo) for c in ("id", "check")], seeds, places], ["id", "check", "seeds", "places"])

    found = materialize(texts.mapInArrow(run, "id long, check long, seeds array<long>, places array<int>"))
    flat = found.select("id", "check", F.explode(F.arrays_zip("seeds", "places")).alias("s")).select("id", "check", F.col("s.seeds").alias("seed"), F.col("s.places").alias("place"))
    known = flat.groupBy("seed").count().where("count > 1").select(F.col("seed").alias("known"), F.ceil(F.col("count") / HOT_PLACES).cast("int").alias("split"))
    hits = flat.join(materialize(known), F.col("seed") == F.col("known"))
    return hits.groupBy("id", "check").agg(F.collect_set(F.struct("place", "split")).alias("hits"))  # copies say the same


class Block:
    """A suffix array of passages, sorted as deep as the first power of two above a window.

    word: ids of their words, equal only for equal words; edge: where each passage begins, and the end. size: words of the
    longest run at each place that also stands at another, up to that depth; 0 if it is under a window. code: a number for
    each place's window, -1 where none starts."""

    def __init__(self, word: np.ndarray, edge: np.ndarray, window: int):
        self.edge, self.window = edge, window
        n, depth = len(word), 1 << window.bit_length()
        rest = (np.repeat(edge[1:], np.diff(edge)) - np.arange(n)).astype(np.int32)  # words to the passage's end
        rank, k = {1: word.astype(np.int32) + np.int32(1)}, 1  # places and ranks are below 2**31, pairs of them are not
        order = np.argsort(rank[1], kind="stable").astype(np.int32)
        while k < depth:  # the order of runs of 2k words from that of runs of k
            both = rank[k] * np.int64(n + 2)
            inner = np.flatnonzero(rest > k)
            both[inner] += rank[k][inner + k]
            del inner
            order = np.argsort(both, kind="stable").astype(np.int32)
            both = both[order]
            rank[2 * k] = np.empty(n, dtype=np.int32)
            rank[2 * k][order] = np.cumsum(np.append(True, both[1:] != both[:-1])[:n], dtype=np.int32)
            del both
            k *= 2
        a, b = order[:-1], order[1:]  # neighbours in order share the longest runs
        shared = np.zeros(max(0, n - 1), dtype=np.int32)
        ends = np.minimum(rest[a], rest[b])
        for k in sorted(rank, reverse=True):
            at = np.flatnonzero(ends >= shared + k)
            shared[at[rank[k][a[at] + shared[at]] == rank[k][b[at] + shared[at]]]] += k
            del rank[k], at
        shared = np.minimum(shared, depth)  # neighbours are in no order beyond
        self.size = np.zeros(n, dtype=np.int32)
        self.size[a] = shared
        self.size[b] = np.maximum(self.size[b], shared)
        self.size[self.size < window] = 0
        self.code = np.empty(n, dtype=np.int32)
        self.code[order] = np.cumsum(np.append(1, shared < window)[:n], dtype=np.int32)
        self.code[rest < window] = -1

    def factors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(passage, first word in it, words) of the factors of a greedy parse of every passage."""
        places, out, i = np.flatnonzero(self.size), [], 0
        at, size = places.tolist(), self.size[places].tolist()
        while i < len(at):
            out.append(i)
            i = bisect_left(at, at[i] + size[i] - self.window + 1, i + 1)
        found = places[out]
        passage = np.searchsorted(self.edge, found, side="right") - 1
        return passage, found - self.edge[passage], self.size[found].astype(np.int64)


def _pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A number for each different pair of non-negative numbers."""
    return pd.factorize(a * (int(b.max(initial=0)) + 1) + b)[0]


def _often(code: np.ndarray) -> np.ndarray:
    return np.bincount(code)[code] > 1 if len(code) else np.zeros(0, dtype=bool)


_NAMES = ["route", "seed", "part", "mark", "id", "check", "first", "size", "words"]
_FACTOR, _PASSAGE = -1, 0


def _sent(seed, part, route, mark, id, check, first, size, passages=None) -> pa.RecordBatch:
    columns = [pa.array(np.ascontiguousarray(x).view(np.int64)) for x in (route, seed, part, mark, id, check, first, size)]
    return pa.RecordBatch.from_arrays([*columns, pa.nulls(len(id), pa.binary()) if passages is None else pa.array(passages, pa.binary())], _NAMES)


def _parse_own(window: int, seed: int):
    """Pass over (id, check, copies, text, hits): factors of documents against the block that their task holds (part -1), and
    what is to meet other blocks under an anchor: passages (part 0), or single windows of an anchor from very many places."""

    def settle(block: list[tuple]) -> Iterator[pa.RecordBatch]:
        if not block:
            return
        live, hashes, length, ids, check, alone, first, run_region, run_at, run_windows, run_seed, run_split = zip(*block, strict=True)
        block.clear()
        count = np.cumsum([0, *map(len, length[:-1])])
        run_region = np.concatenate([r + c for r, c in zip(run_region, count, strict=True)])
        hashes, length, ids, check, alone, first, run_at, run_windows, run_seed, run_split = map(np.concatenate, (hashes, length, ids, check, alone, first, run_at, run_windows, run_seed, run_split))
        text = pa.chunked_array(live).dictionary_encode().combine_chunks()
        del live
        edge = np.concatenate([[0], np.cumsum(length)])
        index = Block(text.indices.to_numpy(zero_copy_only=False), edge, window)
        region, at, size = index.factors()
        told = alone[region]  # a text with copies goes as a whole
        region, at, size = region[told], at[told], size[told]
        none, own = np.zeros(len(region), dtype=np.int64), mixed(ids[region].view(np.uint64) + at.astype(np.uint64))
        yield _sent(own, none + _FACTOR, own, none, ids[region], check[region], first[region] + at, size)
        lead = np.zeros(len(text), dtype=bool)  # the first place of each window in the block
        starts_at = np.flatnonzero(index.code >= 0)
        lead[starts_at] = ~pd.Series(index.code[starts_at]).duplicated().to_numpy()
        begin = edge[run_region] + run_at
        upto = np.concatenate([[0], np.cumsum(lead)])
        new = upto[begin + run_windows] > upto[begin]
        word = text.dictionary.to_pylist()
        code = text.indices.to_numpy(zero_copy_only=False)
        run = np.flatnonzero(new & (run_split == 1))
        passages = [b" ".join([word[i] for i in code[a:b].tolist()]) for a, b in zip(begin[run].tolist(), (begin[run] + run_windows[run] + window - 1).tolist(), strict=True)]
        none = np.zeros(len(run), dtype=np.int64)
        r = run_region[run]
        yield _sent(run_seed[run], none + _PASSAGE, run_seed[run], none, ids[r], check[r], first[r] + run_at[run], none, passages)
        run = np.flatnonzero(new & (run_split > 1))
        of = np.repeat(run, run_windows[run])
        place = np.repeat(begin[run] - np.cumsum(run_windows[run]) + run_windows[run], run_windows[run]) + np.arange(len(of))
        of, place = of[lead[place]], place[lead[place]]
        mark = mixed(runs_hash(hashes ^ np.uint64(WINDOW_BASE), place, place + window, WINDOW_BASE))
        part = 1 + (mark % run_split[of].astype(np.uint64)).astype(np.int64)
        r = run_region[of]
        yield _sent(run_seed[of], part, mixed(run_seed[of] + part.astype(np.uint64)), mark, ids[r], check[r], first[r] + place - edge[r], np.full(len(of), window))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = [], 0
        for batch in batches:
            ids, check, copies = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("id", "check", "copies"))
            hits = batch.column("hits")
            for w in words(batch.column("text"), SLICE_BYTES):
                p = Parse(w, window, seed)
                if not len(p.owner):
                    continue
                split = np.zeros(len(w) + 1, dtype=np.int64)  # by an anchor's first word
                own = hits.slice(w.lo, w.hi - w.lo)
                for i in np.flatnonzero(np.asarray(own.is_valid())).tolist():
                    marks = own[i].values
                    split[w.of[i] + marks.field("place").to_numpy()] = marks.field("split").to_numpy()
                live = split[p.owner] > 0
                at, row, owner = p.starts[live], p.row[live], p.owner[live]
                if not len(owner):
                    continue
                # a region is a row's words under consecutive windows whose anchors stand elsewhere too
                opens = np.append(True, (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1))
                turns = opens | np.append(True, owner[1:] != owner[:-1])
                region, runs = np.flatnonzero(opens), np.flatnonzero(turns)
                windows = np.diff(np.append(region, len(at)))
                begin, n = at[region], windows + window - 1
                word = np.repeat(begin - np.cumsum(n) + n, n) + np.arange(n.sum())
                r = row[region] + w.lo
                of = (np.cumsum(opens) - 1)[runs]
                block.append((w.taken(word), w.hash[word], n, ids[r], check[r], copies[r] == 1, begin - w.of[row[region]], of, at[runs] - begin[of], np.diff(np.append(runs, len(at))), p.seed[owner[runs]], split[owner[runs]]))
                held += len(word)
                if held >= BLOCK_WORDS:
                    yield from settle(block)
                    held = 0
        yield from settle(block)

    return run, "route long, seed long, part long, mark long, id long, check long, first long, size long, words binary"


def _pieces(tables: Iterator[pa.Table]) -> Iterator[pa.Table]:
    """The tables cut between groups, so that a piece's passages have PASSAGE_BYTES or stand under one anchor."""
    for table in tables:
        edge = np.append(starts(table, ["seed", "part"]), len(table))
        upto = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(table.column("words")), 0).to_numpy(), dtype=np.int64)])
        for lo, hi in slices(np.diff(upto[edge]), PASSAGE_BYTES):
            yield table.slice(edge[lo], edge[hi] - edge[lo]).combine_chunks()


def _parse_shared(window: int):
    """Rows sorted by anchor -> factors (id, check, first, size): passages are parsed against the block of those that share
    their anchors; of a lengthened anchor every place is a factor if there are several."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _pieces(groups(batches, ["seed", "part"], 20_000)):
            part, mark, seed, id, check, first, size = (table.column(c).to_numpy() for c in ("part", "mark", "seed", "id", "check", "first", "size"))
            keep = part == _FACTOR
            single = np.flatnonzero(part > 0)
            code = _pairs(pd.factorize(seed[single])[0], pd.factorize(mark[single])[0])
            keep[single[_often(code)]] = True
            found = [(id[keep], check[keep], first[keep], size[keep])]
            at = np.flatnonzero(part == _PASSAGE)
            if len(at):
                lists = pc.ascii_split_whitespace(table.column("words").combine_chunks().take(pa.array(at)).cast(pa.large_string()))
                word = lists.flatten().dictionary_encode().indices.to_numpy(zero_copy_only=False)
                passage, place, n = Block(word, np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]), window).factors()
                found.append((id[at][passage], check[at][passage], first[at][passage] + place, n))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found, strict=True)], ["id", "check", "first", "size"])

    return run, "id long, check long, first long, size long"


def _cut(window: int, with_text: bool):
    """Pass over (id, check, copies, text, marks): words and removed words; digest of what is kept, or the kept text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks, copies, out = batch.column("marks"), batch.column("copies").to_numpy(), []
            for i, text in enumerate(batch.column("text")):
                own = text.as_py().encode().split()
                n, gone = len(own), 0
                if copies[i] > 1 and n >= window:
                    own, gone = [], n
                elif marks[i].is_valid:
                    first, size = (marks[i].values.field(k).to_numpy() for k in ("first", "size"))
                    edge = np.zeros(n + 1, dtype=np.int64)
                    np.add.at(edge, first, 1)
                    np.add.at(edge, first + size, -1)
                    keep = np.cumsum(edge[:-1]) == 0
                    gone = n - int(keep.sum())
                    own = [own[k] for k in np.flatnonzero(keep).tolist()]
                kept = b" ".join(own)
                out.append((n, gone, kept.decode() if with_text else hashlib.sha256(kept).hexdigest()))
            n, gone, kept = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("check"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], ["id", "check", "n_words", "n_removed", "kept"])

    return run, "id long, check long, n_words long, n_removed long, kept string"


def repeated_windows(docs: DataFrame, text: str = "text", id: str = "doc_id", window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """One row per row of docs: id, n_words, n_removed, and kept_sha256 or (with_text) kept_text: the words outside every
    window of `window` words that also starts anywhere else, joined by one space.

    Null and empty texts, and texts shorter than a window, lose nothing. Null ids and repeated rows are kept: their texts
    are copies of each other. Extra columns are ignored; an empty table gives no rows.
    """
    seed = min(window, max(SEED, window - MOST_RUN + 1))
    rows = docs.select(F.col(id).alias("doc"), text_or_empty(text).alias("text")).withColumns({"id": F.xxhash64("text"), "check": F.xxhash64(F.lit(1), F.col("text"))})
    hits = materialize(index(rows.select("id", "check", "text"), window, seed))
    # both passes over texts read the same columns, so that Spark moves the texts once
    texts = rows.groupBy("id", "check").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    parsed = texts.join(hits, ["id", "check"], "left").select("id", "check", "copies", "text", "hits")
    met = parsed.mapInArrow(*_parse_own(window, seed)).repartition("route").sortWithinPartitions("seed", "part")
    marks = met.mapInArrow(*_parse_shared(window)).groupBy("id", "check").agg(F.collect_list(F.struct("first", "size")).alias("marks"))
    cut = texts.join(marks, ["id", "check"], "left").select("id", "check", "copies", "text", "marks").mapInArrow(*_cut(window, with_text))
    kept = "kept_text" if with_text else "kept_sha256"
    return rows.select("doc", "id", "check").join(cut, ["id", "check"]).select(F.col("doc").alias(id), "n_words", "n_removed", F.col("kept").alias(kept))
