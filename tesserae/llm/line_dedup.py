"""Line dedup by segment-partition edit join (operator 7).

Distinct lines are cut into max_edits + 1 segments: of two lines within max_edits edits, one segment of the shorter stands
unchanged in the longer, at a place that its length and number bound. A line is filed under its own segments and probes
the admitted substrings for every admitted length, both as 64-bit keys. Keys that two lines share make buckets; only lines
of such buckets are read again, and pairs are verified with a banded bit-parallel edit distance (code points).

Lines of max_edits characters or fewer have no such segments. Any two of them are linked, so they are counted, not
compared. A longer line within max_edits of one holds at least one of its characters: a short line is filed under
each character and its number, longer lines probe their characters, and a pair counts under the first one that is found.

A block settles keys that repeat inside it and sends each key on once, so a segment of very many lines fills no task; large
buckets are compared chunk by chunk. A pair counts under the first segment that finds it. Tasks emit one row per line
(its links there, and an edge to a line that it links to, directly or not), never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import materialize, small, text_or_empty
from tesserae.llm.components import components
from tesserae.llm.simhash import groups, roots, starts
from tesserae.llm.words import mixed, parts_hash, sums

MAX_EDITS = 2
#: Shorter lines link to equal lines only; none is shorter than 1.
LEAST_CHARS = 1
TILE = 500
BASE = 0x9FB21C651E98DF25
BLOCK_LINES = 200_000
SLICE_CHARS = 1_000_000


def segment(length: np.ndarray | int, i: int, edits: int) -> tuple:
    """(start, size) of segment i of a line; the last ones are longer by one where the length does not divide."""
    base, extra = length // (edits + 1), length % (edits + 1)
    long = edits + 1 - extra
    return i * base + np.maximum(0, i - long), base + (i >= long)


def probes(length: np.ndarray, edits: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(shorter by, segment, lines, place, size, whether it is the line's own segment) of all substrings that a line is
    filed under or probes. Lines of up to `edits` characters have their characters for segments."""
    for n in range(1, edits + 1):
        at = np.flatnonzero(length == n)
        for i in range(n if len(at) else 0):
            yield 0, i, at, np.full(len(at), i), np.ones(len(at), dtype=np.int64), np.ones(len(at), dtype=bool)
        for long in range(edits + 1, n + edits + 1):
            at = np.flatnonzero(length == long)
            for i in range(n if len(at) else 0):
                for place in range(long):
                    yield long - n, i, at, np.full(len(at), place), np.ones(len(at), dtype=np.int64), np.zeros(len(at), dtype=bool)
    for less in range(edits + 1):
        for i in range(edits + 1):
            p, size = segment(length - less, i, edits)
            lo = np.maximum(0, np.maximum(p - i, p + less - (edits - i)))
            hi = np.minimum(length - size, np.minimum(p + i, p + less + (edits - i)))
            for shift in range(-edits, 2 * edits + 1):
                at = np.flatnonzero((p + shift >= lo) & (p + shift <= hi) & (size > 0))
                if len(at):
                    yield less, i, at, (p + shift)[at], size[at], np.full(len(at), less == 0 and shift == 0)


def edit_distance(a: str, b: str, most: int) -> int:
    """Edit distance of a and b, or most + 1 if it is larger: Hyyro's diagonal band of 2 * most + 1 bits, moved down the
    matrix one column at a time, after common ends are cut."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > most:
        return most + 1
    start, n = 0, len(a)
    step = n
    while step:  # longest common prefix by halving
        while start + step <= n and a[start : start + step] == b[start : start + step]:
            start += step
        step //= 2
    a, b = a[start:], b[start:]
    end, n = 0, len(a)
    step = n
    while step:
        while end + step <= n and a[n - end - step : n - end] == b[len(b) - end - step : len(b) - end]:
            end += step
        step //= 2
    a, b = a[: n - end], b[: len(b) - end]
    if not a:
        return len(b)
    m, width = len(a), 2 * most + 1
    if m <= most:
        return _small_distance(a, b, most)
    full, top = (1 << width) - 1, 1 << (width - 1)
    # bit k stands for row j - most + k of column j; what lies above row 1 stays clear
    vp, vn, score = full ^ ((1 << most) - 1), 0, most
    for j, c in enumerate(b, 1):
        eq = 0
        for row in range(max(1, j - most), min(m, j + most) + 1):
            if a[row - 1] == c:
                eq |= 1 << (row - j + most)
        d = (((eq & vp) + vp) ^ vp | eq | vn) & full
        hp, hn = (vn | ~(d | vp)) & full, d & vp
        if j + most <= m:  # the band's lowest row
            score += not d & top
        else:  # row m
            bit = 1 << (m - j + most)
            score += bool(hp & bit) - bool(hn & bit)
        if score > 2 * most + 1:
            return most + 1
        vp, vn = (hn | ~(d >> 1 | hp)) & full, d >> 1 & hp
    return min(score, most + 1)


def _small_distance(a: str, b: str, most: int) -> int:
    row = list(range(len(a) + 1))
    for j, c in enumerate(b, 1):
        left, row = row, [j]
        for i, x in enumerate(a, 1):
            row.append(min(left[i] + 1, row[-1] + 1, left[i - 1] + (x != c)))
    return min(row[-1], most + 1)


def first_segment(short: str, long: str, edits: int) -> int:
    """Number of the first segment of `short` that stands in `long` at an admitted place; edits + 1 if none does. Of up to
    `edits` characters: of the first one that `long` holds."""
    if len(short) <= edits:
        return next((i for i, c in enumerate(short) if c in long), edits + 1)
    less = len(long) - len(short)
    for i in range(edits + 1):
        p, size = (int(x) for x in segment(len(short), i, edits))
        lo, hi = max(0, p - i, p + less - (edits - i)), min(len(long) - size, p + i, p + less + (edits - i))
        own = short[p : p + size]
        if any(long[k : k + size] == own for k in range(lo, hi + 1)):
            return i
    return edits + 1


def line_hash(line: str) -> Column:
    return F.xxhash64(line)


def lines(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """(id, twin, no, line, lid, check): the non-empty lines of each row of (id, text); twin tells texts of one id apart, lid
    and check are two 64-bit hashes of the line."""
    rows = docs.select(F.col(id).alias("id"), F.xxhash64(F.col(text)).alias("twin"), text_or_empty(text).alias("text"))
    flat = rows.select("id", "twin", F.posexplode(F.split("text", "\n")).alias("no", "line"))
    return flat.where("line <> ''").withColumns({"lid": line_hash("line"), "check": F.xxhash64(F.lit(1), F.col("line"))})


def told_apart(hashed: DataFrame, *more: DataFrame) -> list[DataFrame]:
    """Tables with (lid, check), all of the lines of the first -> the same without check: lines that share lid but differ in
    check have check for lid."""
    met = materialize(hashed.groupBy("lid").agg(F.min("check").alias("least"), F.max("check").alias("most")).where("least <> most").select(F.col("lid").alias("met")))
    if met.isEmpty():
        return [x.drop("check") for x in (hashed, *more)]
    lid = F.when(F.col("met").isNull(), F.col("lid")).otherwise(F.col("check"))
    return [x.join(small(met), F.col("lid") == F.col("met"), "left").withColumn("lid", lid).drop("met", "check") for x in (hashed, *more)]


def _keys(edits: int):
    """Distinct lines -> (key, lid, meta): substrings under which they are filed or probe. meta packs the length of the
    filed line, the segment, and whether the row files, is sure, or has a sure copy."""

    def settle(block: list[tuple]) -> Iterator[pa.RecordBatch]:
        if not block:
            return
        key, lid, seg, size, own = (np.concatenate(x) for x in zip(*block, strict=True))
        order = np.argsort(key)
        same = np.diff(key[order]) == 0
        at = np.flatnonzero(np.append(False, same) | np.append(same, False))  # few keys repeat: only those are sorted further
        some = order[at]
        order[at] = some[np.lexsort((~own[some], lid[some], key[some]))]
        key, lid, seg, size, own = (x[order] for x in (key, lid, seg, size, own))
        new = np.append(True, (key[1:] != key[:-1]) | (lid[1:] != lid[:-1]))
        key, lid, seg, size, own = (x[new] for x in (key, lid, seg, size, own))
        lead = np.append(True, key[1:] != key[:-1])
        group = np.cumsum(lead) - 1
        many = np.bincount(group)[group] > 1
        # one row of a key asks under the key; where a block knows it to be shared, all its rows are sure already
        meta = size.astype(np.int64) << 16 | seg.astype(np.int64) << 4 | own << 2
        for take, flags in ((lead, many.astype(np.int64)), (many, 2)):
            yield pa.RecordBatch.from_arrays([pa.array(key[take]), pa.array(lid[take]), pa.array((meta | flags)[take])], ["key", "lid", "meta"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = [], 0
        for batch in batches:
            texts = batch.column("line").to_pylist()
            ids = batch.column("lid").to_numpy()
            lo = 0
            while lo < len(texts):
                hi, size = lo, 0
                while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= SLICE_CHARS):
                    size += len(texts[hi])
                    hi += 1
                length = np.array([len(x) for x in texts[lo:hi]], dtype=np.int64)
                total = sums(np.frombuffer("".join(texts[lo:hi]).encode("utf-32-le"), dtype=np.uint32), BASE)
                begin = np.cumsum(length) - length
                for less, i, at, place, n, own in probes(length, edits):
                    first = begin[at] + place
                    mark = ((length[at] - less) * (edits + 1) + i).astype(np.uint64)
                    key = mixed(parts_hash(total, first, first + n, BASE) ^ mixed(mark)).view(np.int64)
                    block.append((key, ids[lo:hi][at], np.full(len(at), i, dtype=np.int32), (length[at] - less).astype(np.int32), own))
                held += hi - lo
                if held >= BLOCK_LINES:
                    yield from settle(block)
                    block, held = [], 0
                lo = hi
        yield from settle(block)

    return run, "key long, lid long, meta long"


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key -> those of keys with several lines."""
    for table in groups(batches, ["key"]):
        first = starts(table, ["key"])
        size = np.diff(np.append(first, len(table)))
        group = np.repeat(np.arange(len(first)), size)
        meta = table.column("meta").to_numpy()
        sure, twice = (meta & 2) > 0, (meta & 1) > 0
        asking = np.bincount(group, ~sure, len(first))
        keep = sure | ((asking[group] > 1) & ~twice)  # what its block has sent as sure too would be there twice
        if keep.any():
            meta = meta[keep]
            own = [table.column(c).to_numpy()[keep] for c in ("key", "lid")]
            yield pa.RecordBatch.from_arrays([*map(pa.array, own), pa.array((meta >> 4 & 0xFFF).astype(np.int32)), pa.array((meta >> 16).astype(np.int32)), pa.array((meta & 4) > 0)], ["key", "lid", "seg", "len", "own"])


def _verified(edits: int):
    """Tiles of (key, tile, chunk, across, lid, own, seg, len, line) -> (lid, other, links)."""
    keys = ["key", "tile"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, keys, 4_000):
            first = starts(table, keys)
            lid, own, chunk, across, seg = (table.column(c).to_numpy() for c in ("lid", "own", "chunk", "across", "seg"))
            text = table.column("line").to_pylist()
            length = np.array([len(x) for x in text])
            letters = np.stack([np.bincount(np.frombuffer(x.encode("utf-32-le"), dtype=np.uint32) & 15, minlength=16) for x in text]).astype(np.int32)
            for a, b in zip(first.tolist(), np.append(first[1:], len(table)).tolist(), strict=True):
                if not own[a:b].any() or b - a < 2:
                    continue
                cross = across[a]
                left, right = [], []
                for x in (a + np.flatnonzero(own[a:b])).tolist():
                    near = np.abs(letters[a:b] - letters[x]).sum(axis=1) <= 2 * edits
                    near &= (length[a:b] > length[x]) | ((length[a:b] == length[x]) & (lid[a:b] > lid[x]))
                    near &= (length[a:b] - length[x] <= edits) & ((chunk[a:b] != chunk[x]) if cross else True)
                    near &= length[a:b] > edits  # short ones among themselves are counted elsewhere
                    for y in (a + np.flatnonzero(near)).tolist():
                        if first_segment(text[x], text[y], edits) == seg[x] and edit_distance(text[x], text[y], edits) <= edits:
                            left.append(x - a)
                            right.append(y - a)
                if left:
                    i, j = np.array(left), np.array(right)
                    links = np.bincount(i, minlength=b - a) + np.bincount(j, minlength=b - a)
                    root = lid[a + roots(b - a, i, j)]
                    at = np.flatnonzero(links)
                    yield pa.RecordBatch.from_arrays([pa.array(lid[a + at]), pa.array(root[at]), pa.array(links[at].astype(np.int64))], ["lid", "other", "links"])

    return run, "lid long, other long, links long"


def joined(distinct: DataFrame, edits: int = MAX_EDITS, least: int = LEAST_CHARS, tile: int = TILE) -> DataFrame:
    """distinct (lid, line) -> (lid, other, links): per tile a line's number of links and a line of its component."""
    long = distinct.where(F.length("line") >= least).select("lid", "line")
    # sure rows go anywhere, the others to their key
    route = F.when(F.col("meta").bitwiseAND(F.lit(2)) > 0, F.xxhash64("key", "lid")).otherwise(F.col("key"))
    rows = long.mapInArrow(*_keys(edits)).repartition(route).sortWithinPartitions("key")
    # one plan from lines to links, so that Spark moves the lines once; what the keys share is dealt out (evenly, by line),
    # so that both uses below read it and the keys are sorted once; joined on seg and len too, so that both sides of the
    # join are dealt out for it and a key of very many lines can be split
    members = rows.mapInArrow(_shared, "key long not null, lid long not null, seg int not null, len int not null, own boolean not null").repartition("key", "lid")
    sizes = members.groupBy("key").agg(F.count("*").alias("n"), F.max("own").alias("filed"), F.max("seg").alias("seg"), F.max("len").alias("len"))
    sizes = sizes.where("n > 1 AND filed").select("key", "seg", "len", F.ceil(F.col("n") / tile).alias("chunks"))
    dealt = members.join(sizes, ["key", "seg", "len"]).withColumn("chunk", F.pmod(F.xxhash64("lid"), F.col("chunks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    dealt = dealt.withColumn("tile", F.least("chunk", "other") * F.col("chunks") + F.greatest("chunk", "other"))
    dealt = dealt.select("key", "tile", "chunk", (F.col("chunk") != F.col("other")).alias("across"), "lid", "seg", "own").join(long, "lid")
    return dealt.repartition("key", "tile").sortWithinPartitions("key", "tile").mapInArrow(*_verified(edits))


def short(occurrences: DataFrame, edits: int, least: int) -> DataFrame:
    """occurrences (lid, size) -> (lid, other, links) of the lines of least to `edits` characters: all are linked."""
    some = materialize(occurrences.where(F.col("size").between(max(1, least), edits)).select("lid").distinct())
    n, first = some.agg(F.count("*"), F.min("lid")).first()
    return some.where(F.lit(n > 1)).select("lid", F.lit(first).cast("long").alias("other"), F.lit(n - 1).cast("long").alias("links"))


def classes(occurrences: DataFrame, edits: int = MAX_EDITS, least: int = LEAST_CHARS, tile: int = TILE, sizes: DataFrame | None = None) -> DataFrame:
    """(lid, class, links) of the lines that have links to different lines. sizes: (lid, size) of the lines, if they are at
    hand; only whether a size is over `edits` matters."""
    distinct = occurrences.groupBy("lid").agg(F.first("line").alias("line"))
    few = short(occurrences.withColumn("size", F.length("line")) if sizes is None else sizes, edits, least)
    found = materialize(joined(distinct, edits, least, tile).unionByName(few))
    links = found.groupBy("lid").agg(F.sum("links").alias("links"))
    return links.join(components(found.select("lid", "other")).toDF("lid", "class"), "lid")


def deduped(docs: DataFrame, text: str = "text", id: str = "doc_id", edits: int = MAX_EDITS, least: int = LEAST_CHARS, tile: int = TILE) -> DataFrame:
    """One row per row of docs: id, n_lines (non-empty ones), n_removed, lines: of each line that has copies or links, its
    number in the text (from 0), the document and line that stay of its class, and its links to different lines.

    Of a class the occurrence with the smallest (id, line number) stays, a null id last. Empty lines are left alone, lines
    of under `least` characters link to equal lines only (by default there are none). Null and empty texts have no lines. Repeated rows of one id and
    text share a result. Two different lines are taken as equal only if two XXH64 of theirs are. Extra columns are ignored; an
    empty table gives no rows.
    """
    found = lines(docs, text, id)
    placed = materialize(found.select("id", "twin", "no", "lid", "check", F.least(F.length("line"), F.lit(edits + 1)).alias("size")).distinct())
    placed, found = told_apart(placed, found)
    linked = materialize(classes(found, edits, least, tile, placed))
    known = placed.join(linked, "lid", "left").withColumns({"class": F.coalesce("class", "lid"), "links": F.coalesce("links", F.lit(0))})
    place = F.struct(F.col("id").isNull().alias("last"), "id", "no", "twin")
    heads = known.groupBy("class").agg(F.min(place).alias("head"), F.count("*").alias("n")).where("n > 1")
    inside = known.join(materialize(heads), "class").select("id", "twin", "no", "links", "head", (~(F.col("head").eqNullSafe(place))).alias("gone"))
    line = F.struct("no", F.col("head.id").alias("class_id"), F.col("head.no").alias("class_line"), "links")
    by_text = inside.groupBy("id", "twin").agg(F.count_if("gone").alias("n_removed"), F.array_sort(F.collect_list(line)).alias("lines"))
    count = F.size(F.array_remove(F.split(text_or_empty(text), "\n"), "")).cast("long")
    rows = docs.select(F.col(id).alias("id"), F.xxhash64(F.col(text)).alias("twin"), count.alias("n_lines"))
    joined_rows = rows.alias("d").join(by_text.alias("r"), F.col("d.id").eqNullSafe(F.col("r.id")) & (F.col("d.twin") == F.col("r.twin")), "left")
    return joined_rows.select(F.col("d.id").alias(id), "n_lines", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), "lines")

