"""Hard-negative mining with bit-sliced integer products (operator 11).

Components are whole numbers. A candidate's components are taken apart into bit planes (two's complement), and the product with
an anchor is summed plane by plane, most significant first. With the planes above bit k summed, each component still
lacks between 0 and 2^k - 1, so the score lies between the sum so far less (2^k - 1) times the anchor's negative part and
that plus (2^k - 1) times its positive part. Each plane halves the interval; a pair is dropped once its interval misses every
range of scores that the anchor still accepts. Survivors of the last plane have their exact score.

An anchor first gets its positives, the best rows of its own label: ranges are open above, and start at its k-th best score so
far. Then rows of other labels are tried against one range for each positive. Anchors and rows meet in tiles, an anchor
block by a row block; a task streams a tile's rows past its anchors, so that row blocks may be long.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tesserae.llm.common import materialize, small
from tesserae.llm.topk import quantized

#: Anchors that a task holds, and rows that it streams past them; a group has LEAST_BLOCKS row blocks, as far as LEAST_ROWS go.
ANCHORS, BLOCK_ROWS, LEAST_BLOCKS, LEAST_ROWS = 50_000, 1_000_000, 64, 500
#: Anchors and rows of one matrix of sums.
SIDE, CHUNK = 512, 2_048
#: A share of pairs under which they are summed one by one, not as a matrix.
SPARSE = 0.1
#: Found pairs that wait before the best ones are chosen and ranges narrow.
WAITING = 100_000
LONG = (1 << 63) - 1


def _whole(v: np.ndarray) -> np.ndarray:
    """Whole numbers, as int64 where all products of `v` with itself and their sums stay exact in a double, else as Python's."""
    most = float(np.abs(v).max(initial=0))
    return v.astype(np.int64) if most * most * max(1, v.shape[1]) < 2.0**52 else np.array([[int(c) for c in row] for row in v.tolist()], dtype=object).reshape(v.shape)


def planes(x: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(weight, bit, plane of zeros and ones) of whole numbers, the sign's first; the sum of weight * plane is x."""
    top = max((int(abs(c)).bit_length() for c in (x.min(initial=0), x.max(initial=0))), default=0)
    yield -(1 << top), top, x < 0
    for bit in range(top - 1, -1, -1):
        yield 1 << bit, bit, ((x >> bit) & 1).astype(bool)


def survivors(q: np.ndarray, x: np.ndarray, alive: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """(anchor, row, score, pairs dropped by each plane) of the pairs in `alive` whose score is between low and high, which are
    given by anchor."""
    if q.dtype != x.dtype:
        q, x = q.astype(object), x.astype(object)
    big = q.dtype == object
    # zeros and ones times an anchor stay exact in single precision while their sums are under 2^24
    kind = object if big else np.float32 if np.abs(q).sum(axis=1).max(initial=0) < 1 << 24 else np.float64
    up, down = np.maximum(q, 0).sum(axis=1), np.minimum(q, 0).sum(axis=1)
    q_fast, total, dropped = q.astype(kind), np.zeros((len(q), len(x)), dtype=object if big else np.int64), []
    i = j = None
    left = int(alive.sum())
    for weight, bit, plane in planes(x):
        if not left:
            break
        rest = (1 << bit) - 1
        if i is None:
            total += weight * (q_fast @ plane.T.astype(kind)).astype(total.dtype)
            alive &= (total + (rest * up)[:, None] >= low[:, None]) & (total + (rest * down)[:, None] <= high[:, None])
            n = int(alive.sum())
            if n < SPARSE * alive.size:
                i, j = np.nonzero(alive)
                total = total[i, j]
        else:
            total += weight * (q[i] * plane[j]).sum(axis=1)
            fine = ((total + rest * up[i] >= low[i]) & (total + rest * down[i] <= high[i])).astype(bool)
            i, j, total, n = i[fine], j[fine], total[fine], int(fine.sum())
        dropped.append(left - n)
        left = n
    if i is None:
        i, j = np.nonzero(alive)
        total = total[i, j]
    held = np.array([max(-LONG - 1, min(LONG, s)) for s in total.tolist()], dtype=np.int64) if big else total
    return i, j, held, dropped


class Best:
    """The k best (score falling, id rising) of each slot, equal entries once; slots are numbers from 0."""

    def __init__(self, slots: int, k: int):
        self.k, self.floor = k, np.full(slots, -LONG - 1, dtype=np.int64)
        self.kept = [np.zeros(0, dtype=np.int64)] * 3
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.count = 0

    def add(self, slot: np.ndarray, id: np.ndarray, score: np.ndarray) -> None:
        self.waiting.append((slot, id, score))
        self.count += len(slot)
        if self.count > max(WAITING, len(self.kept[0])) or not len(self.kept[0]):
            self.settle()

    def settle(self) -> list[np.ndarray]:
        slot, id, score = (np.concatenate([a, *b]) for a, b in zip(self.kept, zip(*self.waiting, strict=True), strict=True)) if self.waiting else self.kept
        order = np.lexsort((id, ~score, slot))  # falling scores; a negative of the least long would overflow
        slot, id, score = slot[order], id[order], score[order]
        new = np.append(True, (slot[1:] != slot[:-1]) | (id[1:] != id[:-1]) | (score[1:] != score[:-1]))[: len(slot)]
        slot, id, score = slot[new], id[new], score[new]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot)
        fine = place < self.k
        self.kept, self.waiting, self.count = [slot[fine], id[fine], score[fine]], [], 0
        full = place == self.k - 1
        self.floor[slot[full]] = score[full]
        return self.kept


class Tile:
    """Anchors with their accepted ranges of scores; rows stream past."""

    def __init__(self, anchor: dict[str, np.ndarray], same: bool, k: int, low: np.ndarray, high: np.ndarray):
        """low, high: anchors x ranges; a range that is not used has low above high."""
        self.a, self.same, self.k, self.low, self.high = anchor, same, k, low, high
        self.best = Best(low.size, k)
        self.dropped: list[int] = []

    def pass_by(self, id: np.ndarray, label: np.ndarray, v: np.ndarray) -> None:
        ranges = self.low.shape[1]
        for lo in range(0, len(id), CHUNK):
            x_id, x_label, x = id[lo : lo + CHUNK], label[lo : lo + CHUNK], v[lo : lo + CHUNK]
            for at in range(0, len(self.a["id"]), SIDE):
                own = slice(at, at + SIDE)
                floor = np.maximum(self.low[own], self.best.floor.reshape(self.low.shape)[own])
                used = floor <= self.high[own]
                least, most = np.where(used, floor, LONG).min(axis=1), np.where(used, self.high[own], -LONG - 1).max(axis=1)
                alive = self.a["id"][own, None] != x_id[None, :]
                alive &= (self.a["label"][own, None] == x_label[None, :]) == self.same
                wide = [np.array([(float("inf") if abs(n) >= LONG else 1) * n for n in side.tolist()], dtype=object) for side in (least, most)] if self.a["v"].dtype == object or x.dtype == object else (least, most)
                i, j, score, dropped = survivors(self.a["v"][own], x, alive, *wide)
                self.dropped = [a + b for a, b in zip(self.dropped + [0] * len(dropped), dropped + [0] * len(self.dropped), strict=True)]
                if not len(i):
                    continue
                fine = (score[:, None] >= floor[i]) & (score[:, None] <= self.high[own][i])
                n, r = np.nonzero(fine)
                self.best.add((at + i[n]) * ranges + r, x_id[j[n]], score[n])

    def results(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(anchor position, range, id, score)."""
        slot, id, score = self.best.settle()
        return slot // self.low.shape[1], slot % self.low.shape[1], id, score


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return _whole(flat.reshape(len(column), -1))


TILE = "tile string, role int, row long, id long, label int, ranges array<long>"


def _met(rows: DataFrame, anchors: DataFrame, keys: list[str], anchor_block: int, block_rows: int) -> DataFrame:
    """Rows and anchors of equal keys, each in all the tiles of its block: TILE and v, sorted by tile and role (anchors first)."""
    blocks = lambda n, most, of: F.ceil(F.col(n) / F.least(F.lit(most), of)).cast("int")
    per_block = F.greatest(F.lit(LEAST_ROWS), F.ceil(F.col("n") / LEAST_BLOCKS))
    sizes = anchors.groupBy(*keys).agg(F.count("*").alias("a")).join(rows.groupBy(*keys).agg(F.count("*").alias("n")), keys)
    sizes = small(materialize(sizes.select(*keys, blocks("a", anchor_block, F.lit(anchor_block)).alias("down"), blocks("n", block_rows, per_block).alias("across"))))
    block = lambda n: F.pmod(F.xxhash64("row"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    x = rows.join(sizes, keys).withColumns({"x": block("across"), "q": every("down")}).withColumns({"role": F.lit(1), "ranges": F.lit(None).cast("array<long>")})
    q = anchors.join(sizes, keys).withColumns({"q": block("down"), "x": every("across")}).withColumn("role", F.lit(0))
    columns = [F.concat_ws("/", *keys, "q", "x").alias("tile"), "role", "row", "id", "label", "ranges", "v"]
    return x.select(*columns).unionByName(q.select(*columns)).repartition("tile").sortWithinPartitions("tile", "role")


def _search(met: DataFrame, same: bool, k: int, bounds: Callable[[list], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """row (of the anchor), slot (number of its range), id, score: the k best rows of each range within each tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        tile: Tile | None = None
        name, rows = None, np.zeros(0, dtype=np.int64)

        def result() -> Iterator[pa.RecordBatch]:
            if tile:
                at, slot, id, score = tile.results()
                yield pa.RecordBatch.from_arrays([pa.array(rows[at]), pa.array(slot.astype(np.int32)), pa.array(id), pa.array(score)], ["row", "slot", "id", "score"])

        for batch in batches:
            names = batch.column("tile").to_numpy(zero_copy_only=False)
            role = batch.column("role").to_numpy()
            edges = np.flatnonzero(np.append(True, (names[1:] != names[:-1]) | (role[1:] != role[:-1])))
            for lo, hi in zip(edges.tolist(), [*edges[1:].tolist(), len(names)], strict=True):
                part = batch.slice(lo, hi - lo)
                if names[lo] != name:
                    yield from result()
                    name, held, tile = names[lo], [], None
                if role[lo] == 0:
                    held.append(part)
                    continue
                if not held:
                    continue
                if tile is None:
                    whole = pa.Table.from_batches(held).combine_chunks()
                    rows = whole.column("row").to_numpy()
                    anchor = {"id": whole.column("id").to_numpy(), "label": whole.column("label").to_numpy(), "v": _matrix(whole.column("v").combine_chunks())}
                    tile = Tile(anchor, same, k, *bounds(whole.column("ranges").to_pylist()))
                tile.pass_by(part.column("id").to_numpy(), part.column("label").to_numpy(), _matrix(part.column("v")))
        yield from result()

    return met.mapInArrow(run, "row long, slot int, id long, score long")


def open_range(ranges: list) -> tuple[np.ndarray, np.ndarray]:
    return np.full((len(ranges), 1), -LONG - 1, dtype=np.int64), np.full((len(ranges), 1), LONG, dtype=np.int64)


def shares(least: int, most: int) -> Callable[[list], tuple[np.ndarray, np.ndarray]]:
    """Ranges of whole scores from least to most hundredths of each positive's score; what exceeds a long is its end."""

    def bounds(ranges: list) -> tuple[np.ndarray, np.ndarray]:
        width = max((len(r or []) for r in ranges), default=0)
        low, high = np.full((len(ranges), max(1, width)), LONG, dtype=np.int64), np.full((len(ranges), max(1, width)), -LONG - 1, dtype=np.int64)
        for n, scores in enumerate(ranges):
            for r, p in enumerate(scores or []):
                low[n, r], high[n, r] = min(LONG, max(-LONG - 1, -(-least * p // 100))), min(LONG, max(-LONG - 1, most * p // 100))
        return low, high

    return bounds


def mine(
    vectors: DataFrame, anchors: Column, label: Column, vector: str = "embedding", id: str = "vec_id", scale: float = 256.0, positives: int = 5, negatives: int = 5, least: int = 80, most: int = 100, anchor_block: int = ANCHORS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score: for each row that meets `anchors`, its
    first rows of the same label by (score falling, id rising), and for each of these the first rows of another label whose
    score is between `least` and `most` hundredths of the positive's.

    Rows with a null id or label, and vectors that are null, empty or hold a null or non-finite component, take no part;
    vectors of different lengths are not compared. Rows of the anchor's own id are not its partners. Of rows that are repeated
    exactly one counts; rows of one id that differ are rows of their own. A positive score under zero accepts nothing. Scores
    are exact at any size; one beyond the range of a long counts as the end of that range. An anchor with fewer partners
    gives fewer rows, an empty table none. Other columns are ignored.
    """
    rows = vectors.select(F.col(id).cast("long").alias("id"), label.cast("int").alias("label"), quantized(vector, scale).alias("v"), F.coalesce(anchors, F.lit(False)).alias("is_anchor")).where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    rows = materialize(rows.withColumns({"dims": F.size("v"), "row": F.monotonically_increasing_id()}))
    reach = rows.agg(F.max(F.array_max(F.transform("v", F.abs)))).first()[0] or 0.0
    packed = F.col("v").cast("array<smallint>" if reach < 1 << 15 else "array<int>" if reach < 1 << 31 else "array<double>").alias("v")  # less to ship
    slim = rows.select("row", "id", "label", "dims", packed)
    asked = materialize(rows.where("is_anchor").groupBy("id", "label", "v", "dims").agg(F.min("row").alias("row")).select("row", "id", "label", "dims", packed))
    by_score = W.partitionBy("row", "slot").orderBy(F.desc("score"), "id")
    first = lambda found, k: found.distinct().withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    none = F.lit(None).cast("array<long>")
    alike = first(_search(_met(slim, asked.withColumn("ranges", none), ["dims", "label"], anchor_block, block_rows), True, positives, open_range), positives)
    listed = alike.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("positives"))  # `positives` entries at most
    known = materialize(asked.join(listed, "row"))
    ranged = known.withColumn("ranges", F.transform("positives", lambda p: p["score"])).drop("positives")
    other = first(_search(_met(slim, ranged, ["dims"], anchor_block, block_rows), False, negatives, shares(least, most)), negatives)
    positive = F.get("positives", F.col("slot"))
    joined = other.withColumnRenamed("id", "negative_id").join(known.select("row", F.col("id").alias("anchor_id"), "positives"), "row")
    return joined.select("anchor_id", positive["id"].alias("positive_id"), "rank", "negative_id", positive["score"].alias("positive_score"), F.col("score").alias("negative_score"))
