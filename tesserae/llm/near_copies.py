"""Near copies by word shingles: SimHash of many bits, generalised pigeonhole, exact check (operator 3 as a corpus stage).

Two texts are linked when the Jaccard similarity of their sets of word shingles is `similarity` or more. With 64 bits a
pair at 0.8 differs in 10 of them, and so wide a bound leaves every text 2 % of the corpus to compare with. Here a fingerprint
has hundreds of bits: correlated bits are grouped into parts (correlations counted over all fingerprints), a dynamic
program gives each part a threshold (unprobed, 0 or 1 bit) at least estimated cost, until a pair at exactly the wanted
similarity meets in some part with probability FOUND; more similar pairs meet more surely. Bits that no part uses, the
sketch, go along with each filed row: pairs that meet are compared by it where they meet.

A task emits a spanning forest of the nearest such pairs, never all pairs. The forests' edges are checked exactly on the
shingle sets: first every text's nearest partner, then the edges between groups that this leaves apart. An edge that fails
the check can hide a link only if its two texts are nearer in the sketch than the linked ones, in every bucket where these meet.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, comb, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tesserae.llm.common import materialize, small, text_or_empty
from tesserae.llm.components import components
from tesserae.llm.simhash import ROW_COST, TILE, group_bits, groups, roots, starts, tiled

SHINGLE = 5
SIMILARITY = 0.8
SEED = 42
#: Probability with which a pair at exactly the wanted similarity meets in some part.
FOUND = 0.98
#: Words of 64 bits that only compare, and the probability with which a pair at the wanted similarity passes them.
SKETCH, PASSED = 4, 0.995
#: Ways to cut a word of 64 bits into parts: few wide parts need more of them, but fewer unlike texts meet.
CUTS = (4, 3)
#: Dynamic programming counts -log(probability to miss) in these steps.
STEP = 0.005

_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8).reshape(-1, 1), axis=1, bitorder="little").view(np.uint64).ravel()


def shingle_hashes(text: str, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct XXH64 of the word shingles (ASCII letters lower-cased, ASCII white space; fewer words: all of them)."""
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words]) - 1
    k = min(width, len(words))
    first = np.concatenate([[0], ends[:-1] + 1])[: len(words) - k + 1]
    return np.unique(np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(first.tolist(), ends[k - 1 :].tolist(), strict=True)], dtype=np.uint64))


def wide(hashes: np.ndarray, words: int) -> np.ndarray:
    """SimHash of 64 * words bits: each hash is mixed anew for every word; a bit is 1 if set in over half of them."""
    if not len(hashes):
        return np.zeros(words, dtype=np.uint64)
    salts = np.arange(1, words + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    ones = np.zeros(64 * words, dtype=np.int64)
    for i in range(0, len(hashes), 255):  # byte lanes hold counts up to 255
        x = hashes[i : i + 255, None] + salts
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        ones += _SPREAD[x.view(np.uint8)].sum(axis=0, dtype=np.uint64).view(np.uint8)
    return np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)


def disagreement(similarity: float) -> float:
    """Odds that a bit differs between two sets of one size with this Jaccard similarity."""
    return float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)


def _meets(width: int, most: int, p: float) -> float:
    return sum(comb(width, k) * p**k * (1 - p) ** (width - k) for k in range(most + 1))


def sketch_bound(similarity: float) -> int:
    """Differing bits of the sketch that a pair at this similarity keeps within with probability PASSED."""
    p, n = disagreement(similarity), 64 * SKETCH
    return next(t for t in range(n + 1) if _meets(n, t, p) >= PASSED)


def layout(n: int, similarity: float) -> tuple[int, int]:
    """(words to probe, parts of a word) for n texts: the cheaper way to cut; both meet with the same probability."""
    p, found = disagreement(similarity), []
    for cut in CUTS:
        width = 64 // cut
        parts = log(1 - FOUND) / log(1 - _meets(width, 0, p))
        found.append((n * parts * ROW_COST + n * n / 2 * parts / 2**width, ceil(parts / cut) + 1, cut))
    return min(found)[1:]


def cover(costs: list[list[float]], gains: list[list[float]], need: float) -> list[int]:
    """Thresholds T_i >= -1 of least total cost whose gains sum to `need` at least; entry t + 1 belongs to threshold t."""
    goal = ceil(need / STEP)
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost, gain in zip(costs, gains, strict=True):
        step: dict[int, tuple[float, list[int]]] = {}
        for had, (total, chosen) in best.items():
            for t, (c, g) in enumerate(zip(cost, gain, strict=True), -1):
                at = min(had + int(g / STEP), goal)
                if at not in step or total + c < step[at][0]:
                    step[at] = (total + c, [*chosen, t])
        best = step
    return best[max(best)][1]


def _words(column: pa.Array, words: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint64).reshape(-1, words)


def plan(fps: DataFrame, words: int, cut: int, similarity: float) -> list[tuple[int, list[int], int]]:
    """(word, bits, threshold) of each part that is probed. Bits are grouped within their word by correlation; how many
    unlike texts meet in a part is estimated from how often its bits are set, over all fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((words, 64, 64)), 0
        for batch in batches:
            fp = _words(batch.column(0), words + SKETCH)[:, :words]
            for k in range(words):
                bits = np.unpackbits(np.ascontiguousarray(fp[:, k]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
                both[k] += bits.T @ bits
            n += len(fp)
        counts = np.append(both.astype(np.int64).ravel(), n)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(counts))), pa.array(counts)], ["at", "n"])

    counts = np.zeros(words * 64 * 64 + 1)
    for r in fps.select("fp").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():  # 64 x 64 a word
        counts[r["at"]] = r["n"]
    n, parts, costs, gains = counts[-1], [], [], []
    for k, both in enumerate(counts[:-1].reshape(words, 64, 64) / max(n, 1)):
        p = np.diag(both)
        spread = np.sqrt(np.outer(p * (1 - p), p * (1 - p))) + 1e-9
        for part in group_bits(np.abs(both - np.outer(p, p)) / spread, cut):
            odds = np.array([1.0])
            for q in 2 * p[part] * (1 - p[part]):
                odds = np.convolve(odds, [1 - q, q])[:2]
            cost = [n * ROW_COST * rows + n * n / 2 * odds[: t + 1].sum() for t, rows in ((0, 1), (1, 2 + len(part)))]
            gain = [-log(1 - _meets(len(part), t, disagreement(similarity))) for t in (0, 1)]
            parts.append((k, part))
            costs.append([0.0, *cost])
            gains.append([0.0, *gain])
    return [(k, part, t) for (k, part), t in zip(parts, cover(costs, gains, -log(1 - FOUND)), strict=True) if t >= 0]


def _filed(fps: DataFrame, words: int, parts: list[tuple[int, list[int], int]]) -> DataFrame:
    """Rows (part, value, role, node, sketch s0, s1, ...): role 0 under the own value, role 1 under those one bit away."""
    names = ["part", "value", "role", "node", *[f"s{k}" for k in range(SKETCH)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp, node = _words(batch.column(1), words + SKETCH), batch.column(0)
            sketch = [pa.array(np.ascontiguousarray(fp[:, words + k]).view(np.int64)) for k in range(SKETCH)]
            for i, (word, part, most) in enumerate(parts):
                own = fp[:, word] & np.uint64(sum(1 << b for b in part))
                for flipped in [0, *[1 << b for b in part]][: None if most else 1]:
                    value = pa.array((own ^ np.uint64(flipped)).view(np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(fp), i, dtype=np.int32)), value, pa.array(np.full(len(fp), int(flipped > 0), dtype=np.int32)), node, *sketch], names)

    return fps.select("node", "fp").mapInArrow(run, "part int, value long, role int, node long, " + ", ".join(f"{s} long" for s in names[4:]))


def forest(n: int, i: np.ndarray, j: np.ndarray, distance: np.ndarray) -> np.ndarray:
    """Positions of a spanning forest's edges among the pairs (i, j) over n nodes, nearest first."""
    order = np.lexsort((j, i, distance))
    i, j, label, taken = i[order], j[order], np.arange(n), np.empty(0, dtype=np.int64)
    while len(open_ := np.flatnonzero(label[i] != label[j])):
        best = np.full(n, len(i))
        np.minimum.at(best, label[i[open_]], open_)
        np.minimum.at(best, label[j[open_]], open_)
        taken = np.union1d(taken, best[best < len(i)])
        label = roots(n, i[taken], j[taken])
    return order[taken]


def _met(table: pa.Table, bound: int) -> Iterator[pa.RecordBatch]:
    """Forest edges (a, b, distance) among the texts of each group whose sketches differ in `bound` bits at most."""
    first = starts(table, ["part", "value", "tile"])
    size = np.diff(np.append(first, len(table)))
    node, role = table.column("node").to_numpy(), table.column("role").to_numpy()
    sketch = np.stack([table.column(f"s{k}").to_numpy().view(np.uint64) for k in range(SKETCH)], axis=1)
    left = np.repeat(first + size, size) - np.arange(len(table)) - 1  # members that follow in the same group
    cost = np.cumsum(np.add.reduceat(left, first))
    for k in np.split(np.arange(len(first)), np.flatnonzero(np.diff(cost // 2_000_000)) + 1):
        lo, hi = first[k[0]], first[k[-1]] + size[k[-1]]
        at, d, found = np.arange(lo, hi)[role[lo:hi] == 0], 1, []
        while len(at := at[left[at] >= d]):
            apart = np.bitwise_count(sketch[at] ^ sketch[at + d]).sum(axis=1, dtype=np.int64)
            near = (apart <= bound) & (node[at] != node[at + d])
            found.append((at[near] - lo, at[near] + d - lo, apart[near]))
            d += 1
        if sum(len(x) for x, _, _ in found):
            i, j, apart = (np.concatenate(x) for x in zip(*found, strict=True))
            edges = forest(hi - lo, i, j, apart)
            a, b = node[lo:hi][i[edges]], node[lo:hi][j[edges]]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(apart[edges])], ["a", "b", "distance"])


def candidates(fps: DataFrame, words: int, cut: int, similarity: float, tile: int = TILE) -> DataFrame:
    """fps: node (long) and fp. Distinct edges (a < b, distance in the sketch) that an exact check is left to judge."""
    rows = tiled(_filed(fps, words, plan(fps, words, cut, similarity)), ["part", "value"], "node", tile)
    keys, bound = ["part", "value", "tile"], sketch_bound(similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, keys):
            yield from _met(table, bound)

    edges = rows.repartition(*keys).sortWithinPartitions(*keys, "role").mapInArrow(run, "a long, b long, distance long")
    return edges.groupBy("a", "b").agg(F.min("distance").alias("distance"))


def _checked(edges: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The edges whose shingle sets have the similarity; two texts without a word are alike."""
    x, y = sets.toDF("a", "x"), sets.toDF("b", "y")
    both = edges.select("a", "b").join(x, "a").join(y, "b").withColumn("n", F.size(F.array_intersect("x", "y")))
    union = F.size("x") + F.size("y") - F.col("n")
    return both.where((union == 0) | (F.col("n") / union >= similarity)).select("a", "b")


def links(edges: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(node, component) over the edges that pass the exact check. Edges inside a group that is linked already are not checked."""
    ends = edges.select("a", "b", F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("other")), F.struct(F.col("b").alias("node"), F.col("a").alias("other")))).alias("e"), "distance")
    nearest = ends.groupBy("e.node").agg(F.min(F.struct("distance", "e.other")).alias("m")).select("node", F.col("m.other").alias("other"))
    nearest = materialize(nearest.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct())
    sure = materialize(_checked(nearest, sets, similarity))
    groups_ = materialize(components(sure))
    rest = edges.join(nearest, ["a", "b"], "left_anti")
    for end in "ab":
        rest = rest.join(small(groups_.toDF(end, f"group_{end}")), end, "left")
    rest = rest.where(F.coalesce("group_a", "a") != F.coalesce("group_b", "b"))
    return materialize(components(sure.union(materialize(_checked(rest, sets, similarity)))))


def classes(docs: DataFrame, text: str = "text", id: str = "doc_id", width: int = SHINGLE, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(digest, found): digest has id and node of every row, found the component of each node that is linked to another.
    A node stands for one text (its 64-bit hash), so copies cost nothing."""
    node = F.xxhash64(text_or_empty(text)).alias("node")
    words, cut = layout(docs.count(), similarity)
    plain = docs.select(F.col(id).alias("id"), node, text_or_empty(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = [wide(shingle_hashes(x.as_py(), width), words + SKETCH).tobytes() for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fp, type=pa.binary())], ["id", "node", "fp"])

    digest = materialize(plain.mapInArrow(run, StructType([*plain.schema.fields[:2], *StructType.fromDDL("fp binary").fields])))
    edges = materialize(candidates(digest.select("node", "fp").dropDuplicates(["node"]), words, cut, similarity))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_hashes(x.as_py(), width).view(np.int64) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, type=pa.list_(pa.int64()))], ["node", "hashes"])

    needed = materialize(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    wanted = plain.select("node", "text").join(small(needed), "node", "left_semi").mapInArrow(hashed, "node long, hashes array<long>")
    sets = materialize(wanted.dropDuplicates(["node"]))
    return digest.select("id", "node"), links(edges, sets, similarity)


def one_of_each(docs: DataFrame, text: str = "text", id: str = "doc_id", width: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of docs that stay, all columns: of each group of linked or equal texts the row with the smallest id (of ties
    the text with the smallest hash; repeated rows of it all stay). Rows without an id go where their group has one, else
    all stay. Texts without a word, null and empty ones among them, are alike."""
    digest, found = classes(docs, text, id, width, similarity)
    marked = digest.join(small(found), "node", "left").withColumn("component", F.coalesce("component", "node"))
    marked = materialize(marked)
    first = marked.where("id IS NOT NULL").groupBy("component").agg(F.min(F.struct("id", "node")).alias("first"), F.count("*").alias("rows"))
    several = marked.groupBy("component").agg(F.count("*").alias("n")).where("n > 1").select("component")
    first = materialize(first.join(several, "component").select("component", "first"))
    go = marked.join(small(first), "component").where("NOT (id <=> first.id AND node = first.node)")
    go = materialize(go.select("id", "node").distinct())
    packed = docs.select(F.struct("*").alias("row"), F.col(id).alias("id"), F.xxhash64(text_or_empty(text)).alias("node")).alias("d")
    gone = small(go).alias("g")
    return packed.join(gone, F.col("d.id").eqNullSafe(F.col("g.id")) & (F.col("d.node") == F.col("g.node")), "left_anti").select("row.*")
