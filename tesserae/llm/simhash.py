"""SimHash near-dedup with the generalised pigeonhole principle (operator 3).

Fingerprints come from a narrow pass. Equal fingerprints are collapsed before anything else, so copies cost nothing.
For m parts of the 64 bits and thresholds T with sum(T) = most - m + 1, two fingerprints within `most` bits have a part in
which they differ by at most T_i. Parts gather correlated bits (correlations counted over all fingerprints); a dynamic
program chooses T, and the cheapest m, from estimated candidate counts. Each fingerprint is filed under the value of each
part and probes the values within T_i. A bucket with many members is cut into chunks and compared chunk pair by chunk
pair in tasks of their own; a task emits at most one edge per member and tile (a spanning forest of the verified links),
never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import beside_row, materialize, small, texts_of
from tesserae.llm.components import components

BITS = 64
SHINGLE = 4
MOST_BITS = 4
SEED = 42
TILE = 1_000
#: Estimated cost of filing or probing one row, in units of one comparison.
ROW_COST = 100


def fingerprint(text: str, width: int = SHINGLE) -> int:
    """SimHash of the word shingles of a text: a bit is 1 if set in over half the shingles' XXH64; no word: 0."""
    words = text.encode().lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(width, len(words))
    spans = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)
    hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], dtype=np.uint64)
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, text: str = "text", width: int = SHINGLE) -> DataFrame:
    """docs with a column fp (long, the fingerprint's bits); null text counts as empty. Narrow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(x.as_py(), width) for x in texts_of(batch, text)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(values.view(np.int64))], ["row", "fp"])

    packed = docs.select(F.struct("*").alias("row"))
    return packed.mapInArrow(run, beside_row(packed, "fp long"))


# --- the plan: parts of bits and their thresholds -------------------------------------------------------------------


def _bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Rows, and how often bits i and j are both set; over all rows, 64 x 64 numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS), dtype=np.int64), 0
        for batch in batches:
            bits = _bits(batch.column(0).to_numpy())
            for i in range(0, len(bits), 1 << 16):
                part = bits[i : i + (1 << 16)].astype(np.float32)
                total += (part.T @ part).astype(np.int64)
            n += len(bits)
        i, j = np.triu_indices(BITS)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(i, -1)), pa.array(np.append(j, -1)), pa.array(np.append(total[i, j], n))], ["i", "j", "n"])

    rows = fps.select("fp").mapInArrow(run, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    both = np.zeros((BITS, BITS))
    for r in rows:
        if r["i"] >= 0:
            both[r["i"], r["j"]] = both[r["j"], r["i"]] = r["n"]
    return sum(r["n"] for r in rows if r["i"] < 0), both


def _bits(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def group_bits(correlation: np.ndarray, m: int) -> list[list[int]]:
    """m parts of near equal width: each starts at the lowest free bit and takes the free bits most correlated with it."""
    free, parts = set(range(len(correlation))), []
    for k in range(m):
        width = len(correlation) // m + (k < len(correlation) % m)
        part = [min(free)]
        free.discard(part[0])
        while len(part) < width:
            best = max(sorted(free), key=lambda b: correlation[b, part].sum())
            part.append(best)
            free.discard(best)
        parts.append(sorted(part))
    return parts


def allocate(costs: list[list[float]], budget: int) -> tuple[float, list[int]]:
    """Thresholds T_i >= -1 with sum `budget` and least total cost; costs[i][t + 1] is part i's cost at threshold t."""
    best = {0: (0.0, [])}
    for cost in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for spent, (total, chosen) in best.items():
            for t, c in enumerate(cost, -1):
                if (x := step.get(spent + t)) is None or total + c < x[0]:
                    step[spent + t] = (total + c, [*chosen, t])
        best = step
    return best[budget]


def plan(fps: DataFrame, most: int = MOST_BITS) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each part that is probed. A part's candidate count at threshold 0 is exact (pairs with equal
    values, over all fingerprints); for higher ones it is scaled by the bits' disagreement odds."""
    n, both = _bit_counts(fps)
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.outer(p * (1 - p), p * (1 - p))) + 1e-9
    correlation = np.abs(both / max(n, 1) - np.outer(p, p)) / spread
    layouts = {m: group_bits(correlation, m) for m in range(2, most + 2)}
    values = [F.struct(F.lit(m).alias("m"), F.lit(i).alias("i"), _value(part).alias("v")) for m, parts in layouts.items() for i, part in enumerate(parts)]
    sizes = fps.select(F.explode(F.array(*values)).alias("x")).groupBy("x").count().groupBy("x.m", "x.i").agg(F.sum(F.col("count").cast("double") * (F.col("count") - 1) / 2).alias("pairs")).collect()
    equal = {(r["m"], r["i"]): r["pairs"] for r in sizes}
    found = None
    for m, parts in layouts.items():
        costs = []
        for i, part in enumerate(parts):
            odds = np.array([1.0])
            for q in 2 * p[part] * (1 - p[part]):
                odds = np.convolve(odds, [1 - q, q])
            cost, rows = [0.0], 0
            for t in range(most + 1):
                rows += comb(len(part), t)
                scale = odds[: t + 1].sum() / max(odds[0], 1e-12)
                cost.append(ROW_COST * n * (rows + 1.0) + equal.get((m, i), 0.0) * scale)
            costs.append(cost)
        total, chosen = allocate(costs, most - m + 1)
        if found is None or total < found[0]:
            found = total, list(zip(parts, chosen, strict=True))
    return [(part, t) for part, t in found[1] if t >= 0]


def _value(part: list[int]) -> F.Column:
    mask = sum(1 << b for b in part)
    return F.col("fp").bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))


# --- probing and verifying ------------------------------------------------------------------------------------------


def _filed(fps: DataFrame, parts: list[tuple[list[int], int]]) -> DataFrame:
    """Rows (part, value, role, fp): role 0 under the own value, role 1 under each value within the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.ascontiguousarray(batch.column(0).to_numpy()).view(np.uint64)
            for k, (part, most) in enumerate(parts):
                own = fp & np.uint64(sum(1 << b for b in part))
                for t in range(most + 1):
                    for flipped in combinations(part, t):
                        value = own ^ np.uint64(sum(1 << b for b in flipped))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(fp), k, dtype=np.int32)), pa.array(value.view(np.int64)), pa.array(np.full(len(fp), int(t > 0), dtype=np.int32)), pa.array(fp.view(np.int64))], ["part", "value", "role", "fp"]
                        )

    return fps.select("fp").mapInArrow(run, "part int, value long, role int, fp long")


def tiled(rows: DataFrame, keys: list[str], member: str, tile: int) -> DataFrame:
    """Adds column tile: a bucket with over `tile` rows is cut into chunks by hash, and each row goes to one tile per
    chunk, so that every two rows of a bucket share a tile and a tile holds about two chunks."""
    hot = materialize(rows.groupBy(*keys).count().where(F.col("count") > tile).select(*keys, F.ceil(F.col("count") / tile).alias("chunks")))
    if hot.isEmpty():
        return rows.withColumn("tile", F.lit(0).cast("long"))
    rows = rows.join(small(hot), keys, "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    own, other = F.pmod(F.xxhash64(member), F.col("chunks")), F.col("other")
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    return rows.withColumn("tile", F.least(own, other) * F.col("chunks") + F.greatest(own, other)).drop("chunks", "other")


def groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 50_000) -> Iterator[pa.Table]:
    """Tables of whole groups out of batches sorted by keys."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(len(x) for x in held) >= rows:
            table = pa.Table.from_batches(held).combine_chunks()
            cut = int(starts(table, keys)[-1])
            if cut:
                yield table.slice(0, cut)
            held = table.slice(cut).to_batches()
    if held and sum(len(x) for x in held):
        yield pa.Table.from_batches(held).combine_chunks()


def starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Positions at which a new group begins."""
    new = np.zeros(len(table), dtype=bool)
    new[:1] = True
    for k in keys:
        x = table.column(k).to_numpy()
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest position reachable from each of n positions over the pairs (i, j)."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        np.minimum.at(new, label[i], least)
        np.minimum.at(new, label[j], least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _linked(table: pa.Table, most: int) -> Iterator[pa.RecordBatch]:
    """Edges of a spanning forest of the links inside each group; rows of a group are sorted by role."""
    first = starts(table, ["part", "value", "tile"])
    size = np.diff(np.append(first, len(table)))
    fp, role = table.column("fp").to_numpy().view(np.uint64), table.column("role").to_numpy()
    left = np.repeat(first + size, size) - np.arange(len(table)) - 1  # members that follow in the same group
    cost = np.cumsum(np.add.reduceat(left, first)) if len(first) else left
    for k in np.split(np.arange(len(first)), np.flatnonzero(np.diff(cost // 4_000_000)) + 1):
        lo, hi = first[k[0]], first[k[-1]] + size[k[-1]]
        at, d, found = np.arange(lo, hi)[role[lo:hi] == 0], 1, []
        while len(at := at[left[at] >= d]):
            near = (np.bitwise_count(fp[at] ^ fp[at + d]) <= most) & (fp[at] != fp[at + d])
            found.append((at[near], at[near] + d))
            d += 1
        i = np.concatenate([x for x, _ in found] or [at]) - lo
        j = np.concatenate([x for _, x in found] or [at]) - lo
        if len(i):
            own = fp[lo:hi]
            to = own[roots(hi - lo, i, j)]
            moved = to != own
            yield pa.RecordBatch.from_arrays([pa.array(own[moved].view(np.int64)), pa.array(to[moved].view(np.int64))], ["a", "b"])


def links(fps: DataFrame, most: int = MOST_BITS, tile: int = TILE) -> DataFrame:
    """Edges (a, b) between distinct fingerprints; their components are those of all pairs within `most` bits."""
    rows = tiled(_filed(fps, plan(fps, most)), ["part", "value"], "fp", tile)
    keys = ["part", "value", "tile"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, keys):
            yield from _linked(table, most)

    return rows.repartition(*keys).sortWithinPartitions(*keys, "role").mapInArrow(run, "a long, b long")


def classes(marked: DataFrame, most: int = MOST_BITS) -> DataFrame:
    """marked: fp and id. (fp, component_id, rows): the smallest id among all rows reachable over links."""
    fps = materialize(marked.groupBy("fp").agg(F.min("id").alias("id"), F.count("*").alias("rows")))
    found = components(links(fps, most))
    joined = fps.join(found, fps["fp"] == found["node"], "left").withColumn("component", F.coalesce("component", "fp"))
    joined = materialize(joined.select("fp", "id", "rows", "component"))
    least = joined.groupBy("component").agg(F.min("id").alias("component_id"))
    return joined.join(least, "component").select("fp", "component_id", "rows")


def near_duplicates(docs: DataFrame, text: str = "text", id: str = "doc_id", most: int = MOST_BITS, width: int = SHINGLE) -> DataFrame:
    """One row per row of docs: id, fingerprint (16 hex digits), component_id.

    Null and empty texts, and texts without a word, have fingerprint zero and link like any other. Null ids take no part
    in the smallest id; a component of null ids has a null component_id. Repeated rows are kept. Other columns are ignored.
    """
    marked = materialize(fingerprints(docs.select(id, text), text, width).select(F.col(f"row.{id}").alias("id"), "fp"))
    found = materialize(classes(marked, most))
    joined = marked.join(small(found), "fp")
    return joined.select(F.col("id").alias(id), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, text: str = "text", id: str = "doc_id", most: int = MOST_BITS, width: int = SHINGLE) -> DataFrame:
    """The rows of docs that stay, all columns: of each component the row with the smallest id; of repeated rows with that
    id and text, all stay (exact dedup comes first). A component without any id stays whole; null ids go in any other."""
    twin = F.xxhash64(F.col(text))
    rows = fingerprints(docs, text, width)
    digest = materialize(rows.select(F.col(f"row.{id}").alias("id"), F.xxhash64(f"row.{text}").alias("twin"), "fp"))
    found = materialize(classes(digest, most))
    go = materialize(digest.join(small(found), "fp").where("NOT (id <=> component_id)").select("id", "twin").distinct())
    packed = docs.select(F.struct("*").alias("row"), F.col(id).alias("id"), twin.alias("twin")).alias("d")
    gone = small(go).alias("g")
    return packed.join(gone, F.col("d.id").eqNullSafe(F.col("g.id")) & (F.col("d.twin") == F.col("g.twin")), "left_anti").select("row.*")
