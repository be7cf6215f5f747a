"""Exact top-k inner products with multi-resolution segment statistics (operator 9).

A vector is summarised by the means and deviations of its segments, few long segments first, then more and shorter ones.
Scaled by the root of a segment's length, mean * mean' + dev * dev' summed over segments bounds the inner product from above
(Cauchy-Schwarz on the deviations; with the norms: the distance from below).

Candidates are put in order by their coarse statistics and cut into blocks. Each block has an envelope: the range of its
coarse means, its largest deviations. Every query first gets a floor, its k-th best exact score among a fixed sample of
candidates. A query goes only to blocks whose envelope can reach its floor, and a block only to query blocks that have such
a query; what cannot matter is not shipped. In a tile, level by level, pairs whose bound is under the floor are dropped; the
survivors are scored exactly, and floors rise from chunk to chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tesserae.llm.common import materialize

#: Numbers of segments, coarse to fine; the second one orders blocks and makes envelopes.
LEVELS = (1, 4, 16)
BLOCK_ROWS = 50_000
#: A table is cut into this many candidate blocks at least, as far as blocks of LEAST_ROWS go, and into MOST_BLOCKS at most,
#: so that their envelopes (8 numbers each) fit a task.
LEAST_BLOCKS, LEAST_ROWS, MOST_BLOCKS = 64, 500, 100_000
CHUNK = 2_048
#: Candidates that every query is scored against first.
SAMPLE = 512
#: A share of pairs under which they are bounded and scored one by one, not as a matrix.
SPARSE = 0.1
LONG = (1 << 63) - 1


def quantized(vector: str, scale: float = 256.0) -> Column:
    """floor(scale * x) of each component, x and result as double (whole numbers, exact at any size); null if the vector is
    null or empty, or has a null or non-finite component. What overflows double counts as its largest number."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    most = F.lit(float(np.finfo(np.float64).max))

    def floor(x: Column) -> Column:
        y = F.greatest(-most, F.least(most, x.cast("double") * scale))
        return F.when(F.abs(y) < 2.0**53, F.floor(y).cast("double")).otherwise(y)  # larger doubles are whole

    return F.when(F.col(vector).isNotNull() & (F.size(vector) > 0) & fine, F.transform(vector, floor))


def _segments(x: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """sqrt(length) * mean and sqrt(length) * deviation of each segment."""
    edges = np.unique(np.linspace(0, x.shape[1], min(count, x.shape[1]) + 1).astype(int))
    length = np.diff(edges)
    total, square = np.add.reduceat(x, edges[:-1], axis=1), np.add.reduceat(x * x, edges[:-1], axis=1)
    return total / np.sqrt(length), np.sqrt(np.maximum(0, square - total * total / length))


def _slack(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """What rounding may take from a bound of each query: a share of the largest product of norms, and half a unit."""
    norms = [np.sqrt((v * v).sum(axis=1)) for v in (q, x)]
    return 0.5 + 1e-9 * norms[0] * norms[1].max(initial=0)


def _exact(q: np.ndarray, x: np.ndarray, i: np.ndarray | None = None, j: np.ndarray | None = None) -> np.ndarray:
    """Integer inner products of all pairs, or of rows i of q with rows j of x. Doubles are exact while every partial sum is
    under 2**53; beyond that whole numbers of any size are used and clipped to the range of a long."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    if most < 2.0**53:
        return ((q @ x.T) if i is None else np.einsum("ij,ij->i", q[i], x[j])).astype(np.int64)
    if most < 2.0**62:
        a, b = q.astype(np.int64), x.astype(np.int64)
        return a @ b.T if i is None else (a[i] * b[j]).sum(axis=1)
    a, b = (np.array([[int(c) for c in row] for row in v.tolist()], dtype=object).reshape(v.shape) for v in (q, x))
    found = a @ b.T if i is None else (a[i] * b[j]).sum(axis=1)
    return np.array([max(-LONG - 1, min(LONG, int(s))) for s in np.ravel(found)], dtype=np.int64).reshape(np.shape(found))


def floors(q_id: np.ndarray, q: np.ndarray, x_id: np.ndarray, x: np.ndarray, k: int) -> np.ndarray:
    """Each query's k-th best exact score among x, its own id left out; minus infinity if there are fewer."""
    if len(x) < k or not len(q):
        return np.full(len(q), -np.inf)
    score = np.where(q_id[:, None] == x_id[None, :], -np.inf, _exact(q, x).astype(np.float64))
    return np.partition(score, -k, axis=1)[:, -k]


def best(q_id: np.ndarray, q: np.ndarray, x_id: np.ndarray, x: np.ndarray, k: int, floor: np.ndarray | None = None, levels: tuple = LEVELS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(query position, candidate id, score, pairs dropped by each level): of the candidates that reach floor, at least the k
    best of each query by (-score, id), own id left out."""
    floor = np.full(len(q), -np.inf) if floor is None else floor.copy()
    kept, dropped = [np.zeros(0, dtype=np.int64)] * 3, np.zeros(len(levels), dtype=np.int64)
    slack = _slack(q, x)
    qs, xs = [_segments(q, s) for s in levels], [_segments(x, s) for s in levels]
    for lo in range(0, len(x), CHUNK):
        hi = min(lo + CHUNK, len(x))
        bar, i, j = floor - slack, None, None
        for n, ((qm, qd), (xm, xd)) in enumerate(zip(qs, xs, strict=True)):
            if i is None:
                alive = qm @ xm[lo:hi].T + qd @ xd[lo:hi].T >= bar[:, None]
                if n:
                    alive &= earlier
                left, earlier = int(alive.sum()), alive
                dropped[n] += (before if n else alive.size) - left
                if left < SPARSE * alive.size:
                    i, j = np.nonzero(alive)
                    j += lo
            else:
                fine = np.einsum("ij,ij->i", qm[i], xm[j]) + np.einsum("ij,ij->i", qd[i], xd[j]) >= bar[i]
                dropped[n] += len(i) - int(fine.sum())
                i, j, left = i[fine], j[fine], int(fine.sum())
            before = left
        if not before:
            continue
        if i is None:
            i, j = np.nonzero(earlier)
            score = _exact(q, x[lo:hi])[i, j]
            j += lo
        else:
            score = _exact(q, x, i, j)
        fine = (q_id[i] != x_id[j]) & (score >= floor[i])
        new = [i[fine], x_id[j[fine]], score[fine]]
        at, ids, scores = (np.concatenate([a, b]) for a, b in zip(kept, new, strict=True))
        order = np.lexsort((ids, ~scores, at))  # falling scores; a negative of the least long would overflow
        at, ids, scores = at[order], ids[order], scores[order]
        place = np.arange(len(at)) - np.searchsorted(at, at)
        kept = [at[place < k], ids[place < k], scores[place < k]]
        full = place == k - 1
        floor[at[full]] = np.maximum(floor[at[full]], scores[full].astype(np.float64))
    return *kept, dropped


def envelope(x: np.ndarray, segments: int = LEVELS[1]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Least and largest scaled mean and largest scaled deviation of each segment, and the largest norm."""
    m, d = _segments(x, segments)
    return m.min(axis=0), m.max(axis=0), d.max(axis=0), float(np.sqrt((x * x).sum(axis=1)).max())


def reachable(q: np.ndarray, floor: np.ndarray, low: np.ndarray, high: np.ndarray, dev: np.ndarray, norm: np.ndarray, segments: int = LEVELS[1]) -> np.ndarray:
    """Whether a block (rows of low, high, dev, norm) may hold a candidate that reaches a query's floor; queries x blocks."""
    m, d = _segments(q, segments)
    bound = np.maximum(m, 0) @ high.T + np.minimum(m, 0) @ low.T + d @ dev.T
    own = np.sqrt((q * q).sum(axis=1))
    return np.minimum(bound, own[:, None] * norm) >= floor[:, None] - 0.5 - 1e-9 * own[:, None] * norm


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _of_dims(rows: DataFrame, asked: DataFrame, dims: int, n: int, nq: int, k: int, block_rows: int) -> DataFrame:
    """Results of the vectors of one length: query_id, mark, vec_id, score."""
    per = max(1, min(block_rows, max(LEAST_ROWS, n // LEAST_BLOCKS)), -(-n // MOST_BLOCKS))
    across, down = max(1, -(-n // per)), max(1, -(-nq // block_rows))

    def coarse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Orders vectors by the signs and then the sizes of their coarse means; what is alike stands together."""
        for batch in batches:
            m, d = _segments(_matrix(batch.column("v"), dims), LEVELS[1])
            signs = ((m > 0) * (1 << np.arange(m.shape[1]))).sum(axis=1).astype(np.float64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "v", "row")), pa.array(signs), pa.array((m * m + d * d).sum(axis=1))], ["id", "v", "row", "signs", "size"])

    def placed(df: DataFrame, blocks: int) -> DataFrame:
        """With the row's block: ranges of the order, written, so that a block's number is fixed."""
        ordered = df.mapInArrow(coarse, "id long, v array<double>, row long, signs double, size double")
        # ties of the order are cut by row, so that equal vectors fill no block
        return materialize(ordered.repartitionByRange(blocks, "signs", "size", F.xxhash64("row")).withColumn("block", (F.spark_partition_id() % blocks).cast("long")).select("id", "v", "block"))

    candidates, queries = placed(rows, across), placed(asked, down)

    def hulls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(block, hull): the envelope of each block's rows in the batch."""
        for batch in batches:
            block, v = batch.column("block").to_numpy(), _matrix(batch.column("v"), dims)
            found = [(b, *envelope(v[block == b])) for b in np.unique(block).tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), *[pa.array([np.atleast_1d(x[c]).tolist() for x in found], pa.list_(pa.float64())) for c in (1, 2, 3, 4)]], ["block", "low", "high", "dev", "norm"])

    parts = min(LEVELS[1], dims)
    wide = [(f(F.col(c)[i]).alias(f"{c}{i}")) for c, f, size in (("low", F.min, parts), ("high", F.max, parts), ("dev", F.max, parts), ("norm", F.max, 1)) for i in range(size)]
    table = candidates.mapInArrow(hulls, "block long, low array<double>, high array<double>, dev array<double>, norm array<double>").groupBy("block").agg(*wide).orderBy("block").toPandas()  # MOST_BLOCKS rows at most
    hull = [table[[c for c in table.columns if c.startswith(name)]].to_numpy(dtype=np.float64) for name in ("low", "high", "dev")]
    norm, names = table["norm0"].to_numpy(dtype=np.float64), table["block"].to_numpy(dtype=np.int64)
    sample = candidates.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("id", "v").toPandas()
    s_id = sample["id"].to_numpy(dtype=np.int64)
    s = np.stack(sample["v"].to_list()).astype(np.float64) if len(sample) else np.zeros((0, dims))

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A query's floor, and the candidate blocks that may reach it."""
        for batch in batches:
            step = max(1, 4_000_000 // max(1, len(names)))
            for lo in range(0, len(batch), step):
                part = batch.slice(lo, step)
                q = _matrix(part.column("v"), dims)
                floor = floors(part.column("id").to_numpy(), q, s_id, s, k)
                go = reachable(q, floor, *hull, norm)
                i, j = np.nonzero(go)
                at = pa.array(i)
                yield pa.RecordBatch.from_arrays([part.column("id").take(at), part.column("v").take(at), pa.array(floor[i]), part.column("block").take(at), pa.array(names[j]), pa.array(np.ones(len(i), dtype=np.int32))], ["id", "v", "floor", "q_block", "x_block", "role"])

    sent = materialize(queries.mapInArrow(routed, "id long, v array<double>, floor double, q_block long, x_block long, role int"))
    tiles = sent.select("x_block", "q_block").distinct()
    met = candidates.join(tiles, F.col("block") == F.col("x_block")).select("id", "v", F.lit(0.0).alias("floor"), "q_block", "x_block", F.lit(0).alias("role"))

    def run(table: pa.Table) -> pa.Table:
        role, ids, floor = (table.column(c).to_numpy() for c in ("role", "id", "floor"))
        v = _matrix(table.column("v").combine_chunks(), dims)
        q, x, q_id, x_id, q_floor = v[role == 1], v[role == 0], ids[role == 1], ids[role == 0], floor[role == 1]
        out: list[list] = [[], [], [], []]
        for lo in range(0, len(q), 512):
            at, vid, score, _ = best(q_id[lo : lo + 512], q[lo : lo + 512], x_id, x, k, q_floor[lo : lo + 512])
            marks = np.array([xxhash.xxh64_intdigest(v.tobytes()) >> 1 for v in q[lo : lo + 512]], dtype=np.int64)
            for o, a in zip(out, (q_id[lo + at], marks[at] if len(at) else at, vid, score), strict=True):
                o.append(a)
        cols = [np.concatenate(o) if o else np.zeros(0, dtype=np.int64) for o in out]
        return pa.table([pa.array(c.astype(np.int64)) for c in cols], names=["query_id", "mark", "vec_id", "score"])

    return met.unionByName(sent).groupBy("x_block", "q_block").applyInArrow(run, "query_id long, mark long, vec_id long, score long")


def top_k(vectors: DataFrame, queries: Column, k: int = 5, vector: str = "embedding", id: str = "vec_id", scale: float = 256.0, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row of vectors that meets `queries` the k rows with the highest
    integer inner product, ties to the smaller id, rows with the query's own id left out.

    Rows with a null id, and vectors that are null, empty or hold a null or non-finite component, take no part; vectors
    of different lengths are not compared (each length is a search of its own). Products are exact at any size; a score
    beyond the range of a long is given as the end of that range. A query row that is repeated exactly is one query. Fewer
    than k other rows give fewer results; an empty table gives none.
    """
    rows = vectors.select(F.col(id).cast("long").alias("id"), quantized(vector, scale).alias("v"), queries.alias("is_query")).where("id IS NOT NULL AND v IS NOT NULL")
    rows = materialize(rows.withColumns({"dims": F.size("v"), "row": F.monotonically_increasing_id()}))
    asked = materialize(rows.where("is_query").groupBy("id", "v", "dims").agg(F.min("row").alias("row")))
    sizes = {r["dims"]: r["count"] for r in asked.groupBy("dims").count().collect()}
    of = {r["dims"]: r["count"] for r in rows.groupBy("dims").count().collect()}
    schema = "query_id long, mark long, vec_id long, score long"
    found = vectors.sparkSession.createDataFrame([], schema)
    for dims, nq in sorted(sizes.items()):
        own = F.col("dims") == dims
        found = found.unionByName(_of_dims(rows.where(own).select("id", "v", "row"), asked.where(own).select("id", "v", "row"), dims, of[dims], nq, k, block_rows))
    order = W.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
