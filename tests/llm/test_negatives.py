"""Hard negatives against brute force: ties, nulls, repeats, ragged and huge vectors, clashing names, one hot label."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesserae.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, row string, id string, rank string"


def brute(rows, is_anchor, k=5, least=80, most=100):
    """rows of (id, vector, label); the operator's result by definition."""
    fine = lambda v: bool(v) and all(x is not None and math.isfinite(x) for x in v)
    rows = list({(i, k2, tuple(math.floor(256 * x) for x in v)) for i, v, k2 in rows if i is not None and k2 is not None and fine(v)})
    clip = lambda n: max(-(2**63), min(2**63 - 1, n))
    out = []
    for i, label, v in rows:
        if not is_anchor(i):
            continue
        score = lambda w: clip(sum(a * b for a, b in zip(v, w, strict=True)))
        others = sorted({(-score(w), j, other == label) for j, other, w in rows if j != i and len(w) == len(v)})
        for p, j, _ in [x for x in others if x[2]][:k]:
            found = [(n, m) for n, m, same in others if not same and least * -p <= 100 * -n <= most * -p][:k]
            out += [(i, j, r + 1, m, -p, -n) for r, (n, m) in enumerate(found)]
    return sorted(out)


def vectors(seed, n, dims=8, scale=0.4):
    r = random.Random(seed)
    centre = [[r.gauss(0, scale) for _ in range(dims)] for _ in range(4)]
    rows = [[i, [c + r.gauss(0, scale / 2) for c in centre[r.randrange(4)]], 0 if r.random() < 0.5 else r.randrange(4)] for i in range(n)]
    rows[3][1], rows[4][2], rows[5][0] = None, None, None
    rows[6][1][2], rows[7][1][0], rows[8][1][0], rows[9][1] = None, float("nan"), float("-inf"), []
    rows[11][1] = rows[12][1] = rows[13][1] = rows[10][1]  # ties
    rows[20][1], rows[21][1], rows[22][1] = [1.0, 0.5], [0.5, 0.5], [0.5, 0.25]  # of another length
    rows[20][2] = rows[21][2] = 1
    rows[22][2] = 2
    rows += [rows[10][:], rows[30][:], [30, [x + 0.1 for x in rows[30][1]], 2]]  # repeated rows, and one id with two vectors
    return rows


@pytest.mark.parametrize("anchor_block,block_rows", [(50_000, 1_000_000), (7, 60)])
def test_mine(spark, monkeypatch, anchor_block, block_rows):
    monkeypatch.setattr(negatives, "LEAST_ROWS", 20)
    rows = vectors(1, 400)
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)
    got = negatives.mine(df, F.col("vec_id") % 10 == 0, F.col("label"), anchor_block=anchor_block, block_rows=block_rows)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute(rows, lambda i: i % 10 == 0)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 50 and any(x[0] == 20 for x in want)


@pytest.mark.parametrize("size", [1e6, 1e14, 1e200])
def test_sizes(spark, size):
    """Products beyond single precision, beyond double precision, and beyond a long."""
    r = random.Random(3)
    rows = [[i, [size * (1 + r.random()) for _ in range(3)], i % 3] for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted(map(tuple, negatives.mine(df, F.col("vec_id") % 10 == 0, F.col("label")).collect()))
    assert got == brute(rows, lambda i: i % 10 == 0) and got


def test_planes_and_intervals():
    """Planes add up; pairs are dropped plane by plane and none that qualifies is."""
    r = np.random.default_rng(2)
    x, q = r.integers(-300, 300, (200, 16)), r.integers(-300, 300, (40, 16))
    parts = list(negatives.planes(x))
    assert (sum(w * p.astype(np.int64) for w, _, p in parts) == x).all() and [b for _, b, _ in parts] == sorted((b for _, b, _ in parts), reverse=True)
    exact = q @ x.T
    low, high = np.full(40, 300_000), np.full(40, 400_000)
    i, j, score, dropped = negatives.survivors(q, x, np.ones(exact.shape, dtype=bool), low, high)
    want = {(a, b): exact[a, b] for a, b in zip(*np.nonzero((exact >= 300_000) & (exact <= 400_000)), strict=True)}
    assert {(a, b): s for a, b, s in zip(i.tolist(), j.tolist(), score.tolist(), strict=True)} == want
    assert sum(dropped) == exact.size - len(want) and sum(dropped[:4]) > 0.5 * exact.size and sum(n > 0 for n in dropped) >= 5


def test_few(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert negatives.mine(empty, F.col("vec_id") % 10 == 0, F.col("label")).count() == 0
    alone = spark.createDataFrame([(0, [1.0], 1), (1, [1.0], 1), (2, [-1.0], 2), (3, [None], 2)], "vec_id long, embedding array<double>, label int")
    assert negatives.mine(alone, F.col("vec_id") == 0, F.col("label")).count() == 0
    zero = spark.createDataFrame([(0, [0.0], 1), (1, [1.0], 1), (2, [-1.0], 2)], "vec_id long, embedding array<double>, label int")
    assert [tuple(r) for r in negatives.mine(zero, F.col("vec_id") == 0, F.col("label")).collect()] == [(0, 1, 1, 2, 0, 0)]
