"""Near copies by wide SimHash against all pairs of shingle sets."""

import random

import numpy as np
import pytest
from tests.llm.test_operators import SCHEMA

from tesserae.llm import near_copies
from tesserae.llm.common import materialize


def shingles(text, width=5):
    words = [w for w in (text or "").encode().lower().split() if w]
    k = min(width, len(words))
    return {b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


def brute(texts, similarity=0.8):
    """id -> smallest id reachable over pairs of texts with the similarity."""
    sets, label = {i: shingles(t) for i, t in texts.items()}, {i: i for i in texts}
    find = lambda x: x if label[x] == x else find(label[x])
    for a in sets:
        for b in sets:
            union = len(sets[a] | sets[b])
            if a < b and (not union or len(sets[a] & sets[b]) / union >= similarity):
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    return {i: find(i) for i in texts}


def changed(words, share, draw):
    """The words with runs replaced until about that share of five-word shingles is new."""
    words, n = list(words), max(1, round(share * len(words) / 5))
    for at in draw.sample(range(len(words)), n):
        words[at] = f"new{draw.random()}"
    return words


@pytest.fixture(scope="module")
def planted(spark):
    draw = random.Random(5)
    texts, i = {}, 0
    for _ in range(120):
        base = [f"w{draw.randrange(3_000)}" for _ in range(draw.randrange(60, 400))]
        for share in (0, 0.04, 0.08, 0.3, 0.8):
            texts[i := i + 1] = " ".join(changed(base, share, draw) if share else base)
    hot = [f"h{draw.randrange(500)}" for _ in range(200)]
    for _ in range(300):  # one group of many near copies
        texts[i := i + 1] = " ".join(changed(hot, 0.03, draw))
    return texts, spark.createDataFrame(list(texts.items()), "doc_id long, text string")


def test_planted_near_copies(spark, planted):
    """Nothing unlike is linked, and nearly every linked document finds its group."""
    texts, docs = planted
    want = brute(texts)
    kept = {r["doc_id"] for r in near_copies.one_of_each(docs).collect()}
    first = {i for i in texts if want[i] == i}
    assert first <= kept
    redundant = set(texts) - first
    assert len(redundant) > 500 and len(redundant & kept) <= 0.02 * len(redundant)


def test_small_tiles_lose_nothing(spark, planted):
    """However small the tiles of a bucket are, the same groups come out."""
    _, docs = planted
    rows = [(i, near_copies.wide(near_copies.shingle_hashes(t), 15).tobytes()) for i, t in docs.collect()]
    fps = materialize(spark.createDataFrame([(i, bytearray(x)) for i, x in rows], "node long, fp binary"))
    groups = []
    for tile in (1_000, 40):
        edges = near_copies.candidates(fps, 11, 4, 0.8, tile)
        found = near_copies.components(edges.select("a", "b")).collect()
        groups.append({(r["node"], r["component"]) for r in found})
    assert groups[0] == groups[1] and groups[0]


def test_nulls_empties_repeats_and_names(spark):
    long = " ".join(f"x{i}" for i in range(50_000))
    rows = [(3, None), (4, ""), (5, " \t"), (None, "same words here and there again"), (7, "same words here and there again"), (7, "same words here and there again"), (8, long), (9, long + " end"), (None, "alone"), (None, "alone")]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, `a.b` int")
    got = near_copies.one_of_each(docs)
    assert got.columns == ["doc_id", "text", "a.b"]
    assert sorted(r["a.b"] for r in got.collect()) == [0, 4, 5, 6, 8, 9]
    empty = spark.createDataFrame([], SCHEMA)
    assert near_copies.one_of_each(empty).count() == 0


def test_wide_bits_and_plan():
    draw = np.random.default_rng(1)
    hashes = np.unique(draw.integers(0, 2**63, 700, dtype=np.uint64))
    mixed = []
    for k in range(1, 4):
        x = [(int(h) + k * 0x9E3779B97F4A7C15) % 2**64 for h in hashes]
        x = [((v ^ (v >> 30)) * 0xBF58476D1CE4E5B9) % 2**64 for v in x]
        x = [((v ^ (v >> 27)) * 0x94D049BB133111EB) % 2**64 for v in x]
        mixed.append([v ^ (v >> 31) for v in x])
    want = [sum(1 << b for b in range(64) if sum(v >> b & 1 for v in x) * 2 > len(x)) for x in mixed]
    assert near_copies.wide(hashes, 3).tolist() == want
    # the cheapest thresholds that reach the gain, against every choice
    costs, gains = [[0, 5, 9], [0, 4, 30], [0, 7, 8]], [[0, 1.0, 3.0], [0, 1.0, 3.0], [0, 1.0, 2.0]]
    chosen = near_copies.cover(costs, gains, 4.0)
    every = [(sum(c[t] for c, t in zip(costs, ts, strict=True)), ts) for ts in np.ndindex(3, 3, 3) if sum(g[t] for g, t in zip(gains, ts, strict=True)) >= 4]
    assert sum(c[t + 1] for c, t in zip(costs, chosen, strict=True)) == min(every)[0]


def test_forest():
    i, j, d = np.array([0, 0, 1, 3]), np.array([1, 2, 2, 4]), np.array([5, 1, 2, 7])
    assert sorted(near_copies.forest(6, i, j, d).tolist()) == [1, 2, 3]
