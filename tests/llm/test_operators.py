"""Every operator against a brute-force version, on fixtures that hold nulls, empty, long and repeated texts, ties, and
extra columns with clashing names; and on empty tables."""

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict
from functools import cache as cached
from itertools import product

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tesserae.llm import exact_dedup, langid, line_dedup, mixing, packing, pii, quality, queries, simhash, substring, topk

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, row string, id string, size string, text_sha256 string"


def corpus():
    """(doc_id, text, lang, source) with the cases of the contract."""
    r = random.Random(5)
    syllables = {"en": "the and ing tion er re on at".split(), "fr": "que eau é la ou ment è ç".split(), "de": "ung ä sch ein der ß keit pf".split()}
    word = lambda k: "".join(r.choice(syllables[k]) for _ in range(r.randint(1, 4)))
    say = lambda k, n: " ".join(word(k) + r.choice(["", "", "", ".", ",", "\n"]) for _ in range(n))
    rows = []
    for i in range(90):
        k = r.choice(list(syllables))
        rows.append([i, say(k, r.choice([1, 3, 8, 30, 60, 200])), k, f"src{i % 4}"])
    passage = say("en", 50)
    for i in (3, 9, 27):
        rows[i][1] += " " + passage + " " + say("en", 5)
    rows[40][1] = "again and again " * 40
    for i in (50, 51, 52, 53):
        rows[i][1] = rows[10][1]
    for i in (60, 61, 62):
        words = rows[20][1].split(" ")
        words[i % len(words)] = "changed"
        rows[i][1] = " ".join(words)
    rows[70][1], rows[71][1], rows[72][1], rows[73][1], rows[74][1] = None, "", " \n\t ", "$$$ 12 !!", "x"
    rows[75][1] = "\x1cfirst\x85second\xa0third Straße İx ΑΣ. é! \U0001f600 <|endoftext|> don't,!! a_. b., 　"
    rows[76][1] = say("de", 9000)
    rows[77][2], rows[78][3] = None, None
    rows[79][0] = None
    rows += [rows[5][:], rows[6][:], [None, "lone text without an id", "en", "src1"]]
    rows[80][1] = 'mail a.b@c.example.org, +1 (555) 010-9999 from 10.0.0.255 or 10.0.0.256, token = "9f8e7d6c5b4a39281706f5e4d3c2b1a0", 4111 1111 1111 1111'
    rows[81][1] = "a@b.c@d.e @x.y 1.2.3.4.5 411111111111111 +123 é+49 170 1234567"
    return [tuple(x) for x in rows]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, "extra", "clash", "y", "z") for r in rows], SCHEMA).repartition(3).persist()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def same(a, b):
    assert sorted(map(repr, a)) == sorted(map(repr, b))


# --- 1 ------------------------------------------------------------------------------------------------------------


def kneser_ney(train, order):
    """Interpolated modified Kneser-Ney over bytes, as the formulas say: a function of (context, byte)."""
    padded = [bytes(order - 1) + t for t in train]
    levels = {order: Counter(p[i - order + 1 : i + 1] for p in padded for i in range(order - 1, len(p)))}
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    discount = {}
    for k, c in levels.items():
        n = Counter(c.values())
        if all(n[i] for i in (1, 2, 3, 4)):
            y = n[1] / (n[1] + 2 * n[2])
            discount[k] = [max(0.05, i - (i + 1) * y * n[i + 1] / n[i]) for i in (1, 2, 3)]
        else:
            discount[k] = [0.5, 1.0, 1.5]
    d = lambda k, n: min(n, discount[k][min(n, 3) - 1])
    by_context = {k: defaultdict(list) for k in levels}
    for k, c in levels.items():
        for g, n in c.items():
            by_context[k][g[:-1]].append(n)

    def p(g):
        out = 1 / 256
        for k in range(1, order + 1):
            h = g[order - k :]
            if seen := by_context[k].get(h[:-1]):
                n = levels[k].get(h, 0)
                out = ((n - d(k, n)) if n else 0) / sum(seen) + sum(d(k, x) for x in seen) / sum(seen) * out
        return out

    return p


@pytest.mark.parametrize("order", [3, quality.ORDER])
def test_quality(spark, docs, rows, order):
    trusted = spark.createDataFrame([(i,) for i in range(0, 90, 2)], "doc_id long")
    got = {(r["doc_id"], r["lang"]): r for r in quality.classify(docs, trusted, order=order).collect() if r["doc_id"] is not None}
    held = {r["doc_id"]: r["h"] for r in docs.select("doc_id", (F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(quality.HELD_OUT)) == 0).alias("h")).collect()}
    lower = lambda t: (t or "").encode().lower()
    train = defaultdict(list)
    for i, t, k, _ in rows:
        if i is not None and i % 2 == 0 and not held[i]:
            train[k or "und"].append(lower(t))
    assert len(got) > 80
    models = {k or "und": cached(kneser_ney(train[k or "und"], order)) for _, _, k, _ in rows}
    for i, t, k, _ in rows:
        if i is None:
            continue
        k, data = k or "und", lower(t)
        r = got[i, k]
        if not data:
            assert r["perplexity"] is None and not r["kept"]
            continue
        p, padded = models[k], bytes(order - 1) + data
        logs = [np.log(p(padded[j : j + order])) for j in range(len(data))]
        assert r["perplexity"] == pytest.approx(np.exp(-np.mean(logs)), rel=1e-9)
        assert r["kept"] == (r["threshold"] is None or r["perplexity"] <= r["threshold"])


def test_quality_default_order(spark):
    """Words of five letters that differ only where five bytes of context tell them apart."""
    r = random.Random(8)
    texts = [" ".join(r.choice(["aabab", "babab", "abaab", "bbaba", "aaaab"]) for _ in range(30)) for _ in range(12)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    held = {r["doc_id"]: r["h"] for r in docs.select("doc_id", (F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(quality.HELD_OUT)) == 0).alias("h")).collect()}
    p = kneser_ney([t.encode() for i, t in enumerate(texts) if not held[i]], 6)
    for x in quality.classify(docs, docs.select("doc_id")).collect():
        data = texts[x["doc_id"]].encode()
        logs = [np.log(p((bytes(5) + data)[j : j + 6])) for j in range(len(data))]
        assert x["perplexity"] == pytest.approx(np.exp(-np.mean(logs)), rel=1e-9)


def test_quality_deals_repeated_rows(spark, monkeypatch):
    """Rows of one id go to several blocks and are scored alike; trusted ones train wherever they are."""
    monkeypatch.setattr(quality, "BLOCK_BYTES", 500)
    texts = [(1, "the cat sat")] * 40 + [(None, "a dog ran")] * 30 + [(i, f"row {i} of many") for i in range(2, 30)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in texts], "doc_id long, text string, lang string").repartition(3)
    trusted = docs.select("doc_id").where("doc_id % 2 = 1")
    want = sorted((r["doc_id"] or 0, round(r["perplexity"], 9)) for r in quality.classify(docs, trusted, order=4).collect())
    monkeypatch.setattr(quality, "HOT_ROWS", 5)
    placed, known = quality._dealt(docs.select(F.col("doc_id").alias("id"), "text", "lang"), trusted.toDF("id"))
    assert placed.where("id = 1").select("slice").distinct().count() > 1 and known.where("id = 1").count() > 1
    assert sorted((r["doc_id"] or 0, round(r["perplexity"], 9)) for r in quality.classify(docs, trusted, order=4).collect()) == want


def test_quality_without_rows(spark, empty, docs):
    assert quality.classify(empty, empty.select("doc_id")).count() == 0
    untrained = quality.classify(docs, empty.select("doc_id")).where("perplexity IS NOT NULL").select("perplexity").distinct().collect()
    assert {round(r[0], 6) for r in untrained} == {256.0}


# --- 2 ------------------------------------------------------------------------------------------------------------


def test_langid(docs, rows):
    def grams(t):
        s = "".join(c if c.isalpha() else " " for c in t.lower())
        s = " " + " ".join(s.split()) + " "
        if not s.strip():
            return Counter()
        return Counter(c for c in s if c != " ") + Counter(s[i : i + 2] for i in range(len(s) - 1)) + Counter(s[i : i + 3] for i in range(len(s) - 2) if s[i + 1] != " ")

    def pack(g):
        v = 0
        for c in g:
            v = v << 21 | ((ord(c) if c != " " else 0) + 1)
        return v

    top = lambda c: [g for g, _ in sorted(((pack(g), n) for g, n in c.items()), key=lambda x: (-x[1], x[0]))][: langid.PROFILE]
    out = lambda i: zlib.crc32(str(i if i is not None else "").encode()) % 4 == 2
    learned = defaultdict(Counter)
    for i, t, k, _ in rows:
        if k and not out(i):
            learned[k] += grams(t or "")
    profiles = {k: {g: n for n, g in enumerate(top(c))} for k, c in learned.items()}
    want = []
    for i, t, _, _ in rows:
        own = top(grams(t or "")) if any(c.isalpha() for c in t or "") else []
        near = {k: 1 - sum(abs(p[g] - n) if g in p else langid.PROFILE for n, g in enumerate(own)) / len(own) / langid.PROFILE for k, p in sorted(profiles.items())} if own else {}
        best = max(near, key=lambda k: near[k]) if near else "und"
        want.append((i, out(i), best, round(max(0.0, near.get(best, 0.0)), 9)))
    same([(r["doc_id"], r["held_out"], r["lang_pred"], round(r["score"], 9)) for r in langid.identify(docs).collect()], want)


def test_langid_edges(docs, empty):
    assert langid.identify(empty).count() == 0
    assert langid.known(docs).columns == docs.columns
    assert {r["doc_id"] for r in docs.select("doc_id").collect()} - {r["doc_id"] for r in langid.known(docs).collect()} >= {70, 71, 72, 73}
    assert {r["lang_pred"] for r in langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


# --- 3 ------------------------------------------------------------------------------------------------------------


def components(nodes, linked):
    label = {n: n for n in nodes}
    find = lambda x: x if label[x] == x else find(label[x])
    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                label[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def fingerprint(t):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(docs, rows, empty):
    fps = [(i, fingerprint(t)) for i, t, _, _ in rows]
    label = components(sorted({f for _, f in fps}), lambda a, b: (a ^ b).bit_count() <= 4)
    least = defaultdict(list)
    for i, f in fps:
        if i is not None:
            least[label[f]].append(i)
    want = [(i, f"{f:016x}", min(least[label[f]], default=None)) for i, f in fps]
    same([tuple(r) for r in simhash.near_duplicates(docs).collect()], want)
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    alone = {i for i, _, c in want if i == c or i is None}
    assert {r["doc_id"] for r in kept.collect()} == alone


@pytest.mark.parametrize(("tile", "thresholds"), [(8, None), (1000, None), (1000, (1, 1, 0)), (20, (2, -1, 0, 0)), (1000, (2, 1))])
def test_simhash_links(spark, monkeypatch, tile, thresholds):
    """Dense near copies and chains of fingerprints; small tiles cut the buckets; other plans than the cheapest one here."""
    if thresholds:
        m = len(thresholds)
        assert sum(thresholds) == 4 - m + 1
        parts = [list(range(64))[i::m] for i in range(m)]
        monkeypatch.setattr(simhash, "plan", lambda *_: [(p, t) for p, t in zip(parts, thresholds, strict=True) if t >= 0])
    r = random.Random(3)
    values = {0, 1, 3, 2**63, 2**64 - 1}
    for _ in range(6):
        seed = r.getrandbits(64)
        for _ in range(25):
            values.add(seed)
            seed ^= sum(1 << r.randrange(64) for _ in range(r.randint(1, 5)))
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    nodes = sorted(signed(v) for v in values)
    fps = spark.createDataFrame([(v,) for v in nodes], "fp long")
    got = {r["node"]: r["component"] for r in simhash.components(simhash.links(fps, 4, tile)).collect()}
    want = components(nodes, lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 4)
    assert {v: got.get(v, v) for v in nodes} == want


def test_pigeonhole_plan():
    cost, chosen = simhash.allocate([[0, 5, 50], [0, 1, 2], [0, 9, 90]], 0)
    assert sum(chosen) == 0 and chosen == [-1, 1, 0] or cost == min(cost, 11)
    parts = simhash.group_bits(np.eye(64), 5)
    assert sorted(b for p in parts for b in p) == list(range(64))


# --- 4 ------------------------------------------------------------------------------------------------------------


def base_spans(t):
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m.group().split("."))]
    for kind, pattern, least, most in ((2, r"[0-9]([\x20-]?[0-9])+", 12, 19), (3, r"\+[0-9][\x20().0-9-]+[0-9]", 9, 15)):
        for m in re.finditer(pattern, t):
            d = re.sub("[^0-9]", "", m.group())
            if least <= len(d) <= most and (kind == 3 or sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0):
                found.append((m.start(), kind, m.end()))
    return [f"{pii.BASE[k]}:{a}:{b}" for a, k, b in sorted(found)]


def test_pii(docs, rows, empty):
    got = pii.find(docs).collect()
    want = [(i, hashlib.sha256(",".join(s := base_spans(t or "")).encode()).hexdigest(), *[sum(x.startswith(k) for x in s) for k in pii.BASE]) for i, t, _, _ in rows]
    same([(r["doc_id"], r["base_sha256"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) for r in got], want)
    assert pii.find(empty).count() == 0
    assert {r["doc_id"]: r["spans"] for r in got if r["doc_id"] is not None} == {i: ",".join(base_spans(t or "")) for i, t, _, _ in rows if i is not None}  # too few to learn from
    full = next(r for r in got if r["doc_id"] == 80)
    assert pii.redact(rows[80][1], full["spans"]).startswith("mail [email], [phone] from [ip] or 10.0.0.256")


def planted(n, seed=2):
    """(text, planted spans): validated data of each kind beside like data that no base pattern matches, and clean texts."""
    r = random.Random(seed)
    d = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    word = lambda: "".join(r.choice("abcdefghilmnorstu") for _ in range(r.randint(3, 9)))
    key = lambda: "".join(r.choice("0123456789abcdef") for _ in range(40))
    made = {
        "email": lambda: (f"{word()}.{d(2)}@{word()}.{r.choice(['com', 'org', 'net'])}", True),
        "spelt": lambda: (f"{word()}.{d(2)} at {word()} dot {r.choice(['com', 'org', 'net'])}", True),
        "handle": lambda: (f"@{word()}", False),
        "host": lambda: (f"{word()}@{word()}", False),
        "phone": lambda: (f"+1 ({d(3)}) {d(3)}-{d(4)}", True),
        "local": lambda: (f"({d(3)}) {d(3)}-{d(4)}", True),
        "date": lambda: (f"20{d(2)}/{d(2)}/{d(2)} {d(2)}", False),
        "serial": lambda: (d(r.randint(7, 11)), False),
        "named": lambda: (f'token = "{key()}"', True),
        "bare": lambda: (f'"{key()}"', True),
        "word": lambda: (word() + "_" + word() + "_" + word() + "_" + word(), False),
        "clean": lambda: ("", False),
    }
    out = []
    for i in range(n):
        kind = list(made)[i % len(made)]
        what, personal = made[kind]()
        before = " ".join(word() for _ in range(6)) + " "
        span = (len(before) + (9 if kind == "named" else kind == "bare"), len(before) + len(what) - (kind in ("named", "bare")))
        out.append((kind, before + what + " " + " ".join(word() for _ in range(6)), span if personal else None))
    return out


def test_pii_learns_what_no_base_pattern_matches(spark):
    """Every kind adds spans: recall of planted data by kind, and clean and like texts left alone."""
    rows = planted(4_800)
    got = {r["doc_id"]: r for r in pii.find(spark.createDataFrame([(i, t) for i, (_, t, _) in enumerate(rows)], "doc_id long, text string")).collect()}
    caught, n = Counter(), Counter()
    for i, (kind, _, span) in enumerate(rows):
        spans = [s.split(":") for s in got[i]["spans"].split(",") if s]
        n[kind] += 1
        caught[kind] += any((int(a), int(b)) == span for _, a, b in spans) if span else bool(spans)
        assert got[i]["n_spans"] == len(spans) and got[i]["n_secret"] == sum(k == "secret" for k, *_ in spans)
    share = {k: caught[k] / n[k] for k in n}
    assert all(share[k] == 1 for k in ("email", "phone")) and all(share[k] > 0.9 for k in ("spelt", "local", "named", "bare")), share
    assert all(share[k] < 0.02 for k in ("handle", "host", "date", "serial", "word", "clean")), share


def test_pii_fits_on_all_candidates(spark):
    """A kind with some 30 candidates of each label among 80,000 is learned, and its held-out ones count in its threshold."""
    x = lambda kind, v: F.array(*[F.lit(float(kind)), v.cast("float"), *[F.lit(0.0)] * (pii.FEATURES - 2)]).cast("array<float>")
    one = lambda c: F.array(c.cast("int"))
    i = F.col("id")
    rare, label = i < 60, i % 2
    found = spark.range(80_000).select("id", one(F.lit(0)).alias("start"), one(F.when(rare, 0).otherwise(1)).alias("kind"), one(label).alias("label"), F.when(rare, x(0, label * 10)).otherwise(x(1, label * 10 + i % 3)).alias("x"))
    trees, thresholds = pii.fit(found)
    assert trees and all(t < 1 for t in thresholds[:2]) and thresholds[2] == 2


def test_pii_threshold_by_weight():
    score, label = np.array([0.9, 0.8, 0.8, 0.3, 0.1]), np.array([1, 1, 0, 1, 0])
    n = np.array([5, 2, 3, 1, 40])
    assert pii.threshold(score, label, weight=n.astype(float)) == pii.threshold(np.repeat(score, n), np.repeat(label, n))


def test_pii_labels_are_no_function_of_features():
    """The same span scores alike with and without what labels it."""
    f = pii.features
    assert f('x token = "' + "ab12" * 10, 11, 51, "secret") == f('x value = "' + "ab12" * 10, 11, 51, "secret")
    assert f("call +1 (555) 010-9999", 5, 22, "number") == f("call  1 (555) 010-9999", 6, 22, "number")
    assert f("me a.b at c dot org", 3, 19, "address")[1:] == f("me a.b@c.org", 3, 12, "address")[1:]


@pytest.mark.parametrize("text", ["1" * 10**6, "a1" * 500_000, "1." * 500_000, "a" * 500_000 + "@" + "b" * 500_000, "x " * 400_000 + " dot at ", "a" * 500_000 + " at b dot com", "+1" * 400_000, "+" + "1(" * 400_000, "at " * 300_000 + "dot", " " * 10**6 + "at b dot c", "a@b.c " * 100_000, "1.1.1.1 " * 100_000], ids=range(12))
def test_pii_takes_long_runs_in_linear_time(text):
    import time

    began = time.process_time()
    list(pii._find([pa.RecordBatch.from_pydict({"id": [1], "text": [text]})]))
    assert time.process_time() - began < 15


def test_pii_left_edge_of_a_long_secret():
    text = "key = " + "a" * 900 + "1" + "b" * 20 + " end"
    assert (6, 927, "secret") in pii.candidates(text)


@pytest.mark.parametrize("text", ["x@y", "@a.b", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "999.1.1.1 1.1.1.1", "0" * 5000 + ".1.1.1", "+1", "4" * 40, "5500-0000 0000 0004", "é a@ü.de", "1.2.3..4.5.6.7.8.9", "1.2.3.4.", ".1.2.3.4 1.2.3", "1.2.3.4.5.6.7.300.1.1.1.1", "00012.1.1.255"])
def test_pii_base_edges(text):
    if len(text) < 4000:
        assert [f"{k}:{a}:{b}" for a, b, k in pii.base_spans(text)] == base_spans(text)
    else:
        assert pii.base_spans(text) == [(0, len(text), "ip")]


# --- 5 ------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("hot", [2, 200])
@pytest.mark.parametrize("keep", ["max", "min"])
def test_exact_dedup(docs, rows, empty, hot, keep):
    groups = defaultdict(list)
    for i, t, _, _ in rows:
        groups[t or ""].append(i)
    best = {t: (max if keep == "max" else min)([i for i in g if i is not None], default=None) for t, g in groups.items()}
    want = [(i, best[t or ""], len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for i, t, _, _ in rows]
    got = exact_dedup.decisions(docs, keep=keep, hot_rows=hot).collect()
    same([(r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got], want)
    assert sum(r["kept"] for r in got) == len(groups) and all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])
    left = exact_dedup.survivors(docs, keep=keep, hot_rows=hot)
    assert left.columns == docs.columns
    same([r["doc_id"] for r in left.collect()], best.values())
    assert exact_dedup.decisions(empty).count() == 0 and exact_dedup.survivors(empty).count() == 0


def test_exact_dedup_of_repeated_rows(spark):
    """Copies of one row, and rows without an id, fill no run: they are dealt by row."""
    rows = [(1, "same")] * 500 + [(None, "same")] * 300 + [(2, "same"), (3, "other"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = exact_dedup.decisions(docs, keep="max", hot_rows=50).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in got) == Counter({(1, 2, 801, False): 500, (None, 2, 801, False): 300, (2, 2, 801, True): 1, (3, 3, 1, True): 1, (None, None, 1, True): 1})
    keyed = exact_dedup._keyed(docs, F.coalesce("text", F.lit("")), "doc_id", 50)[0]
    assert keyed.where("salt >= 0").groupBy("salt").count().agg(F.max("count")).first()[0] < 150
    assert sorted((r["doc_id"] or 0) for r in exact_dedup.survivors(docs, keep="max", hot_rows=50).collect()) == [0, 2, 3]


def test_exact_dedup_is_native(docs):
    plan = exact_dedup.survivors(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- 6 ------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(("most", "buckets"), [(mixing.SORTED_ROWS, mixing.BUCKETS), (2, 3)])
def test_mixing(docs, rows, empty, most, buckets):
    mixed = mixing.mix(docs, sorted_rows=most, buckets=buckets).select("row.doc_id", "row.source", "row.text", "size", "source_size", "target", "taken", "copies").collect()
    size = Counter()
    for _, t, _, s in rows:
        size[s] += len(WORD.findall(t or ""))
    names = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, todo, left = {}, set(names), 1.5 * sum(size.values())
    while todo:  # shares as told: cap, then share the excess anew
        share = {s: left * weight[s] / sum(weight[x] for x in todo) for s in todo}
        over = {s for s in todo if share[s] > 2 * size[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 2 * size[s]
            left -= target[s]
        todo -= over
    taken = Counter()
    for r in mixed:
        assert r["size"] == len(WORD.findall(r["text"] or "")) and r["source_size"] == size[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]]) and r["taken"] == r["size"] * r["copies"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    largest = {s: max(len(WORD.findall(t or "")) for _, t, _, x in rows if x == s) for s in names}
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in names)
    again = mixing.mix(docs.repartition(5)).select("row.doc_id", "taken").collect()
    same([(r["doc_id"], r["taken"]) for r in mixed], [tuple(r) for r in again])
    assert mixing.mix(empty).count() == 0
    out = mixing.repeated(mixing.mix(docs))
    assert out.columns == docs.columns and out.count() == sum(r["copies"] for r in mixed)


@pytest.mark.parametrize("most", [mixing.SORTED_ROWS, 5])
def test_mixing_of_equal_rows(spark, most):
    """900 equal rows: so many are taken as the target asks for, not all or none; rows without an id and without words too."""
    r = random.Random(6)
    texts = [(7, "one two three four five", "a")] * 900 + [(1000 + i, " ".join(["w"] * r.randint(1, 9)), "ab"[i % 2]) for i in range(98)] + [(None, "x y", "b")] * 50 + [(None, "x y z", "b")] * 9 + [(None, "", "a")] * 40
    docs = spark.createDataFrame(texts, "doc_id long, text string, source string").repartition(4)
    mixed = [mixing.mix(d, weights=(1, 1), columns=["doc_id", "source"], sorted_rows=most, buckets=4).select("row.*", "size", "source_size", "target", "copies", "taken").collect() for d in (docs, docs.repartition(3))]
    for s in "ab":
        own = [x for x in mixed[0] if x["source"] == s]
        assert abs(sum(x["taken"] for x in own) - own[0]["target"]) <= 5 and all(x["copies"] <= 2 for x in own)
    same(*[[(x["doc_id"], x["size"], x["taken"]) for x in m] for m in mixed])


# --- 7 ------------------------------------------------------------------------------------------------------------


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_edit_distance(edits):
    r = random.Random(edits)
    for _ in range(3000):
        a = [r.choice("ab") for _ in range(r.randint(0, 12))]
        b = a[:]
        for _ in range(r.randint(0, 4)):
            k = r.randint(0, len(b))
            b[k : k + r.randint(0, 1)] = [r.choice("abc")] * r.randint(0, 1)
        a, b = "".join(a), "".join(b)
        assert line_dedup.edit_distance(a, b, edits) == min(edit_distance(a, b), edits + 1)
        short, long = sorted((a, b), key=len)
        if edit_distance(a, b) <= edits < len(short):
            assert line_dedup.first_segment(short, long, edits) <= edits


@pytest.mark.parametrize("tile", [3, 500])
def test_line_dedup(spark, tile):
    r = random.Random(8)
    base = ["".join(r.choice("abcdeé ") for _ in range(r.randint(18, 60))) for _ in range(12)]
    texts = []
    for i in range(60):
        lines = []
        for _ in range(r.randint(0, 5)):
            x = list(r.choice(base))
            for _ in range(r.randint(0, 3)):
                k = r.randrange(len(x))
                x[k : k + r.randint(0, 1)] = [r.choice("abz")] * r.randint(0, 2)
            lines.append("".join(x))
        texts.append((None if i == 7 else i, None if i == 9 else "\n".join([*lines, ""] if i % 4 else lines)))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    occurrences = [(i, n, x) for i, t in texts for n, x in enumerate((t or "").split("\n")) if x]
    distinct = sorted({x for _, _, x in occurrences})
    near = lambda a, b: min(len(a), len(b)) >= 20 and abs(len(a) - len(b)) <= 2 and edit_distance(a, b) <= 2
    label = components(distinct, near)
    links = {a: sum(a != b and near(a, b) for b in distinct) for a in distinct}
    order = lambda o: (o[0] is None, o[0] or 0, o[1])
    head, n = {}, Counter()
    for o in sorted(occurrences, key=order):
        head.setdefault(label[o[2]], o)
        n[label[o[2]]] += 1
    want = []
    for i, t in texts:
        own = [(k, x) for k, x in enumerate((t or "").split("\n")) if x]
        told = [(k, head[label[x]][0], head[label[x]][1], links[x]) for k, x in own if n[label[x]] > 1]
        want.append((i, len(own), sum((i, k) != head[label[x]][:2] for k, x in own), told))
    got = [(r["doc_id"], r["n_lines"], r["n_removed"], [tuple(x) for x in r["lines"] or []]) for r in line_dedup.deduped(docs, least=20, tile=tile).collect()]
    same(got, want)


def test_line_dedup_query_joins_short_lines(spark, tmp_path):
    texts = ["Copyright 2019 Acme", "Copyright 2020 Acme", "the end", "then end", "abc", "abd", "xyzw", "12", "34"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: [(x["class_id"], x["links"]) for x in r["lines"] or []] for r in queries.op7_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {0: [(0, 1)], 1: [(0, 1)], 2: [(2, 1)], 3: [(2, 1)], 4: [(4, 1)], 5: [(4, 1)], 6: [], 7: [(7, 1)], 8: [(7, 1)]}


@pytest.mark.parametrize("edits,tile", [(2, 500), (2, 7), (1, 500), (3, 500)])
def test_line_dedup_is_exact_at_every_length(spark, edits, tile):
    """All lines of 1 to 6 characters of two letters, those of 1 to 3 of another two, and a few of other letters, against brute force; each alone in
    a document, so that every link count is seen."""
    lines = ["".join(x) for n in range(1, 7) for x in product("ab", repeat=n)] + ["".join(x) for n in range(1, 4) for x in product("cé", repeat=n)]
    lines += ["xy", "yx", "axby", "x12y", "zzzzz", "\U0001f600", "a\U0001f600", "12345678", "1234567"]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").repartition(3)
    near = lambda a, b: edit_distance(a, b) <= edits
    label = components(lines, near)
    links = {a: sum(a != b and near(a, b) for b in lines) for a in lines}
    first = {}
    for i, x in enumerate(lines):
        first.setdefault(label[x], i)
    want = {i: [(first[label[x]], links[x])] if links[x] else [] for i, x in enumerate(lines)}
    got = {r["doc_id"]: [(x["class_id"], x["links"]) for x in r["lines"] or []] for r in line_dedup.deduped(docs, edits=edits, tile=tile).collect()}
    assert got == want


def test_line_dedup_tells_lines_of_one_hash_apart(spark, monkeypatch):
    r = random.Random(4)
    texts = ["".join(r.choice("abcdefgh") for _ in range(12)) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate([*texts, *texts[:5]])), "doc_id long, text string")
    want = sorted((x["doc_id"], x["n_removed"]) for x in line_dedup.deduped(docs).collect())
    monkeypatch.setattr(line_dedup, "line_hash", lambda line: F.pmod(F.xxhash64(line), F.lit(4)))
    assert sorted((x["doc_id"], x["n_removed"]) for x in line_dedup.deduped(docs).collect()) == want
    assert [n for _, n in want] == [0] * 40 + [1] * 5


def test_line_dedup_adds_up_characters_once(monkeypatch):
    """The twelve keys of a line come from one pass over its characters."""
    r = random.Random(6)
    lines = ["".join(r.choice("abcdefgh ") for _ in range(r.randint(3, 90))) for _ in range(300)]
    batch = pa.RecordBatch.from_pydict({"lid": list(range(300)), "line": lines})
    seen, inner = [], np.cumsum
    monkeypatch.setattr(np, "cumsum", lambda x, *a, **b: (seen.append(len(x)), inner(x, *a, **b))[1])
    keys = [x for b in line_dedup._keys(2)[0](iter([batch])) for x in b.column("key").to_pylist()]
    assert len(keys) >= 11 * 300
    assert sum(seen) < 2 * sum(map(len, lines))


def test_line_dedup_sorts_keys_once(spark, monkeypatch):
    """What keys share is worked out once, though sizes and members both come from it."""
    r = random.Random(6)
    lines = ["".join(r.choice("abcdefgh ") for _ in range(r.randint(20, 90))) for _ in range(300)]
    distinct = spark.createDataFrame(list(enumerate([*lines, *[x + "." for x in lines[:50]]])), "lid long, line string").repartition(3)
    sent, read = (spark.sparkContext.accumulator(0) for _ in range(2))

    def counted(count, inner):
        def run(batches):
            for x in inner(batches):
                count.add(len(x))
                yield x

        return run

    shared, (keys, schema) = line_dedup._shared, line_dedup._keys(2)
    monkeypatch.setattr(line_dedup, "_keys", lambda edits: (counted(sent, keys), schema))
    monkeypatch.setattr(line_dedup, "_shared", lambda batches: shared(counted(read, iter)(batches)))
    links = line_dedup.joined(distinct).collect()
    assert sum(x["links"] for x in links) == 2 * 50
    assert read.value == sent.value > 0


def test_line_dedup_edges(docs, empty):
    assert line_dedup.deduped(empty).count() == 0
    assert line_dedup.deduped(docs).count() == docs.count()


# --- 8 ------------------------------------------------------------------------------------------------------------


def test_packing(docs, rows, empty):
    t = Tokenizer.from_file(TOKENIZER)
    want = []
    for i, text, _, _ in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        for k, start in enumerate(range(0, len(ids), 4096)):
            own = ids[start : start + 4096]
            want.append((i, k, start, len(own), zlib.crc32(np.array(own, dtype="<u4").tobytes())))
    got = packing.pack(docs, TOKENIZER).collect()
    same([(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got], want)
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(bins) <= -(-sum(x[3] for x in want) // 4096) + 1
    assert packing.pack(empty, TOKENIZER).count() == 0


def test_packing_ids_are_the_tokenizer_s():
    """Random texts of letters, marks and special tokens that do not go the usual way."""
    t, encode, r = Tokenizer.from_file(TOKENIZER), packing.Encoder(TOKENIZER), random.Random(9)
    parts = ["İ", "İ.", "BELEDİYESİ,", "ı", "ŉ.", "ǅ,", "ß", "ẞ.", "e\u0301", "\u0301", "\u0307,", "Å", "\u212b.", "ﬁ,", "Σ", "ΑΣ.", "ας,", "ſt.", "K,", "<|endoftext|>", "<|ENDOFTEXT|>", "x<|startoftext|>,", "<|", "|>.", "don't", "'S,", "'ll", "O'Re", "5.", "1,000.", "½.", "²,", "_.", "a_,", "..", ",.", "...", "—,", "\u200b.", "\u00ad,", "\U0001f600.", "中文。", "日,", "가,", "ế.", "Ǆ", "a", "B.", "cd,", "Straße.", "\x00.", "\x1c", "\x85", "\xa0", "\u3000"]
    texts = ["".join(r.choice(parts) + r.choice(["", " ", " ", "\n", "\t", "\r\n", ","]) for _ in range(r.randint(0, 9))) for _ in range(50_000)]
    texts += ["İSTANBUL BELEDİYESİ. tamam", "Bir SİTESİ, iki", "", " ", "plain text. Of words, usual."]
    want = [np.array(e.ids, dtype="<u4").tobytes() for e in t.encode_batch_fast(texts, add_special_tokens=False)]
    wrong = [x for x, a, b in zip(texts, encode(texts), want, strict=True) if a != b]
    assert not wrong, wrong[:5]


def test_packing_capacities_bind(docs):
    """Lower bounds on documents and attention cost hold, each alone, and cost sequences."""
    filled = lambda **kw: packing.pack(docs, TOKENIZER, **kw).groupBy("sequence_id").agg(F.count("*").alias("n"), F.sum("length").alias("t"), F.sum(F.col("length") ** 2).alias("a")).collect()
    free = filled()
    few, cheap = filled(documents=7), filled(attention=1e6)
    assert max(r["n"] for r in free) > 7 and max(r["n"] for r in few) == 7 and len(few) > len(free)
    assert all(r["n"] == 1 or r["a"] <= 1e6 for r in cheap) and max(r["a"] for r in free if r["n"] > 1) > 1e6 and len(cheap) > len(free)


def test_best_fit_holds_every_capacity():
    r = np.random.default_rng(0)
    length = r.integers(1, 900, 400).astype(float)
    demand, capacity = np.stack([length, np.ones(400), length**2], axis=1), np.array([1000.0, 6, 500_000])
    bins = packing.best_fit(demand, capacity, np.array([1.0, 0.3, 0.3]))
    for b in np.unique(bins):
        own = demand[bins == b]
        assert len(own) == 1 or (own.sum(axis=0) <= capacity).all()


# --- 9 ------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(("scale", "block"), [(256.0, 90), (3e7, 90), (256.0, 3)])
def test_topk(spark, monkeypatch, scale, block):
    monkeypatch.setattr(topk, "LEAST_ROWS", 20)
    r = np.random.default_rng(1)
    vectors = [(i, [float(x) for x in r.standard_normal(16).astype(np.float32)]) for i in range(400)]
    vectors[7] = (7, vectors[100][1])
    vectors[8] = (8, vectors[100][1])
    bad = [(500, None), (550, [None, *vectors[0][1][1:]]), (600, [float("nan")] * 16), (650, [float("inf")] * 16), (None, vectors[3][1]), (700, [])]
    df = spark.createDataFrame([(i, v, 0, "a") for i, v in vectors + bad], "vec_id long, embedding array<float>, label int, score string")
    got = defaultdict(list)
    for x in topk.top_k(df, F.col("vec_id") % 50 == 0, scale=scale, block_rows=block).orderBy("query_id", "rank").collect():
        got[x["query_id"]].append((x["vec_id"], x["score"]))
    whole = {i: [int(np.floor(np.float64(x) * scale)) for x in np.array(v, dtype=np.float32)] for i, v in vectors}
    for q in range(0, 400, 50):
        scores = sorted(((-sum(a * b for a, b in zip(whole[q], v, strict=True)), i) for i, v in whole.items() if i != q))[:5]
        assert got[q] == [(i, -s) for s, i in scores]
    assert set(got) == set(range(0, 400, 50))
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert topk.top_k(df.where("vec_id IN (50, 51)"), F.col("vec_id") % 50 == 0).count() == 1


def smooth(n, dims=64, seed=4):
    """Whole-number vectors whose neighbouring components are alike, as segment statistics want them."""
    r = np.random.default_rng(seed)
    return np.floor(256 * np.cumsum(r.standard_normal((n, dims)), axis=1) * r.choice([0.1, 1, 3], (n, 1)))


def test_topk_bounds_hold():
    x = smooth(300)
    q = x[:20]
    score = q @ x.T
    for s in topk.LEVELS:
        (qm, qd), (xm, xd) = topk._segments(q, s), topk._segments(x, s)
        assert (qm @ xm.T + qd @ xd.T >= score - 0.5).all()
    low, high, dev, norm = (np.array([v]) for v in topk.envelope(x))
    best = score.max(axis=1)
    assert topk.reachable(q, best, low, high, dev, norm).all()
    assert not topk.reachable(q, np.full(20, 1e12), low, high, dev, norm).any()


@pytest.mark.parametrize("start", [False, True])
def test_topk_every_level_drops_pairs(start):
    """Of smooth vectors each level drops pairs that the ones before it let pass; what stays is exact."""
    x = smooth(6_000)
    ids, q = np.arange(6_000), smooth(6_000)[::300] + np.round(np.random.default_rng(2).standard_normal((20, 64)) * 700)
    q_id = np.arange(10_000, 10_020)
    floor = topk.floors(q_id, q, ids[:512], x[:512], 5) if start else None
    at, found, score, dropped = topk.best(q_id, q, ids, x, 5, floor)
    whole = (q @ x.T).astype(np.int64)
    for k in range(20):
        want = np.lexsort((ids, -whole[k]))[:5]
        assert found[at == k].tolist() == want.tolist() and score[at == k].tolist() == whole[k][want].tolist()
    assert (dropped > 0).all() and dropped.sum() > 0.5 * whole.size


def test_topk_ships_only_tiles_that_can_matter(spark, monkeypatch):
    monkeypatch.setattr(topk, "LEAST_ROWS", 100)
    x = smooth(3_000)
    df = spark.createDataFrame([(i, v) for i, v in enumerate((x / 256).tolist())], "vec_id long, embedding array<double>")
    sent = []
    real = topk.reachable
    monkeypatch.setattr(topk, "materialize", lambda d, keep=topk.materialize: sent.append(keep(d)) or sent[-1])
    got = topk.top_k(df, F.col("vec_id") % 50 == 0).collect()
    whole = (x @ x.T).astype(np.int64)
    np.fill_diagonal(whole, -(2**60))
    want = [(q, n + 1, int(i), int(whole[q, i])) for q in range(0, 3_000, 50) for n, i in enumerate(np.lexsort((np.arange(3_000), -whole[q]))[:5])]
    same([tuple(r) for r in got], want)
    tiles = next(d for d in sent if "x_block" in d.columns)
    blocks = next(d for d in sent if d.columns == ["id", "v", "block"]).select("block").distinct().count()
    assert real is topk.reachable and 20 < blocks and 0 < tiles.count() < 0.7 * 60 * blocks


def test_topk_of_very_large_components(spark):
    """Whole numbers of any size; a score that no long can hold is given as the end of the range."""
    rows = [(0, [3e9, 1.0]), (1, [3e9, 2.0]), (2, [-3e38, 0.0]), (3, [3e38, 3e38]), (4, [1e-3, 5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    f = {i: [int(np.floor(256 * float(np.float32(c)))) for c in v] for i, v in rows}
    want = []
    for q in (0, 2, 4):
        score = {i: max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(f[q], v, strict=True)))) for i, v in f.items() if i != q}
        want += [(q, n + 1, i, s) for n, (i, s) in enumerate(sorted(score.items(), key=lambda x: (-x[1], x[0])))]
    same([tuple(r) for r in topk.top_k(df, F.col("vec_id") % 2 == 0).collect()], want)


# --- 10 -----------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(("window", "hot"), [(35, 1000), (5, 1000), (20, 2)])
def test_substring(docs, rows, empty, monkeypatch, window, hot):
    monkeypatch.setattr(substring, "HOT_PLACES", hot)
    words = [(t or "").encode() for _, t, _, _ in rows]
    words = [[w.decode() for w in x.split()] for x in words]
    starts = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    want = []
    for (i, *_), w in zip(rows, words, strict=True):
        gone = {k for j in range(len(w) - window + 1) if starts[tuple(w[j : j + window])] > 1 for k in range(j, j + window)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        want.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    same([tuple(r) for r in substring.repeated_windows(docs, window=window).collect()], want)
    assert substring.repeated_windows(empty).count() == 0


def test_substring_words_with_nul(spark):
    """NUL is a letter of a word like any other, at its end too."""
    plain, marked = " ".join(f"w{i}" for i in range(40)), " ".join(f"w{i}\0" for i in range(40))
    docs = spark.createDataFrame([(0, plain), (1, marked), (2, f"x {marked} y")], "doc_id long, text string")
    assert {r["doc_id"]: r["n_removed"] for r in substring.repeated_windows(docs).collect()} == {0: 0, 1: 40, 2: 40}


@pytest.mark.parametrize(("window", "block"), [(35, 200), (4, 60), (7, 1_000_000)])
def test_substring_blocks_of_any_size(spark, monkeypatch, window, block):
    """Small blocks leave to the anchors what a task would settle; few words make matches of every length, and loops."""
    monkeypatch.setattr(substring, "BLOCK_WORDS", block)
    r = random.Random(window)
    texts = [[r.choice("abc") for _ in range(r.randint(0, 60))] for _ in range(30)] + [["a"] * 300, ["b", "a"] * 90]
    long = [f"w{i}" for i in range(400)]
    texts += [[*long[:150], "x", *long[150:320]], [*long[40:], *long[:90]], long]
    starts = Counter(tuple(w[i : i + window]) for w in texts for i in range(len(w) - window + 1))
    want = {i: len({k for j in range(len(w) - window + 1) if starts[tuple(w[j : j + window])] > 1 for k in range(j, j + window)}) for i, w in enumerate(texts)}
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string").repartition(3)
    assert {x["doc_id"]: x["n_removed"] for x in substring.repeated_windows(docs, window=window).collect()} == want


@pytest.mark.parametrize(("window", "letters"), [(3, "ab"), (8, "ab"), (35, "a"), (5, "abcdef")])
def test_factors(window, letters):
    """Factors are the longest matches, as deep as the order goes, and cover every repeated window."""
    r = random.Random(window)
    passages = [[r.choice(letters) for _ in range(r.choice([0, 2, 9, 50, 120]))] for _ in range(12)]
    passages.append(passages[3] + passages[7])
    text = [ord(x) for p in passages for x in p]
    edge = np.cumsum([0, *map(len, passages)])
    places = [(k, i) for k, p in enumerate(passages) for i in range(len(p))]
    most = 1 << window.bit_length()

    def longest(k, i):
        def shared(m, j):
            n = 0
            while n < most and i + n < len(passages[k]) and j + n < len(passages[m]) and passages[k][i + n] == passages[m][j + n]:
                n += 1
            return n

        n = max((shared(m, j) for m, j in places if (m, j) != (k, i)), default=0)
        return n if n >= window else 0

    size = [longest(k, i) for k, i in places]
    block = substring.Block(np.array(text), edge, window)
    assert block.size.tolist() == size
    want = []
    for k, p in enumerate(passages):
        i = 0
        while i < len(p):
            if n := size[edge[k] + i]:
                want.append((k, i, n))
            i += n - window + 1 if n else 1
    assert list(zip(*(x.tolist() for x in block.factors()), strict=True)) == want
    covered = {(k, i + x) for k, i, n in want for x in range(n)}
    assert covered == {(k, i + x) for (k, i), n in zip(places, size, strict=True) if n for x in range(window)}


def test_block_memory():
    """A block of a million words stays under 80 bytes a word."""
    word = np.random.default_rng(1).integers(0, 50_000, 1_000_000).astype(np.int32)
    word[500_000:600_000] = word[:100_000]
    tracemalloc.start()
    try:
        block = substring.Block(word, np.arange(0, len(word) + 1, 100), 35)
        assert tracemalloc.get_traced_memory()[1] < 80 * len(word)
    finally:
        tracemalloc.stop()
    assert np.flatnonzero(block.size).tolist() == [100 * p + i for p in [*range(1_000), *range(5_000, 6_000)] for i in range(66)]


def test_passages_go_in_pieces(monkeypatch):
    """Passages are read a bounded number of bytes at a time; those under one anchor stay together."""
    monkeypatch.setattr(substring, "PASSAGE_BYTES", 100)
    seed = np.repeat(np.arange(40), 3)
    zero = np.zeros(len(seed), dtype=np.int64)
    sent = substring._sent(seed, zero, seed, zero, np.arange(len(seed)), zero, zero, zero, [b"a b c d e f g h"] * len(seed))
    pieces = list(substring._pieces(iter([pa.Table.from_batches([sent])])))
    assert [len(p) for p in pieces] == [6] * 20 and pa.concat_tables(pieces).equals(pa.Table.from_batches([sent]))
    found = pa.Table.from_batches(substring._parse_shared(8)[0](iter([sent])))
    assert sorted(found.column("id").to_pylist()) == list(range(len(seed)))
