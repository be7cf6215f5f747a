"""The audit against a walk of every document through every order."""

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

from tesserae.llm import filter_audit
from tests.llm.test_operators import SCHEMA, corpus

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def walked(rows, labels):
    """(part, order, step) -> figures; part None is the whole table."""
    good, toxic = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, t in labels if t == 1 and i is not None}
    ids = defaultdict(list)
    for i, t, *_ in rows:
        if i is not None:
            ids[t or ""].append(i)
    figures, shapley = defaultdict(Counter), Counter()
    for i, t, lang, *_ in rows:
        t = t or ""
        w = WORD.findall(t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > min(ids[t])}
        for part in (lang or "", None):
            for o in permutations("ABCDE"):
                out = False
                for s, f in enumerate(o):
                    c = figures[part, "".join(o), s + 1]
                    c["removed"] += fails[f] and not out
                    c["redundant"] += fails[f] and out
                    c["unique_fails"] += fails[f] and sum(fails.values()) == 1
                    c["good_lost"] += fails[f] and not out and i in good
                    c["toxic_lost"] += fails[f] and not out and i in toxic
                    shapley[part, f] += fails[f] and not out
                    out |= fails[f]
                    c["kept"] += not out
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
    return {k: (k[1][k[2] - 1], *[c[n] for n in names], shapley[k[0], k[1][k[2] - 1]]) for k, c in figures.items()}


def test_audit(spark):
    rows = corpus()
    r = random.Random(4)
    long = " ".join(f"w{r.randrange(400)}" for _ in range(300))
    rows += [(200 + i, long, k, "s") for i, k in enumerate(["en", "fr", "en", None, "", "de"])]
    rows += [(202, long, "en", "s"), (None, long, "en", "s"), (None, long, "xx", "s"), (300, long.upper(), "fr", "s"), (301, "a " * 300 + "#", "fr", "s"), (302, "İ\x00 \x85 é" * 50, "fr", "s")]
    rows += [(400 + i, long + " same", "en", "s") for i in range(40)]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1, None])) for i in range(0, 440)] + [(201, 1, 0), (201, 0, 1), (None, 1, 1)]
    docs = spark.createDataFrame([(*x, "extra", "clash", "y", "z") for x in rows], SCHEMA).repartition(4)
    found = filter_audit.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = {(x["part"], x["filter_order"], x["step"]): tuple(x)[3:] for x in found.collect()}
    assert found.columns == ["part", "filter_order", "step", "filter", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert got == walked(rows, labels) and len(got) == 600 * len({x[2] or "" for x in rows} | {None})


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(spark.createDataFrame([], SCHEMA), none).count() == 0
    one = filter_audit.audit(spark.createDataFrame([(None, None, None, None)], "doc_id long, text string, lang string, source string"), none).where("part = ''")
    assert one.count() == 600 and one.where("step = 1 AND filter = 'A'").agg({"removed": "max"}).first()[0] == 1
