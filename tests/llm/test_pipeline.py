"""run() against its stages by brute force."""

from collections import Counter, defaultdict

import corpus_pipeline
from tests.llm.test_near_copies import brute
from tests.llm.test_operators import SCHEMA, corpus

from tesserae.llm import langid, mixing


def test_run(spark, tmp_path):
    rows = [r for r in corpus() if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert [k for k, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash_near_dedup", "mixing", "packing"]
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(docs).collect()}
    left = [r for r in rows if found[r[0]][0] != "und" and found[r[0]][1] >= langid.LEAST_SCORE]
    first = {}
    for r in sorted(left, key=lambda r: r[0]):
        first.setdefault(r[1], r)
    left = list(first.values())
    label = brute({r[0]: r[1] for r in left})
    left = [r for r in left if label[r[0]] == r[0]]
    kept = spark.createDataFrame([(*r, len(r[1])) for r in left], "doc_id long, text string, lang string, source string, n_chars long")
    copies = Counter({r["doc_id"]: r["copies"] for r in mixing.mix(kept).select("row.doc_id", "copies").collect()})
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter(r["doc_id"] for r in got if r["piece"] == 0) == +copies
    fill = defaultdict(list)
    for r in got:
        fill[r["sequence_id"]].append(r["length"])
    assert all(sum(x) <= 4096 and len(x) <= 64 and (len(x) == 1 or sum(n * n for n in x) <= 0.9 * 4096**2) for x in fill.values())


def test_stages_keep_columns_and_take_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        empty = stage(spark, empty, "")
        assert empty.columns == [c.split(" ")[0] for c in SCHEMA.split(", ")]
    assert corpus_pipeline.STAGES[-1][1](spark, empty, "").count() == 0


def test_run_takes_null_and_repeated_ids(spark, tmp_path):
    """Rows without an id and repeated rows go through every stage; exact copies leave one row."""
    rows = [(*r, len(r[1] or "")) for r in corpus()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    left = corpus_pipeline.exact(spark, corpus_pipeline.language(spark, docs, ""), "").collect()
    assert len({r["text"] for r in left}) == len(left) and any(r["doc_id"] is None for r in left)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in got} <= {r["doc_id"] for r in left} and None in {r["doc_id"] for r in got}


def test_stages_hand_on_columns_of_any_name(spark):
    names = ["a b", "a.b", "a-b", "row", "id", "UPPER", "select", "x`y", "fp", "é"]
    rows = [(i, t, k, s, *[f"{n}{i}" for n in names]) for i, t, k, s in corpus() if i is not None]
    quoted = lambda n: "`" + n.replace("`", "``") + "`"
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, " + ", ".join(f"{quoted(n)} string" for n in names))
    before = {tuple(r) for r in docs.collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == ["doc_id", "text", "lang", "source", *names]
    left = docs.collect()
    assert left and {tuple(r) for r in left} <= before
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() >= len(left)
