"""One query per operator over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.llm import exact_dedup, filter_audit, html_extract, langid, line_dedup, mixing, negatives, packing, pii, quality, simhash, substring, topk

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = _table(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0").select("doc_id")
    return quality.classify(_table(spark, sf_dir, "documents"), trusted)


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decisions(_table(spark, sf_dir, "documents"), keep="max")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"), columns=["doc_id"]).select("row.doc_id", "size", "source_size", "target", "taken")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.deduped(_table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents").select("doc_id", "text"), TOKENIZER)


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated_windows(_table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return found.where("part IS NOT NULL").drop("filter")


def op13_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.extract(pages, html_extract.learn(pages)).select("row.page_id", "row.url", "text", "n_chars")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality, op2_langid, op3_simhash, op4_pii, op5_exact_dedup, op6_mixing, op7_line_dedup, op8_packing, op9_topk, op10_substring, op11_hard_negatives, op12_filter_audit, op13_html_extract)}


OP5 = """
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
WINDOW w AS (PARTITION BY t ORDER BY doc_id DESC NULLS LAST)
"""

OP6 = r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE)
         / greatest(0.05::DOUBLE, CASE WHEN length(text) > 0 THEN length(translate(text, '#$%&*|<>{}[]=@0123456789', ''))::DOUBLE / length(text) ELSE 0 END) AS k
  FROM documents),
totals AS (
  SELECT source, sum(size)::BIGINT AS s,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::DOUBLE AS w
  FROM docs GROUP BY source),
levels AS (
  SELECT *, 2 * s AS cap,
         ((sum(s) OVER ())::BIGINT * 1.5::DOUBLE - coalesce(sum(2 * s) OVER (ORDER BY 2 * s / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
         / sum(w) OVER (ORDER BY 2 * s / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lam
  FROM totals),
targets AS (
  SELECT source, s, CASE WHEN w * lam >= cap THEN cap::DOUBLE
         ELSE w * first_value(CASE WHEN w * lam < cap THEN lam END IGNORE NULLS) OVER (ORDER BY 2 * s / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) END AS target
  FROM levels),
plan AS (SELECT *, CASE WHEN s > 0 THEN floor(target / s) ELSE 0 END::BIGINT AS epochs FROM targets),
summed AS (
  SELECT d.*, p.s, p.target, p.epochs, p.target - p.epochs * p.s AS rest,
         sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id NULLS LAST, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS upto
  FROM (SELECT *, k AS k2 FROM docs) d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source),
ends AS (
  SELECT source, CASE WHEN min(abs(upto - rest)) < any_value(rest) THEN arg_min(upto, (abs(upto - rest), upto)) ELSE 0 END AS last
  FROM summed GROUP BY source)
SELECT doc_id, size, s AS source_size, target, (epochs + CASE WHEN upto <= last THEN 1 ELSE 0 END) * size AS taken
FROM summed JOIN ends ON summed.source IS NOT DISTINCT FROM ends.source
"""

OP9 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0)
SELECT query_id, rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s) WHERE rank <= 5
"""


OP10 = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (SELECT r, unnest(generate_series(1, len(w) - 34)) AS p FROM docs WHERE len(w) >= 35),
windows AS (SELECT r, p, array_to_string(w[p:p + 34], ' ') AS t FROM starts JOIN docs USING (r)),
again AS (SELECT r, p FROM windows WHERE t IN (SELECT t FROM windows GROUP BY t HAVING count(*) > 1)),
gone AS (SELECT DISTINCT r, unnest(generate_series(p, p + 34)) AS i FROM again),
lost AS (SELECT r, list(i) AS l FROM gone GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(l), 0)::BIGINT AS n_removed,
       sha256(coalesce(array_to_string(CASE WHEN l IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(l, i)) END, ' '), '')) AS kept_sha256
FROM docs LEFT JOIN lost USING (r)
"""


OP11 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS anchor_id, c.vec_id, q.label = c.label AS alike, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE alike QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER w::INT AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT alike AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY rank <= 5
"""

OP12 = r"""
WITH texts AS (
  SELECT d.*, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, '')), false) AS again
  FROM documents d),
known AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
docs AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         MAP {'A': len(w) < 200, 'B': 100 * len(list_distinct(w)) < 50 * len(w), 'C': 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * len(t),
          'D': regexp_matches(t, '[#$%&*|]'), 'E': again} AS f
  FROM texts LEFT JOIN known USING (doc_id)),
counted AS (SELECT part, good, toxic, f, count(*) AS n FROM docs GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS o FROM letters a JOIN letters b ON b.x <> a.x JOIN letters c ON c.x NOT IN (a.x, b.x)
  JOIN letters d ON d.x NOT IN (a.x, b.x, c.x) JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
places AS (SELECT o, unnest(generate_series(1, 5)) AS s FROM orders),
fails AS (  -- each kind of document at each place: whether it fails there, and whether it failed before
  SELECT part, good, toxic, n, o, s, f[substr(o, s, 1)] AS here,
         len(list_filter(range(1, s), lambda i: f[substr(o, i, 1)])) > 0 AS before,
         len(list_filter(map_values(f), lambda x: x)) AS all_fails
  FROM counted, places),
figures AS (
  SELECT part, o, s, sum(n) FILTER (NOT here AND NOT before) AS kept, sum(n) FILTER (here AND NOT before) AS removed, sum(n) FILTER (here AND before) AS redundant,
         sum(n) FILTER (here AND all_fails = 1) AS unique_fails, sum(n) FILTER (here AND NOT before AND good) AS good_lost, sum(n) FILTER (here AND NOT before AND toxic) AS toxic_lost
  FROM fails GROUP BY part, o, s)
SELECT part, o AS filter_order, s::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
       coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       sum(coalesce(removed, 0)) OVER (PARTITION BY part, substr(o, s, 1))::BIGINT AS shapley
FROM figures
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_exact_dedup": OP5, "op6_mixing": OP6, "op9_topk": OP9, "op10_substring": OP10, "op11_hard_negatives": OP11, "op12_filter_audit": OP12}
