"""Queries of the driver contract: every operator family on the standard tables, with SQL of the same meaning."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tesserae.functions import text
from tesserae.operators import browse, graph, lookup, profile, sync, synonyms
from tesserae.plans import compile, validate
from tesserae.streaming import drift

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
EVENT_TYPES = ("click", "view", "purchase")
PREFIXES = {"N": "https://example.org/nation/", "R": "https://example.org/region/"}


def query(sql: str | None = None):
    """Registers a query under its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = lambda spark, d: f(lambda t: spark.read.parquet(f"{d}/{t}.parquet"))
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _records(df: DataFrame, *columns: str) -> DataFrame:
    """Rows as JSON records; null members are left out."""
    return df.withColumn("json", F.to_json(F.struct(*columns)))


# --- validation ---------------------------------------------------------------------------------

ORDER = {
    "type": "object",
    "required": ["o_orderkey", "o_orderpriority"],
    "properties": {
        "o_orderpriority": {"type": "string", "enum": ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]},
        "o_orderstatus": {"type": "string", "pattern": "^[FO]$"},
        "o_totalprice": {"anyOf": [{"type": "number"}, {"type": "string", "enum": ["unknown"]}]},
    },
    "allOf": [
        {"if": {"properties": {"o_orderstatus": {"const": "F"}}, "required": ["o_orderstatus"]}, "then": {"properties": {"o_totalprice": {"maximum": 250000}}}},
        {"if": {"properties": {"o_orderpriority": {"not": {"anyOf": [{"const": "5-LOW"}]}}}, "required": ["o_orderpriority"]}, "then": {"properties": {"o_orderstatus": {}}, "required": ["o_orderstatus"]}},
    ],
}
BAD_ORDERS = """
  SELECT o_orderkey, 'enum' AS kind, 'o_orderpriority' AS field, NULL::INT AS rule FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')
  UNION ALL SELECT o_orderkey, 'pattern', 'o_orderstatus', NULL FROM orders WHERE NOT regexp_matches(o_orderstatus, '^[FO]$')
  UNION ALL SELECT o_orderkey, 'required', 'o_orderpriority', NULL FROM orders WHERE o_orderpriority IS NULL
  UNION ALL SELECT o_orderkey, 'maximum', 'o_totalprice', 0 FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 250000
  UNION ALL SELECT o_orderkey, 'required', 'o_orderstatus', 1 FROM orders WHERE o_orderstatus IS NULL AND o_orderpriority <> '5-LOW'"""


def _orders(t) -> DataFrame:
    return validate.validate(_records(t("orders"), "o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice"), ORDER)


@query(BAD_ORDERS)
def validate_records(t):
    """Every violation of every order record."""
    return validate.long_form(_orders(t), "o_orderkey")


@query(f"SELECT kind, field, rule, count(*) AS records FROM ({BAD_ORDERS}) GROUP BY ALL")
def validate_summary(t):
    return validate.summary(_orders(t))


@query("SELECT lang, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL GROUP BY lang")
def validate_required(t):
    bad = validate.validate_table(t("documents").select("doc_id", "lang").join(t("labels"), "doc_id", "left"), {"required": ["quality"]}).where("NOT valid")
    return bad.groupBy("lang").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')")
def validate_enum(t):
    bad = validate.validate_table(t("orders"), {"properties": {"o_orderpriority": ORDER["properties"]["o_orderpriority"]}})
    return bad.where("NOT valid").select("o_orderkey", "o_orderpriority")


@query("SELECT event_type, count_if(json_type(props, '$.k') IN ('UBIGINT', 'BIGINT'))::BIGINT AS integers, count_if(json_type(props, '$.k') IS NULL)::BIGINT AS absent, count(*) AS n FROM events GROUP BY event_type")
def validate_type_json(t):
    k = validate.get(F.try_parse_json("props"), "k")
    return t("events").withColumn("k", k).groupBy("event_type").agg(
        F.count_if(F.col("k").isNotNull() & validate.of_type(F.col("k"), "integer")).alias("integers"), F.count_if(F.col("k").isNull()).alias("absent"), F.count("*").alias("n")
    )


@query("SELECT page_id, url FROM pages WHERE NOT regexp_matches(url, '^https://[a-z0-9.]+/')")
def validate_pattern(t):
    bad = validate.validate(_records(t("pages"), "url"), {"properties": {"url": {"pattern": "^https://[a-z0-9.]+/"}}})
    return bad.where("NOT valid").select("page_id", "url")


@query("SELECT count(*) AS n, count_if(quality IS NOT NULL AND toxic IS NULL)::BIGINT AS violations FROM documents LEFT JOIN labels USING (doc_id)")
def validate_conditional_presence(t):
    rule = {"if": {"properties": {"quality": {}}, "required": ["quality"]}, "then": {"properties": {"toxic": {}}, "required": ["toxic"]}}
    rows = t("documents").select("doc_id").join(t("labels"), "doc_id", "left")
    return validate.validate_table(rows, rule).agg(F.count("*").alias("n"), F.count_if(~F.col("valid")).alias("violations"))


@query("""
SELECT field, count(*) AS n FROM (
  SELECT 'l_discount' AS field FROM lineitem WHERE l_returnflag = 'R' AND NOT l_discount <= 0.08
  UNION ALL SELECT 'l_quantity' FROM lineitem WHERE l_returnflag = 'R' AND NOT l_quantity >= 3
  UNION ALL SELECT 'l_linestatus' FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus <> 'F') GROUP BY field""")
def validate_conditional_required_set(t):
    """One violation per condition that a returned line misses."""
    then = {"properties": {"l_discount": {"maximum": 0.08}, "l_quantity": {"minimum": 3}, "l_linestatus": {"const": "F"}}}
    rule = {"if": {"properties": {"l_returnflag": {"const": "R"}}, "required": ["l_returnflag"]}, "then": then}
    return validate.long_form(validate.validate_table(t("lineitem"), rule)).groupBy("field").agg(F.count("*").alias("n"))


@query("SELECT p_partkey, p_retailprice FROM part WHERE p_brand = 'Brand#11' AND p_retailprice > 950")
def validate_conditional_maximum(t):
    rule = {"if": {"properties": {"p_brand": {"const": "Brand#11"}}, "required": ["p_brand"]}, "then": {"properties": {"p_retailprice": {"maximum": 950}}}}
    return validate.validate_table(t("part"), rule).where("NOT valid").select("p_partkey", "p_retailprice")


@query("""
SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id)
WHERE coalesce(quality = 0, true) AND coalesce(toxic <> 1, false)""")
def validate_vacuous_overlay(t):
    """An absent quality meets the condition; an absent toxic meets what follows."""
    rule = {"if": {"properties": {"quality": {"const": 0}}}, "then": {"properties": {"toxic": {"const": 1}}}}
    rows = _records(t("documents").select("doc_id").join(t("labels"), "doc_id", "left"), "quality", "toxic")
    return validate.validate(rows, rule).where("NOT valid").select("doc_id")


# --- hierarchies and vocabularies ---------------------------------------------------------------


def _tree(t) -> DataFrame:
    return t("supplier").select(F.col("s_suppkey").alias("name"), F.when(F.col("s_suppkey") > 1, F.floor(F.col("s_suppkey") / 2)).alias("parent"), "s_nationkey")


_TREE = """WITH RECURSIVE t AS (SELECT s_suppkey AS name, CASE WHEN s_suppkey > 1 THEN s_suppkey // 2 END AS parent, s_nationkey FROM supplier),
up(name, ancestor, depth) AS (SELECT name, name, 0 FROM t UNION ALL SELECT up.name, t.parent, up.depth + 1 FROM up JOIN t ON up.ancestor = t.name WHERE t.parent IS NOT NULL)"""


@query(f"{_TREE} SELECT name, ancestor, depth FROM up")
def hierarchy_closure(t):
    return compile.closure(_tree(t))


@query(f"""{_TREE}, s AS (SELECT name AS ancestor, s_nationkey AS setting FROM t WHERE s_nationkey % 3 = 0)
SELECT name, ancestor, depth, setting FROM (SELECT up.*, setting, row_number() OVER (PARTITION BY name ORDER BY depth) AS r FROM up JOIN s USING (ancestor)) WHERE r = 1""")
def inherit_resolve(t):
    """Each node's setting, from the nearest node above that has one."""
    tree = _tree(t)
    return compile.nearest(compile.closure(tree), tree.where("s_nationkey % 3 = 0").select(F.col("name").alias("ancestor"), F.col("s_nationkey").alias("setting"))).select("name", "ancestor", "depth", "setting")


@query("""
WITH a AS (SELECT list_distinct(list(DISTINCT o_orderpriority)) AS x FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT list(DISTINCT o_orderpriority) AS x FROM orders WHERE o_orderstatus = 'P')
SELECT unnest(list_sort(list_distinct(list_concat(a.x, b.x)))) AS label FROM a, b""")
def anyof_union(t):
    """Union of two vocabularies, first ones first."""
    of = lambda s: t("orders").where(F.col("o_orderstatus") == s).agg(F.array_sort(F.collect_set("o_orderpriority")).alias(s))
    return of("F").crossJoin(of("P")).select(F.explode(synonyms.merged_aliases(F.col("F"), F.col("P"))).alias("label"))


@query("SELECT r_name AS parent, list_sort(list(n_name)) AS children, count(*) AS n FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name")
def children_list(t):
    return browse.children(t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")), "r_name", "n_name")


@query("SELECT p_type AS name, count(*) AS size FROM part GROUP BY p_type ORDER BY size DESC, name LIMIT 5")
def enum_sizes_top5(t):
    return browse.largest(t("part"), "p_type", 5)


# --- profiling ----------------------------------------------------------------------------------


@query("""
SELECT field, value, count(*) AS n FROM (
  SELECT 'event_type' AS field, trim(event_type) AS value FROM events UNION ALL SELECT 'user_id', user_id::VARCHAR FROM events)
WHERE value <> '' AND NOT (field = 'event_type' AND value IN ('click', 'view', 'purchase')) GROUP BY ALL HAVING count(*) >= 2""")
def profile_unmatched(t):
    events = t("events")
    allowed = events.sparkSession.createDataFrame([("event_type", v) for v in EVENT_TYPES], "field string, value string")
    return profile.unmatched(profile.annotations(events, "event_id", ["event_type", "user_id"]), allowed)


_FIELDS = "SELECT 'lang' AS field, lang AS value FROM documents UNION ALL SELECT 'source', source FROM documents"


@query(f"SELECT field, count(DISTINCT value) AS n_distinct FROM ({_FIELDS}) GROUP BY field HAVING count(DISTINCT value) >= 4")
def profile_distinct_facets(t):
    return profile.distinct_facets(profile.annotations(t("documents"), "doc_id", ["lang", "source"]), 4)


@query(f"""
WITH c AS (SELECT field, value, count(*) AS n FROM ({_FIELDS}) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY field ORDER BY n DESC, value)::INT AS rank, count(*) OVER (PARTITION BY field) AS size FROM c)
SELECT field, value, n, rank, greatest(size - 7, 0)::BIGINT AS more FROM r WHERE rank <= 7""")
def profile_topk_per_field(t):
    values = profile.annotations(t("documents"), "doc_id", ["lang", "source"])
    return profile.top_per_field(values.groupBy("field", "value").agg(F.count("*").alias("n")), 7)


@query(f"""
WITH c AS (SELECT field, value, count(*) AS n FROM ({_FIELDS}) GROUP BY ALL HAVING count(*) >= 2 AND value <> 'en')
SELECT field, count(*) AS values_found, sum(n)::BIGINT AS n FROM c GROUP BY field""")
def profile_suggestions(t):
    """Suggested values per field, read back from their JSON maps."""
    docs = t("documents")
    allowed = docs.sparkSession.createDataFrame([("lang", "en")], "field string, value string")
    maps = profile.suggestions(profile.unmatched(profile.annotations(docs, "doc_id", ["lang", "source"]), allowed))
    counts = F.map_values(F.from_json("values", "map<string,bigint>"))
    return maps.select("field", F.size(counts).cast("long").alias("values_found"), F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))


@query("SELECT 'text' AS column, max(length(text))::INT AS longest, count_if(length(text) > 80)::BIGINT AS over FROM documents UNION ALL SELECT 'source', max(length(source))::INT, count_if(length(source) > 80)::BIGINT FROM documents")
def string_length_limits(t):
    return browse.lengths(t("documents"), "text", "source")


@query("""
SELECT name, bytes, round(bytes / 64000.0::DOUBLE * 100, 1) AS percent, CASE WHEN bytes > 64000 THEN 'over' WHEN bytes > 57600 THEN 'near' ELSE 'ok' END AS status
FROM (SELECT p_type AS name, (count(DISTINCT p_brand) * 320 + count(DISTINCT p_size) * 6400 + 14554)::BIGINT AS bytes FROM part GROUP BY p_type)""")
def row_size_budget(t):
    return browse.row_budget(t("part").groupBy(F.col("p_type").alias("name")).agg(F.countDistinct("p_brand").alias("texts"), F.countDistinct("p_size").alias("lists")))


# --- synchronisation ----------------------------------------------------------------------------


@query("""
SELECT s_suppkey, s_name, n_name, CASE WHEN contains(lower(n_name), '_1') THEN 'animal' WHEN contains(lower(n_name), '_2') THEN 'cell' ELSE 'other' END AS route, 'rrid:' || n_name AS meaning
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""")
def sync_left_join_links(t):
    nation = t("nation").withColumnRenamed("n_nationkey", "s_nationkey")
    route = sync.routed(F.col("n_name"), [("_1", "animal"), ("_2", "cell")], "other")
    return t("supplier").join(nation, "s_nationkey", "left").select("s_suppkey", "s_name", "n_name", route.alias("route"), text.rrid(F.col("n_name")).alias("meaning"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def sync_anti_manual(t):
    return sync.without(t("customer"), t("orders").where("o_orderpriority = '1-URGENT'").withColumnRenamed("o_custkey", "c_custkey"), "c_custkey").select("c_custkey", "c_name")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def sync_semi(t):
    return sync.within(t("customer"), t("orders").where("o_totalprice > 300000").withColumnRenamed("o_custkey", "c_custkey"), "c_custkey").select("c_custkey", "c_name")


@query("""
WITH a AS (SELECT p_partkey, CASE WHEN p_partkey % 4 > 0 THEN p_name END AS link FROM part WHERE p_partkey % 3 > 0), b AS (SELECT p_partkey, 'https://example.org/' || p_partkey AS link FROM part WHERE p_partkey % 5 > 0)
SELECT coalesce(a.p_partkey, b.p_partkey) AS p_partkey, coalesce(a.link, b.link) AS link,
  CASE WHEN a.p_partkey IS NULL THEN 'added' WHEN a.link IS NULL AND b.link IS NOT NULL THEN 'filled' ELSE 'kept' END AS origin
FROM a FULL JOIN b ON a.p_partkey = b.p_partkey""")
def link_full_outer_upsert(t):
    part = t("part")
    a = part.where("p_partkey % 3 > 0").select("p_partkey", F.when(F.col("p_partkey") % 4 > 0, F.col("p_name")).alias("link"))
    b = part.where("p_partkey % 5 > 0").select("p_partkey", F.concat(F.lit("https://example.org/"), F.col("p_partkey").cast("string")).alias("link"))
    return sync.merged_links(a, b, "p_partkey", "link")


@query("SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def upsert_latest(t):
    return sync.latest(t("events"), ["user_id", "event_type"], F.desc("ts"), F.desc("event_id")).select("user_id", "event_type", "event_id", "value")


@query("SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 7 = 0")
def upsert_by_keys(t):
    customer = t("customer").select("c_custkey", "c_acctbal")
    return sync.upserted(customer.where("c_custkey % 2 = 0"), customer.where("c_custkey % 7 = 0").withColumn("c_acctbal", F.lit(0.0)), ["c_custkey"])


@query("SELECT page_id, CASE WHEN contains(url, 'example.org') THEN 'org' WHEN contains(url, 'https') THEN 'secure' WHEN contains(url, 'http') THEN 'plain' END AS target FROM pages")
def ontology_substring_route(t):
    pages = t("pages")
    patterns = pages.sparkSession.createDataFrame([(1, "example.org", "org"), (2, "https", "secure"), (3, "http", "plain")], "ord int, pattern string, target string")
    return sync.first_route(pages, "url", patterns).select("page_id", "target")


@query("SELECT n_nationkey, 'https://example.org/nation/' || n_name || ':x' AS address FROM nation WHERE n_nationkey % 2 = 0 UNION ALL SELECT n_nationkey, 'Z:' || n_name || ':x' FROM nation WHERE n_nationkey % 2 = 1")
def curie_expand(t):
    curie = F.concat(F.when(F.col("n_nationkey") % 2 == 0, "N:").otherwise("Z:"), F.col("n_name"), F.lit(":x"))
    return t("nation").select("n_nationkey", text.expand_curie(curie, PREFIXES).alias("address"))


@query("SELECT page_id, regexp_extract(url, '([^#/]*)$', 1) AS local, CASE WHEN starts_with(url, 'https://') THEN 'web:' || substr(url, 9) ELSE url END AS short FROM pages")
def localname_shorten(t):
    return t("pages").select("page_id", text.local_name(F.col("url")).alias("local"), text.shortened(F.col("url"), {"web": "https://"}).alias("short"))


@query("""
SELECT p_brand, arg_max(v, (major, minor)) AS latest, count(*) AS versions
FROM (SELECT p_brand, p_size AS major, p_partkey AS minor, p_size || '.' || p_partkey || '.0' AS v FROM part) GROUP BY p_brand""")
def latest_version(t):
    versions = t("part").select("p_brand", F.concat_ws(".", F.col("p_size").cast("string"), F.col("p_partkey").cast("string"), F.lit("0")).alias("version"))
    return sync.latest_version(versions, "p_brand", text.version(F.col("version")))


@query("SELECT p_partkey, regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') AS plain, regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') = regexp_replace(lower(p_brand), '[^a-z0-9]', '', 'g') AS same FROM part")
def normalize_casefold(t):
    return t("part").select("p_partkey", text.normalized(F.col("p_name")).alias("plain"), text.same_but_for_case(F.col("p_name"), F.col("p_brand")).alias("same"))


@query("SELECT n_nationkey, n_name || '; ' || n_regionkey AS packed FROM nation")
def synonym_split_join(t):
    packed = F.concat(F.col("n_name"), F.lit(" ;; "), F.col("n_regionkey").cast("string"), F.lit(" ; "))
    return t("nation").select("n_nationkey", text.joined(text.split_packed(packed)).alias("packed"))


@query()
def synonym_filter(t):
    """Greedy filter of every part's name variants."""
    name = F.col("p_name")
    variants = F.array(name, F.upper(name), F.concat(name, F.lit("s")), F.reverse(name), F.concat(F.reverse(name), F.lit("-")), F.col("p_type"))
    return synonyms.filter_synonyms(t("part").select("p_partkey", name.alias("term"), variants.alias("synonyms")))


@query("SELECT source, max(cnt)::BIGINT AS most FROM (SELECT source, lang, count(*) AS cnt FROM documents WHERE contains(lower(text), 'tion') GROUP BY ALL) GROUP BY source")
def search_contains(t):
    found = browse.contains(t("documents"), "Tion", "text").groupBy("source", "lang").agg(F.count("*").alias("cnt"))
    return found.groupBy("source").agg(F.max("cnt").alias("most"))


_TOKENS = "SELECT doc_id, ' ' || array_to_string(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> ''), ' ') || ' ' AS line FROM documents"


def _expansion(kind: str, query: str):
    def run(t):
        docs = t("documents")
        rules = docs.sparkSession.createDataFrame([(kind, ["license", "version 3", "rights reserved"])], "kind string, terms array<string>")
        return synonyms.search(docs, "text", query, rules).select("doc_id")

    return run


for _kind, _name, _phrases in (("EQUIVALENT", "version 3", ("license", "version 3", "rights reserved")), ("REPLACE", "license", ("version 3", "rights reserved")), ("KEEP", "license", ("license", "version 3", "rights reserved"))):
    _f = _expansion(_kind, _name)
    _f.__name__ = f"search_expand_{_kind.lower()}"
    query(f"SELECT doc_id FROM ({_TOKENS}) WHERE " + " OR ".join(f"contains(line, ' {p} ')" for p in _phrases))(_f)


@query("""
SELECT o_orderkey, o_orderpriority, CASE o_orderpriority WHEN '1-URGENT' THEN 'now' WHEN '2-HIGH' THEN 'soon' ELSE o_orderpriority END AS o_orderpriority_mapped, o_orderpriority = '1-URGENT' AS ambiguous FROM orders""")
def concept_map_translate(t):
    orders = t("orders").select("o_orderkey", "o_orderpriority")
    terms = orders.sparkSession.createDataFrame([(1, "1-URGENT", "now"), (2, "1-URGENT", "at once"), (3, "2-HIGH", "soon")], "ord int, source string, target string")
    return sync.translated(orders, "o_orderpriority", terms)


# --- graph --------------------------------------------------------------------------------------

_CUSTOMERS = """SELECT 'c' || c_custkey AS s, 'nation' AS p, 'n' || c_nationkey AS o FROM customer UNION ALL SELECT 'c' || c_custkey, 'segment', c_mktsegment FROM customer"""
_GRAPH = f"""{_CUSTOMERS}
UNION ALL SELECT 'n' || n_nationkey, 'region', 'r' || n_regionkey FROM nation UNION ALL SELECT 'n' || n_nationkey, 'label', n_name FROM nation
UNION ALL SELECT 'r' || r_regionkey, 'label', r_name FROM region UNION ALL SELECT 'o' || o_orderkey, 'customer', 'c' || o_custkey FROM orders UNION ALL SELECT 'o' || o_orderkey, 'status', o_orderstatus FROM orders"""


def _iri(letter: str, column: str):
    return F.concat(F.lit(letter), F.col(column).cast("string"))


def _graph(t) -> DataFrame:
    parts = [
        graph.triples(t("customer"), _iri("c", "c_custkey"), {"nation": _iri("n", "c_nationkey"), "segment": F.col("c_mktsegment")}, {"nation": "iri"}),
        graph.triples(t("nation"), _iri("n", "n_nationkey"), {"region": _iri("r", "n_regionkey"), "label": F.col("n_name")}, {"region": "iri"}),
        graph.triples(t("region"), _iri("r", "r_regionkey"), {"label": F.col("r_name")}),
        graph.triples(t("orders"), _iri("o", "o_orderkey"), {"customer": _iri("c", "o_custkey"), "status": F.col("o_orderstatus")}, {"customer": "iri"}),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query(f"WITH g AS ({_GRAPH}) SELECT a.s AS c, b.o AS region FROM g a JOIN g b ON a.o = b.s AND b.p = 'region' WHERE a.p = 'nation'")
def bgp_join(t):
    return graph.basic(_graph(t), ("?c", "nation", "?n"), ("?n", "region", "?region")).select("c", "region")


@query(f"WITH g AS ({_GRAPH}) SELECT a.s AS n, a.o AS label, count(b.s) AS customers FROM g a LEFT JOIN g b ON b.o = a.s AND b.p = 'nation' WHERE a.p = 'label' GROUP BY ALL")
def bgp_optional(t):
    g = _graph(t)
    return graph.optional(graph.pattern(g, "?n", "label", "?label"), graph.pattern(g, "?c", "nation", "?n")).groupBy("n", "label").agg(F.count("c").alias("customers"))


@query(f"WITH g AS ({_GRAPH}) SELECT s AS c, o AS segment FROM g WHERE p = 'segment' AND s NOT IN (SELECT a.o FROM g a JOIN g b ON a.s = b.s WHERE a.p = 'customer' AND b.p = 'status' AND b.o = 'P')")
def bgp_not_exists(t):
    g = _graph(t)
    return graph.not_exists(graph.pattern(g, "?c", "segment", "?segment"), graph.basic(g, ("?o", "customer", "?c"), ("?o", "status", "P")).select("c"))


@query(f"WITH g AS ({_GRAPH}) SELECT p, count(*) AS n FROM g GROUP BY p ORDER BY n DESC LIMIT 100")
def bgp_group_count(t):
    return _graph(t).groupBy("p").agg(F.count("*").alias("n")).orderBy(F.desc("n")).limit(100)


@query(f"WITH g AS ({_GRAPH}) SELECT s, CASE WHEN o = 'F' THEN 'final' ELSE 'open' END AS state, regexp_replace(s, '^.', '') AS id FROM g WHERE p = 'status'")
def bgp_bind_if(t):
    return graph.pattern(_graph(t), "?s", "status", "?o").select("s", F.when(F.col("o") == "F", "final").otherwise("open").alias("state"), F.regexp_replace("s", "^.", "").alias("id"))


@query(f"WITH RECURSIVE g AS ({_GRAPH}), e AS (SELECT s, o FROM g WHERE p IN ('nation', 'region')), r AS (SELECT s, o FROM e UNION SELECT r.s, e.o FROM r JOIN e ON r.o = e.s) SELECT s, o FROM r")
def bgp_path_plus(t):
    up = _graph(t).where("p IN ('nation', 'region')").withColumn("p", F.lit("above"))
    return graph.path_plus(up, "above")


@query(f"WITH g AS ({_GRAPH}) SELECT count(*) > 0 AS answer FROM g WHERE p = 'status' AND o = 'P'")
def bgp_ask(t):
    return graph.ask(graph.pattern(_graph(t), "?s", "status", "P"))


@query(f"SELECT s, p, o FROM ({_GRAPH}) WHERE p IN ('label', 'region') UNION SELECT 'r99', 'label', 'NOWHERE' UNION SELECT 'n99', 'region', 'r99'")
def bgp_construct_insert(t):
    g = _graph(t).where("p IN ('label', 'region')").select("s", "p", "o")
    return g.union(g.sparkSession.createDataFrame([("r99", "label", "NOWHERE"), ("n99", "region", "r99")], g.schema)).distinct()


def _snapshots(t) -> tuple[DataFrame, DataFrame]:
    orders = t("orders")
    facts = lambda df: graph.triples(df, _iri("o", "o_orderkey"), {"status": F.col("o_orderstatus"), "priority": F.col("o_orderpriority")})
    later = orders.where("o_orderkey % 11 > 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 5 == 0, "X").otherwise(F.col("o_orderstatus")))
    return facts(orders.where("o_orderkey % 7 > 0")), facts(later)


_SNAPSHOTS = """before AS (SELECT 'o' || o_orderkey AS s, unnest(['status', 'priority']) AS p, unnest([o_orderstatus, o_orderpriority]) AS o FROM orders WHERE o_orderkey % 7 > 0),
later AS (SELECT 'o' || o_orderkey AS s, unnest(['status', 'priority']) AS p, unnest([CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END, o_orderpriority]) AS o FROM orders WHERE o_orderkey % 11 > 0)"""


@query(f"WITH {_SNAPSHOTS} SELECT DISTINCT s, 'added' AS change FROM later WHERE s NOT IN (SELECT s FROM before) UNION ALL SELECT DISTINCT s, 'removed' FROM before WHERE s NOT IN (SELECT s FROM later)")
def graph_added_removed(t):
    return graph.added_removed(*_snapshots(t))


@query(f"""WITH {_SNAPSHOTS} SELECT s, p, o, 'added' AS change FROM (SELECT * FROM later EXCEPT SELECT * FROM before) WHERE s IN (SELECT s FROM before)
UNION ALL SELECT s, p, o, 'removed' FROM (SELECT * FROM before EXCEPT SELECT * FROM later) WHERE s IN (SELECT s FROM later)""")
def graph_modified(t):
    return graph.modified(*_snapshots(t))


@query(f"""WITH {_SNAPSHOTS}, a AS (SELECT s, string_agg(p || '=' || o, '|' ORDER BY p || '=' || o) AS signature FROM before GROUP BY s), b AS (SELECT s, string_agg(p || '=' || o, '|' ORDER BY p || '=' || o) AS signature FROM later GROUP BY s)
SELECT signature, count(*) AS n FROM b WHERE signature NOT IN (SELECT signature FROM a) GROUP BY signature""")
def graph_signature_diff(t):
    """Kinds of subjects that only the later snapshot has, told apart by what they say."""
    before, later = (graph.signatures(g) for g in _snapshots(t))
    return later.join(before.select("signature").distinct(), "signature", "left_anti").groupBy("signature").agg(F.count("*").alias("n"))


@query(f"WITH g AS ({_GRAPH}), k AS (SELECT s, min(CASE WHEN p = 'segment' THEN 0 WHEN p = 'label' THEN 1 ELSE 2 END) AS k FROM g GROUP BY s) SELECT ['customer', 'place', 'other'][k + 1] AS kind, count(*) AS n FROM k GROUP BY k")
def graph_kinds(t):
    return graph.kinds(_graph(t), {"customer": F.col("p") == "segment", "place": F.col("p") == "label"})


# --- browsing -----------------------------------------------------------------------------------


@query("SELECT p_partkey, p_name FROM part WHERE p_brand IN ('Brand#11', 'Brand#12') AND p_size = 10")
def facet_filter(t):
    return browse.facets(t("part"), p_brand=["Brand#11", "Brand#12"], p_size=10).select("p_partkey", "p_name")


@query("SELECT r_name FROM region WHERE r_regionkey IN (SELECT n_regionkey FROM nation WHERE contains(lower(n_name), '_1'))")
def nested_any_match(t):
    below = browse.children(t("nation"), "n_regionkey", "n_name").withColumnRenamed("parent", "r_regionkey")
    return browse.any_nested(t("region").join(below, "r_regionkey"), "children", "_1").select("r_name")


@query("SELECT conv_id, turn, len(string_split(text, ','))::INT AS width FROM conversations WHERE len(string_split(text, ',')) <> 1")
def csv_width_lint(t):
    return browse.odd_widths(t("conversations"), 1, "text").select("conv_id", "turn", "width")


@query("SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier")
def schema_fill_union(t):
    a = t("customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return a.unionByName(t("supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")), allowMissingColumns=True)


@query("SELECT type, count(*) AS n FROM (SELECT 'nation' AS type, n_name AS x FROM nation UNION ALL SELECT 'part', p_name FROM part UNION ALL SELECT 'customer', c_name FROM customer) WHERE contains(lower(x), 'er') GROUP BY type")
def search_index(t):
    both = browse.index(("nation", t("nation"), "n_nationkey", "n_name"), ("part", t("part"), "p_partkey", "p_name"), ("customer", t("customer"), "c_custkey", "c_name"))
    return browse.contains(both, "ER", "text").groupBy("type").agg(F.count("*").alias("n"))


@query("""
SELECT date_trunc('hour', ts) AS start, event_type AS value, count(*) AS n, count_if(event_type NOT IN ('click', 'view', 'purchase'))::BIGINT AS unknown FROM events GROUP BY ALL""")
def annotation_drift(t):
    """An extension: values outside the vocabulary per hour; the same columns run on a stream."""
    events = t("events").withColumn("ts", F.col("ts").cast("timestamp"))
    found = drift.drift(events, "ts", "event_type", F.col("event_type").isin(*EVENT_TYPES))
    return found.withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("SELECT p_partkey, p_type, p_retailprice, rank FROM (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY p_retailprice DESC, p_partkey)::INT AS rank FROM part) WHERE rank <= 3")
def top_parts(t):
    w = W.partitionBy("p_type").orderBy(F.desc("p_retailprice"), "p_partkey")
    return t("part").withColumn("rank", F.row_number().over(w)).where("rank <= 3").select("p_partkey", "p_type", "p_retailprice", "rank")


# --- lookups ------------------------------------------------------------------------------------


@query(f"""{_TREE}, r AS (SELECT name AS ancestor FROM t WHERE s_nationkey % 2 = 0)
SELECT t.name, x.root FROM t LEFT JOIN (SELECT up.name, arg_min(ancestor, depth) AS root FROM up JOIN r USING (ancestor) GROUP BY up.name) x USING (name)""")
def lookup_root_climb(t):
    """Each node's nearest ancestor of a kind."""
    return lookup.root_of(_tree(t).withColumn("type", F.when(F.col("s_nationkey") % 2 == 0, "Project").otherwise("Folder")), "Project")


@query("SELECT p_brand AS property, arg_min(p_type, (p_partkey, p_type)) AS class FROM part GROUP BY p_brand")
def lookup_first_use(t):
    return lookup.first_use(t("part").select(F.col("p_type").alias("class"), F.col("p_partkey").alias("ord"), F.col("p_brand").alias("property")))


@query("SELECT p_brand, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS values FROM part GROUP BY p_brand")
def lookup_string_lists(t):
    return lookup.string_lists(t("part"), "p_brand", "p_type")


@query("SELECT o_orderstatus, n, round(n / sum(n) OVER () * 100, 1) AS percent FROM (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY ALL)")
def lookup_tally(t):
    return lookup.tally(t("orders"), "o_orderstatus")


@query("""
WITH a AS (SELECT n_name AS slot, list_sort(list(DISTINCT c_mktsegment)) AS x FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 3 > 0 GROUP BY ALL),
b AS (SELECT n_name AS slot, list_sort(list(DISTINCT c_mktsegment)) AS y FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 2 > 0 GROUP BY ALL)
SELECT slot, list_filter(y, lambda v: NOT list_contains(x, v)) AS added, list_filter(x, lambda v: NOT list_contains(y, v)) AS removed FROM a JOIN b USING (slot) WHERE x <> y""")
def lookup_range_changes(t):
    rows = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("slot"), F.col("c_mktsegment").alias("range"))
    return lookup.range_changes(rows.where("c_custkey % 3 > 0"), rows.where("c_custkey % 2 > 0"))


@query("SELECT s_suppkey, 'https://example.org/id/' || CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey::VARCHAR ELSE s_name END AS address FROM supplier WHERE s_nationkey IN (1, 2, 3)")
def lookup_scan_address(t):
    rows = lookup.scan(t("supplier"), ["s_suppkey", "s_name"], s_nationkey=[1, 2, 3])
    id = F.when(F.col("s_suppkey") % 3 > 0, F.col("s_name")).otherwise(F.lit(" "))
    return rows.select("s_suppkey", lookup.detail_address("https://example.org/id/", id, F.col("s_suppkey")).alias("address"))
