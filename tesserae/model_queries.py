"""Queries on a data model that the standard tables stand for (suppliers as a class tree, nations as slots, regions as
vocabularies), and on side tables: what has no data of its own in the other queries, with SQL of the same meaning."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tesserae.functions import text
from tesserae.operators import browse, graph, lint, lookup, postings, profile, sync, synonyms
from tesserae.plans import compile, rules, validate
from tesserae.queries import BAD_ORDERS, ORDER, SQL, query
from tesserae.sources import model, turtle

# --- the model ------------------------------------------------------------------------------------


def _item(kind: str, name, key, ord, body, file: str = "model.yaml"):
    return [F.lit(kind).alias("kind"), name.alias("name"), key.cast("string").alias("key"), ord.cast("int").alias("ord"), body.alias("body"), F.lit(file).alias("file")]


def _named(letter: str, c):
    return F.concat(F.lit(letter), c.cast("string"))


def _model(t) -> DataFrame:
    """Class C{k} under C{k // 2}, abstract where k % 4 = 0, with slots p{k % 25} and p{(k + 7) % 25}; every sixth refines its first
    slot, every ninth has a rule. Slot p{n}: vocabulary, number or text; vocabulary E{r} has the nations of a region."""
    k, none = F.col("s_suppkey"), F.lit(None).cast("string")
    sup, nat, reg = t("supplier"), t("nation"), t("region")
    n, r = F.col("n_nationkey"), F.col("n_regionkey")
    label = lambda: F.to_json(F.struct(F.array(F.col("s_name")).alias("assay"), F.array(F.lit("z"), F.lit("a")).alias("dataType")))
    body = F.to_json(F.struct(F.when(k > 1, _named("C", F.floor(k / 2))).alias("is_a"), (k % 4 == 0).alias("abstract"), F.concat(F.col("s_name"), F.lit(". More.")).alias("description"), F.struct(F.when(k % 3 > 0, label()).alias("templateFor")).alias("annotations")))
    several = F.when(n % 4 == 3, F.array(F.struct(_named("E", r).alias("range")), F.struct(_named("E", (r + 1) % 5).alias("range"))))
    slot = F.to_json(F.struct(F.when(n % 4 == 0, _named("E", r)).when(n % 4 == 1, "integer").when(n % 4 == 2, "string").alias("range"), several.alias("any_of"), (n % 5 == 0).alias("multivalued"), (n % 3 == 0).alias("required")))
    rule = F.to_json(F.struct(F.struct(F.array(_named("p", k % 25)).alias("required")).alias("if"), F.struct(F.array(_named("p", (k + 7) % 25)).alias("required")).alias("then")))
    parts = [
        sup.select(*_item("class", _named("C", k), none, k, body)),
        sup.select(*_item("class_slot", _named("C", k), _named("p", k % 25), F.lit(0), F.lit("{}"))),
        sup.select(*_item("class_slot", _named("C", k), _named("p", (k + 7) % 25), F.lit(1), F.lit("{}"))),
        sup.where("s_suppkey % 6 = 0").select(*_item("usage", _named("C", k), _named("p", k % 25), F.lit(0), F.lit('{"required": true, "range": "E0"}'))),
        sup.where("s_suppkey % 9 = 0").select(*_item("rule", _named("C", k), none, F.lit(0), rule)),
        nat.select(*_item("slot", _named("p", n), none, n, slot)),
        reg.select(*_item("enum", _named("E", F.col("r_regionkey")), none, F.col("r_regionkey"), F.lit("{}"))),
        nat.select(*_item("value", _named("E", r), F.col("n_name"), n, F.to_json(F.struct(F.lower("n_name").alias("description"), F.col("n_name").alias("aliases"))))),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_UP = """WITH RECURSIVE t AS (SELECT s_suppkey AS k, s_name, CASE WHEN s_suppkey > 1 THEN s_suppkey // 2 END AS parent FROM supplier),
up(k, a, depth) AS (SELECT k, k, 0 FROM t UNION ALL SELECT up.k, t.parent, up.depth + 1 FROM up JOIN t ON up.a = t.k WHERE t.parent IS NOT NULL),
own AS (SELECT k AS a, k % 25 AS n, 0 AS ord FROM t UNION ALL SELECT k, (k + 7) % 25, 1 FROM t),
props AS (SELECT up.k, own.n, min((depth, ord)) AS o FROM up JOIN own USING (a) WHERE up.k % 4 > 0 GROUP BY ALL),
uses AS (SELECT up.k, a % 25 AS n, count(*) AS c FROM up WHERE a % 6 = 0 GROUP BY ALL),
full_props AS (SELECT p.k, p.n, p.o, c IS NOT NULL AS used, c IS NOT NULL OR p.n % 3 = 0 AS required, p.n % 5 = 0 AS many, nations.r FROM props p LEFT JOIN uses USING (k, n) JOIN (SELECT n_nationkey AS n, n_regionkey AS r FROM nation) nations USING (n)),
sizes AS (SELECT n_regionkey AS r, count(*) AS m FROM nation GROUP BY ALL)"""


@query(f"""{_UP} SELECT 'C' || k AS class, 'p' || n AS property, o[1]::INT AS depth, required,
  CASE WHEN used THEN 'E0' WHEN n % 4 = 0 THEN 'E' || r WHEN n % 4 = 1 THEN 'integer' WHEN n % 4 = 2 THEN 'string' END AS range, CASE WHEN NOT used AND n % 4 = 3 THEN 2 ELSE 0 END AS branches
FROM full_props""")
def model_properties(t):
    """Properties of every concrete class after inheritance and refinement; a refinement drops inherited branches."""
    d = F.col("def")
    branches = F.coalesce(F.size(F.coalesce(d["any_of"], F.array().cast("array<struct<range:string>>"))), F.lit(0))
    return compile.properties(_model(t)).select("class", "property", F.col("order.depth").cast("int").alias("depth"), d["required"].alias("required"), d["range"].alias("range"), branches.alias("branches"))


@query(f"""{_UP} SELECT 'C' || k AS class, 'p' || n AS property, required, CASE WHEN many THEN 'array' WHEN NOT used AND n % 4 = 1 THEN 'integer' ELSE 'string' END AS type,
  CASE WHEN used THEN z.m WHEN n % 4 = 0 THEN s.m WHEN n % 4 = 3 THEN s.m + s2.m END::INT AS labels
FROM full_props JOIN sizes s USING (r) JOIN sizes s2 ON s2.r = (full_props.r + 1) % 5 JOIN sizes z ON z.r = 0""")
def model_fields(t):
    """Compiled property schemas: their type, and how many labels of one or two vocabularies they take."""
    labels = F.coalesce(F.get_json_object("schema", "$.enum"), F.get_json_object("schema", "$.items.enum"))
    return compile.fields(_model(t)).select("class", "property", "required", F.get_json_object("schema", "$.type").alias("type"), F.when(labels.isNotNull(), F.json_array_length(labels)).alias("labels"))


@query(f"{_UP} SELECT 'C' || k AS class, string_agg('p' || n, ',' ORDER BY o, n) AS required FROM full_props WHERE required GROUP BY k")
def model_required_order(t):
    """`required` of a compiled schema: nearest class first, then its own order."""
    listed = F.from_json(F.get_json_object("json", "$.required"), "array<string>")
    return compile.schemas(_model(t)).where(listed.isNotNull()).select("class", F.array_join(listed, ",").alias("required"))


@query(f"""{_UP} SELECT 'C' || k AS class, count(*)::INT AS rules, 'p' || (arg_min(a, depth) % 25) AS first FROM up WHERE a % 9 = 0 GROUP BY k""")
def model_rules(t):
    """Rules of a class and its ancestors, own ones first."""
    return compile.rules(_model(t)).select("class", F.size("rules").alias("rules"), F.get_json_object(F.col("rules")[0], "$.if.required[0]").alias("first"))


@query("""SELECT 'C' || s_suppkey AS template, CASE WHEN s_suppkey > 1 THEN 'C' || (s_suppkey // 2) END AS parent, s_name AS description, CASE WHEN s_suppkey % 3 > 0 THEN 'a, z' ELSE '' END AS data_types,
  CASE WHEN s_suppkey % 3 > 0 THEN s_name ELSE '' END AS assays FROM supplier WHERE s_suppkey % 4 > 0""")
def model_template_table(t):
    return compile.template_table(_model(t))


@query(f"""{_UP} SELECT 'C' || k AS class, 'p' || n AS property,
  CASE WHEN NOT many THEN CASE WHEN NOT used AND n % 4 = 1 THEN 'INTEGER' ELSE 'STRING(80)' END WHEN NOT used AND n % 4 = 1 THEN 'INTEGER_LIST(20)' ELSE 'STRING_LIST(80x20)' END AS column_type FROM full_props""")
def model_columns(t):
    return compile.columns(compile.fields(_model(t)))


@query("SELECT 'E' || n_regionkey AS enum, n_nationkey AS ord, n_name AS label, lower(n_name) AS description, [n_name] AS aliases FROM nation")
def model_enum_values(t):
    return model.enum_values(_model(t)).select("enum", "ord", "label", "description", "aliases")


@query("SELECT 'C' || s_suppkey AS name, CASE WHEN s_suppkey % 5 = 0 THEN 'b' ELSE 'a' END AS x, CASE WHEN s_suppkey % 5 = 0 THEN 'u' END AS y, s_suppkey % 5 = 0 AS twice FROM supplier")
def model_merged(t):
    """Declarations of one name in two files: the later file wins key by key."""
    k, none = F.col("s_suppkey"), F.lit(None).cast("string")
    a = t("supplier").select(*_item("class", _named("C", k), none, k, F.lit('{"x": "a"}'), "a.yaml"))
    b = t("supplier").where("s_suppkey % 5 = 0").select(*_item("class", _named("C", k), none, k, F.lit('{"x": "b", "y": "u"}'), "b.yaml"))
    both = a.unionByName(b)
    found = model.merged(both).select("name", F.get_json_object("body", "$.x").alias("x"), F.get_json_object("body", "$.y").alias("y"))
    return found.join(model.collisions(both).select("name", F.lit(True).alias("twice")), "name", "left").withColumn("twice", F.coalesce("twice", F.lit(False)))


@query("SELECT 'C' || s_suppkey AS class, 'missing' AS finding, NULL::VARCHAR AS value FROM supplier WHERE s_suppkey % 4 > 0 AND s_suppkey % 3 = 0 UNION ALL SELECT 'C' || s_suppkey, 'invalid', s_name FROM supplier WHERE s_suppkey % 4 > 0 AND s_suppkey % 3 > 0 AND s_suppkey % 2 > 0")
def lint_coverage(t):
    """Concrete classes without an assay, and assays outside a vocabulary."""
    return lint.coverage(_model(t), "assay", t("supplier").where("s_suppkey % 2 = 0").select(F.col("s_name").alias("label")))


@query("SELECT c_custkey, 'C' || c_custkey AS schema_name FROM customer WHERE c_custkey > (SELECT max(s_suppkey) FROM supplier)")
def lint_dangling(t):
    return lint.dangling(t("customer").select("c_custkey", _named("C", F.col("c_custkey")).alias("schema_name")), _model(t)).select("c_custkey", "schema_name")


@query("SELECT 'p' || n_nationkey AS slot, 'E' || (n_regionkey + d) AS range FROM nation, (SELECT unnest([0, 1]) AS d) WHERE n_nationkey % 2 = d AND n_regionkey + d > 4")
def lint_unknown_ranges(t):
    """Ranges that the model does not have."""
    n, none = F.col("n_nationkey"), F.lit(None).cast("string")
    slots = t("nation").select(*_item("slot", _named("p", n), none, n, F.to_json(F.struct(_named("E", F.col("n_regionkey") + n % 2).alias("range")))))
    return lint.unknown_ranges(slots.unionByName(_model(t).where("kind = 'enum'")), ["string"])


@query("SELECT c_mktsegment AS label, list_sort(list(DISTINCT 'E' || (c_nationkey % 5))) AS enums FROM customer GROUP BY ALL HAVING count(DISTINCT c_nationkey % 5) > 1")
def lint_shared_labels(t):
    n = F.col("c_nationkey") % 5
    return lint.shared_labels(t("customer").select(*_item("value", _named("E", n), F.col("c_mktsegment"), n, F.lit("{}"))))


# --- profiling and synchronisation -----------------------------------------------------------------


@query("SELECT DISTINCT p_brand AS field, v AS value FROM part JOIN (SELECT 'E' || n_regionkey AS enum, unnest([n_name, lower(n_name)]) AS v FROM nation) x ON x.enum = 'E' || (p_size % 7)")
def profile_allowed_values(t):
    """Labels and aliases of the vocabularies that fields are mapped to."""
    words = t("nation").select(_named("E", F.col("n_regionkey")).alias("enum"), F.col("n_name").alias("label"), F.array(F.lower("n_name")).alias("aliases"))
    return profile.allowed_values(t("part").select(F.col("p_brand").alias("field"), _named("E", F.col("p_size") % 7).alias("enum")), words)


@query("SELECT p_partkey AS field, CASE WHEN p_size % 3 = 0 THEN 'OtherEnum' ELSE 'BrandEnum' END AS target FROM part WHERE p_size % 2 = 0")
def profile_open_vocabulary(t):
    """Fields that take a vocabulary or any text, and the vocabulary that new values go to."""
    ranges = F.array_compact(F.array(F.lit("OtherEnum"), F.when(F.col("p_size") % 3 > 0, "BrandEnum"), F.when(F.col("p_size") % 2 == 0, "string")))
    fields = t("part").select(F.col("p_partkey").alias("field"), ranges.alias("ranges"))
    enums = F.filter("ranges", lambda r: r.endswith("Enum"))
    return profile.open_vocabulary(fields).join(fields.select("field", profile.target_enum(enums).alias("target")), "field")


@query("SELECT doc_id FROM documents WHERE trim(coalesce(lang, '')) <> '' AND trim(coalesce(source, '')) <> ''")
def sync_complete(t):
    return sync.complete(t("documents"), "lang", "source").select("doc_id")


@query("SELECT s_suppkey, n_name, m AS meaning FROM supplier JOIN nation ON s_nationkey = n_nationkey LEFT JOIN (SELECT n_name, 'm' || n_nationkey AS m FROM nation WHERE n_nationkey % 2 = 0) x USING (n_name)")
def sync_linked(t):
    """Left lookup on trimmed names; the lookup side holds some twice."""
    links = t("nation").where("n_nationkey % 2 = 0").select(F.concat(F.lit(" "), F.col("n_name")).alias("n_name"), _named("m", F.col("n_nationkey")).alias("meaning"))
    rows = t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.concat(F.col("n_name"), F.lit("  ")).alias("n_name"))
    return sync.linked(rows, links.union(links), "n_name")


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 2 ELSE 0 END AS step FROM customer")
def upsert_last_change(t):
    """Of several changes of one key the last one counts."""
    base = t("customer").select("c_custkey", F.lit(0).alias("step"))
    change = lambda n: base.where("c_custkey % 3 = 0").withColumn("step", F.lit(n))
    return sync.upserted(base, change(1).unionByName(change(2)), ["c_custkey"], "step")


# --- lookups ---------------------------------------------------------------------------------------


@query("SELECT 'E' || r_regionkey AS enum, f AS file FROM region LEFT JOIN (SELECT n_regionkey AS r, min('f' || n_nationkey) AS f FROM nation WHERE n_regionkey < 3 GROUP BY ALL) x ON x.r = r_regionkey")
def lookup_enum_file(t):
    words = t("nation").where("n_regionkey < 3").select(_named("E", F.col("n_regionkey")).alias("enum"), _named("f", F.col("n_nationkey")).alias("file"))
    return lookup.enum_file(t("region").select(_named("E", F.col("r_regionkey")).alias("enum")), words)


@query("""WITH known AS (SELECT s_suppkey AS id, 'o' || s_nationkey AS org, s_suppkey % 3 AS name FROM supplier),
named AS (SELECT org, name, min(id) AS by_name FROM known GROUP BY ALL)
SELECT c_custkey AS key, coalesce(k.id, by_name) AS found FROM customer LEFT JOIN known k ON c_custkey = k.id LEFT JOIN named n ON n.org = 'o' || c_nationkey AND n.name = c_custkey % 4""")
def lookup_existing(t):
    """The registered set of an id, else of an organisation and name."""
    known = t("supplier").select(F.col("s_suppkey").alias("id"), _named("o", F.col("s_nationkey")).alias("org"), (F.col("s_suppkey") % 3).alias("name"))
    wanted = t("customer").select(F.col("c_custkey").alias("key"), F.col("c_custkey").alias("id"), _named("o", F.col("c_nationkey")).alias("org"), (F.col("c_custkey") % 4).alias("name"))
    return lookup.existing(wanted, known)


@query("SELECT o_custkey AS class, o_orderkey AS template FROM orders WHERE o_orderstatus = 'F' AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey < 5)")
def lookup_suggested(t):
    relations = t("orders").select(F.col("o_custkey").alias("from"), F.col("o_orderkey").alias("to"), F.col("o_orderstatus").alias("property"))
    return lookup.suggested(relations, t("customer").where("c_nationkey < 5").select(F.col("c_custkey").alias("name")), "F")


@query("SELECT page_id, CASE WHEN contains(url, 'org') THEN ['page', 'url'] ELSE ['url'] END AS present FROM pages")
def lookup_annotated(t):
    """Schema fields that an annotation map fills already; blank values do not."""
    pages = t("pages").withColumn("notes", F.create_map(F.lit("url"), F.col("url"), F.lit("page"), F.when(F.col("url").contains("org"), "x").otherwise(" "), F.lit("other"), F.lit("y")))
    return lookup.annotated(pages, "notes", ["url", "page", "absent"]).select("page_id", "present")


@query("SELECT n_nationkey, n_name AS name FROM nation WHERE n_name NOT IN ('NATION_1', 'NATION_2')")
def lookup_chosen(t):
    return lookup.chosen(t("nation").select("n_nationkey", F.col("n_name").alias("name")), exclude=["NATION_1", "NATION_2"])


@query("SELECT DISTINCT p_partkey, p_brand AS name, p_size AS version FROM part WHERE (p_brand, p_size) IN (SELECT (p_brand, p_size) FROM part WHERE p_partkey % 10 = 0)")
def lookup_conflicts(t):
    part = t("part").select("p_partkey", F.col("p_brand").alias("name"), F.col("p_size").alias("version"))
    return lookup.conflicts(part, part.where("p_partkey % 10 = 0")).select("p_partkey", "name", "version")


@query("SELECT p_brand AS brand, p_type AS name, list_sort(list(p_size)) AS sizes FROM part GROUP BY ALL")
def lookup_multimap(t):
    found = lookup.multimap(t("part"), "p_brand", "p_type", "p_size")
    return found.select(F.col("p_brand").alias("brand"), F.explode("properties").alias("name", "sizes"))


@query("""SELECT range_of AS slot, list_sort(list_filter(y, lambda v: NOT list_contains(x, v))) AS added, list_sort(list_filter(x, lambda v: NOT list_contains(y, v))) AS removed FROM
  (SELECT p_brand AS range_of, list(DISTINCT p_type) AS x FROM part WHERE p_partkey % 4 = 0 GROUP BY ALL) JOIN (SELECT p_brand AS range_of, list(DISTINCT p_type) AS y FROM part WHERE p_partkey % 4 = 1 GROUP BY ALL) USING (range_of)
WHERE list_sort(x) <> list_sort(y)""")
def lookup_range_changes_of_brands(t):
    """Slots of two model versions whose ranges differ: brands with the types of different parts."""
    part = t("part").select("p_partkey", F.col("p_brand").alias("slot"), F.col("p_type").alias("range"))
    return lookup.range_changes(part.where("p_partkey % 4 = 0"), part.where("p_partkey % 4 = 1"))


# --- texts -----------------------------------------------------------------------------------------


@query("""SELECT p_partkey, 'Part' || p_size || 'RNA Seq' AS template, 'RNA Seq2Data_x' AS enum, p_size % 2 = 0 AS flag, 'RNASeq-' || p_brand AS data_type, CASE WHEN p_size % 2 = 0 THEN 'ATemplate' END AS of,
  'org' AS org, 'name' || p_size || '-x' AS name, 'rrid:' || p_size AS rrid, CASE WHEN p_size % 2 = 0 THEN p_type END AS useful FROM part""")
def text_identifiers(t):
    """Readable names, flags, data types, template names in addresses, schema ids, research ids, descriptions worth a row."""
    size = F.col("p_size").cast("string")
    even = F.col("p_size") % 2 == 0
    return t("part").select(
        "p_partkey",
        text.humanized(F.concat(F.lit("Part"), size, F.lit("RNASeqTemplate"))).alias("template"),
        text.humanized_enum(F.lit("RNASeq2Data_xEnum")).alias("enum"),
        text.is_true(F.when(even, "true").otherwise("no")).alias("flag"),
        text.data_type(F.lit("RNASeqTemplate"), F.col("p_brand")).alias("data_type"),
        text.template_of(F.concat(F.lit("org.x-1."), F.when(even, "ATemplate").otherwise("none"), F.lit(".v2"))).alias("of"),
        text.schema_id(F.concat(F.lit("https://e.org/org-name"), size, F.lit("-x-1.0"))).getField("org").alias("org"),
        text.schema_id(F.concat(F.lit("https://e.org/org-name"), size, F.lit("-x-1.0"))).getField("name").alias("name"),
        text.rrid(F.when(even, size).otherwise(F.concat(F.lit(" rrid:"), size))).alias("rrid"),
        text.useful_description(F.when(even, F.col("p_type")).otherwise(F.lit(" n ")), F.lit("n")).alias("useful"),
    )


@query("""SELECT page_id, split_part(url, '/', -1) AS last, replace(replace(url, '&', '&amp;'), '<', '&lt;') AS html, 'a%2520b%252F' || page_id AS twice, page_id::VARCHAR AS inner_text, 'One' AS sentence FROM pages""")
def text_addresses(t):
    id = F.col("page_id").cast("string")
    return t("pages").select(
        "page_id", text.last_segment(F.col("url")).alias("last"), text.escaped_html(F.col("url")).alias("html"), text.encoded_twice(F.concat(F.lit("a b/"), id)).alias("twice"), text.unwrapped(F.concat(F.lit("string("), id, F.lit(")"))).alias("inner_text"), text.first_sentence(F.lit("One. Two.")).alias("sentence")
    )


@query("SELECT event_id, strftime(ts, '%B %-d, %Y') AS day FROM events")
def text_display_date(t):
    return t("events").select("event_id", text.display_date(F.col("ts")).alias("day"))


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN ['other'] END AS cleaned, CASE WHEN n_nationkey % 2 = 0 THEN ['other'] ELSE ['second'] END AS used FROM nation")
def synonym_aliases(t):
    """Aliases that say more than the label, or else those of another source."""
    aliases = F.array_compact(F.array(F.lower("n_name"), F.when(F.col("n_nationkey") % 2 == 0, "other")))
    cleaned = synonyms.cleaned_aliases(aliases, F.col("n_name"))
    return t("nation").select("n_nationkey", cleaned.alias("cleaned"), synonyms.fallback(cleaned, F.array(F.lit("second"))).alias("used"))


# --- browsing and validation -------------------------------------------------------------------------


@query("SELECT n_nationkey, row_number() OVER (ORDER BY coalesce(CASE WHEN n_regionkey < 2 THEN n_regionkey END, 2), n_name)::INT AS place FROM nation")
def browse_by_tier(t):
    """Order by tier, those without one last, then by name; the place in it is part of the result."""
    rows = t("nation").withColumn("tier", F.when(F.col("n_regionkey") < 2, F.col("n_regionkey")))
    return browse.by_tier(rows, "tier", "n_name").select("n_nationkey", F.col("place").cast("int").alias("place"))


@query("SELECT p_partkey, place FROM (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey)::INT AS place FROM part WHERE contains(lower(p_name), 'ar')) WHERE place <= 20")
def search_first_matches(t):
    """The first 20 matches in the order of the index."""
    return browse.first_matches(t("part"), "AR", "p_partkey", 20, "p_name").select("p_partkey", "place")


@query("SELECT p_partkey, row_number() OVER (ORDER BY p_size > 25 DESC, p_name DESC, p_partkey DESC)::INT AS place FROM part ORDER BY place LIMIT 50")
def browse_sorted(t):
    """A user's sort on any columns, falling; false comes before true."""
    rows = t("part").withColumn("large", F.col("p_size") > 25)
    listed = browse.sorted_by(rows, "large", "p_name", "p_partkey", falling=True).limit(50).agg(F.collect_list("p_partkey").alias("k"))
    return listed.select(F.posexplode("k").alias("pos", "p_partkey")).select("p_partkey", (F.col("pos") + 1).alias("place"))


@query("SELECT conv_id, turn FROM conversations WHERE text <> '' AND NOT ends_with(text, chr(10))")
def lint_final_newline(t):
    return lint.without_final_newline(t("conversations").withColumn("file", F.struct("conv_id", "turn"))).select("file.*")


@query("""SELECT n_nationkey, kind, field FROM (
  SELECT n_nationkey, 'type' AS kind, 'a' AS field FROM nation WHERE n_nationkey % 6 = 0 UNION ALL SELECT n_nationkey, 'items', 'b' FROM nation WHERE n_nationkey % 6 = 1
  UNION ALL SELECT n_nationkey, 'type', 'b' FROM nation WHERE n_nationkey % 6 = 2 UNION ALL SELECT n_nationkey, 'not', 'a' FROM nation WHERE n_nationkey % 6 = 3 UNION ALL SELECT n_nationkey, 'anyOf', 'c' FROM nation WHERE n_nationkey % 6 = 4)""")
def validate_types_items_not(t):
    """Strict types, lists element by element, negation, a union that fails; unknown members and formats are let pass."""
    case = lambda n, text: F.when(F.col("n_nationkey") % 6 == n, text)
    record = F.coalesce(case(0, '{"a": "1", "x": {}}'), case(1, '{"b": ["u", 3]}'), case(2, '{"b": "u"}'), case(3, '{"a": 7.0}'), case(4, '{"c": true}'), F.lit('{"a": 2, "b": [], "c": "s", "d": "no date"}'))
    schema = {"properties": {"a": {"type": "number", "not": {"const": 7}}, "b": {"type": "array", "items": {"enum": ["u", "v"]}}, "c": {"anyOf": [{"type": "string"}, {"type": "integer"}]}, "d": {"format": "date"}}}
    return validate.long_form(validate.validate(t("nation").withColumn("json", record), schema), "n_nationkey").select("n_nationkey", "kind", "field")


@query("SELECT 'r' AS registry, o_orderkey::VARCHAR AS file, CASE WHEN o_totalprice > 100000 THEN 'valid' ELSE 'invalid' END AS expected, CASE WHEN o_orderstatus = 'F' THEN 'valid' ELSE 'invalid' END AS actual, (o_totalprice > 100000) = (o_orderstatus = 'F') AS agrees FROM orders")
def validate_verdicts(t):
    """Expected against actual verdicts."""
    orders = t("orders").withColumn("file", F.col("o_orderkey").cast("string"))
    expected = orders.select(F.lit("r").alias("registry"), "file", F.when(F.col("o_totalprice") > 100_000, "valid").otherwise("invalid").alias("expected"))
    return validate.verdicts(validate.validate_table(orders, {"properties": {"o_orderstatus": {"const": "F"}}}), expected).select("registry", "file", "expected", "actual", "agrees")


# --- files, graphs, addresses --------------------------------------------------------------------------


@query("""SELECT 'f' || n_regionkey AS file, 3 AS width, place::INT AS line FROM (SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) + 1 AS place FROM nation) WHERE n_nationkey % 2 = 1""")
def lint_csv_records(t):
    """CSV records of another width than their header; quoted marks and line ends are no ends of fields and records."""
    n = F.col("n_nationkey")
    record = F.concat(F.lit('"'), F.col("n_name"), F.lit(', ""x""\n"'), F.lit(","), n.cast("string"), F.when(n % 2 == 1, ",odd").otherwise(""), F.lit("\n"))
    ordered = F.array_sort(F.collect_list(F.struct(n.alias("k"), record.alias("record"))))
    files = t("nation").groupBy("n_regionkey").agg(F.concat(F.lit("name,key\n"), F.array_join(F.transform(ordered, lambda x: x["record"]), "")).alias("text"))
    return browse.csv_findings(files.select(_named("f", F.col("n_regionkey")).alias("file"), "text")).select("file", "width", "line")


@query("SELECT (SELECT count(*) FROM nation) AS before, (SELECT count(*) FROM nation WHERE n_nationkey % 3 > 0) + (SELECT count(*) FROM region) AS after, (SELECT count(*) FROM region) - (SELECT count(*) FROM nation WHERE n_nationkey % 3 = 0) AS change")
def graph_count_change(t):
    """Numbers of distinct facts of two graphs; repeated facts count once."""
    facts = graph.triples(t("nation"), F.col("n_name"), {"in": F.col("n_regionkey")})
    others = graph.triples(t("region"), F.col("r_name"), {"key": F.col("r_regionkey")})
    kept = graph.triples(t("nation").where("n_nationkey % 3 > 0"), F.col("n_name"), {"in": F.col("n_regionkey")})
    return graph.count_change(facts.unionByName(facts), kept.unionByName(others))


@query("""SELECT 'p' || n_nationkey AS field, CASE WHEN n_nationkey % 4 = 0 THEN ['E' || n_regionkey] ELSE ['E' || n_regionkey, 'E' || ((n_regionkey + 1) % 5)] END AS enums, false AS open FROM nation WHERE n_nationkey % 4 IN (0, 3)""")
def profile_model_fields(t):
    """Vocabularies of a model's slots."""
    return profile.model_fields(_model(t), lambda r: r.startswith("E"))


@query("SELECT page_id, page_id % 3 = 1 AS valid FROM pages")
def text_term_address(t):
    """Addresses of terms: http or https, some sites left out; null is none."""
    id = F.col("page_id").cast("string")
    return t("pages").select("page_id", text.term_address(F.when(F.col("page_id") % 3 == 1, F.concat(F.lit("https://x.org/"), id)).when(F.col("page_id") % 3 == 2, F.concat(F.lit("https://ror.org/"), id))).alias("valid"))


@query("SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'INTEGER' WHEN 1 THEN 'STRING(80)' WHEN 2 THEN 'BOOLEAN_LIST(20)' WHEN 3 THEN 'DOUBLE' WHEN 4 THEN 'STRING(80)' ELSE 'STRING_LIST(80x20)' END AS column_type FROM part")
def model_column_types(t):
    """Types of table columns from lists of types, branches and vocabularies."""
    cases = ['{"type": ["null", "integer"]}', '{"oneOf": [{"type": "integer"}, {"enum": ["a"]}]}', '{"oneOf": [{"type": "null"}, {"type": "array", "items": {"type": "boolean"}}]}', '{"oneOf": [{"type": ["number", "null"]}, {"type": "null"}]}', '{"oneOf": [{"type": "integer"}, {"type": "boolean"}]}', '{"type": "array", "items": {"type": "integer", "enum": [1]}}']
    schema = F.element_at(F.array(*[F.lit(c) for c in cases]), (F.col("p_partkey") % 6 + 1).cast("int"))
    return t("part").select("p_partkey", compile.column_type(schema).alias("column_type"))


# --- Turtle and blank nodes ----------------------------------------------------------------------------

_RDF = turtle.RDF


def _described(t) -> DataFrame:
    """Every part as a Turtle document: a name in a language, a typed price, a list of size and brand."""
    key, quoted = F.col("p_partkey").cast("string"), lambda c: F.regexp_replace(c, r'(["\\])', r"\\$1")
    text = F.concat(F.lit("@prefix e: <http://e.org/> .\n# one part\ne:P"), key, F.lit(' a e:Part ; e:name """'), quoted(F.col("p_name")), F.lit('"""@en ;\n e:price "'), F.col("p_retailprice").cast("string"), F.lit('"^^e:money ; e:dims ( '), F.col("p_size").cast("string"), F.lit(' "'), quoted(F.col("p_brand")), F.lit('" ) .'))
    return turtle.parsed(t("part").select("p_partkey", text.alias("text")), "text", "p_partkey")


@query("SELECT p_partkey, p_name AS name, 'en' AS lang, 'http://e.org/money' AS money, p_size::VARCHAR AS size, p_brand AS brand FROM part")
def turtle_lists(t):
    """Documents parsed into triples, and a list walked over its blank nodes."""
    g = _described(t)
    of = lambda p, name, *more: g.where(F.col("p") == f"http://e.org/{p}").select("s", F.col("o").alias(name), *more)
    walked = graph.basic(g, ("?s", "http://e.org/dims", "?l"), ("?l", _RDF + "first", "?size"), ("?l", _RDF + "rest", "?m"), ("?m", _RDF + "first", "?brand"), ("?m", _RDF + "rest", _RDF + "nil"))
    out = of("name", "name", "lang").join(of("price", "price", F.col("datatype").alias("money")), "s").join(walked, "s")
    return out.select(F.substring_index("s", "P", -1).cast("long").alias("p_partkey"), "name", "lang", "money", "size", "brand")


@query("SELECT s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 3 > 0")
def bgp_restriction_path(t):
    """Four patterns through an anonymous restriction: of those on a supplier only the ones on its nation count, and of these
    only typed ones."""
    n = F.col("s_nationkey").cast("string")
    typed = F.when(F.col("s_suppkey") % 3 > 0, "a e:Restriction ; ").otherwise("")
    text = F.concat(F.lit("@prefix e: <http://e.org/> . e:S"), F.col("s_suppkey").cast("string"), F.lit(" e:sub [ "), typed, F.lit("e:on e:nation ; e:some e:N"), n, F.lit(" ] , [ a e:Restriction ; e:on e:other ; e:some e:N"), n, F.lit(" ] ."))
    g = turtle.parsed(t("supplier").select("s_suppkey", text.alias("text")), "text", "s_suppkey")
    found = graph.basic(g, ("?s", "http://e.org/sub", "?r"), ("?r", _RDF + "type", "http://e.org/Restriction"), ("?r", "http://e.org/on", "http://e.org/nation"), ("?r", "http://e.org/some", "?n"))
    names = t("nation").select(_named("http://e.org/N", F.col("n_nationkey")).alias("n"), "n_name")
    return found.join(names, "n").select(F.substring_index("s", "S", -1).cast("long").alias("s_suppkey"), "n_name")


@query("SELECT n_regionkey AS region, count(*) AS nodes, count(*) AS links, 0::BIGINT AS differences FROM nation GROUP BY ALL")
def graph_canonical_cycles(t):
    """The nations of each region as a ring of blank nodes, one of them marked with the region: two namings become one graph."""
    n = F.col("n_nationkey")
    ring = W.partitionBy("n_regionkey").orderBy(n)
    rows = t("nation").withColumns({"next": F.coalesce(F.lead(n).over(ring), F.first(n).over(ring)), "place": F.row_number().over(ring)})

    def named(letter: str, key) -> DataFrame:
        name = lambda c: F.concat(F.lit(f"_:{letter}"), key(c).cast("string"))
        links = rows.select(name(n).alias("s"), F.lit("next").alias("p"), name(F.col("next")).alias("o"), F.lit("bnode").alias("s_kind"), F.lit("bnode").alias("o_kind"))
        marks = rows.where("place = 1").select(name(n).alias("s"), F.lit("region").alias("p"), F.col("n_regionkey").cast("string").alias("o"), F.lit("bnode").alias("s_kind"), F.lit("literal").alias("o_kind"))
        return graph.canonical(links.unionByName(marks)).select("s", "p", "o")

    a, b = named("a", lambda c: c), named("b", lambda c: 1000 - c * 7)
    above = graph.path_plus(a.where("p = 'next'"), "next")
    member = above.join(a.where("p = 'region'").select(F.col("s").alias("o"), F.col("o").cast("int").alias("region")), "o").select("s", "region")
    counted = member.groupBy("region").agg(F.count("*").alias("nodes"))
    links = a.where("p = 'next'").join(member, "s").groupBy("region").agg(F.count("*").alias("links"))
    apart = a.subtract(b).unionByName(b.subtract(a)).agg(F.count("*").alias("differences"))  # one row
    return counted.join(links, "region").crossJoin(F.broadcast(apart)).select("region", "nodes", "links", "differences")


# --- validation as data ----------------------------------------------------------------------------------

_MANY = {
    "order": ORDER,
    "part": {"required": ["p_name"], "properties": {"p_size": {"type": "integer", "maximum": 45, "minimum": 3}, "p_brand": {"type": "string", "not": {"anyOf": [{"const": "Brand#11"}, {"const": "Brand#22"}]}}, "sizes": {"type": "array", "items": {"type": "integer", "maximum": 48}}}},
    "customer": {"if": {"properties": {"c_mktsegment": {"const": "BUILDING"}}, "required": ["c_mktsegment"]}, "then": {"properties": {"c_acctbal": {"minimum": 0}}, "required": ["c_phone"]}},
}


def _many(t) -> DataFrame:
    """(key, schema, json): orders, parts and customers, each record with the name of its schema, and nations without one."""
    made = lambda name, key, schema, *columns: t(name).select(F.col(key).cast("long").alias("key"), F.lit(schema).alias("schema"), F.to_json(F.struct(*columns)).alias("json"))
    return (
        made("orders", "o_orderkey", "order", "o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice")
        .unionByName(made("part", "p_partkey", "part", "p_name", "p_size", "p_brand", F.array("p_size", F.col("p_size") + 2).alias("sizes")))
        .unionByName(made("customer", "c_custkey", "customer", "c_mktsegment", "c_acctbal"))
        .unionByName(made("nation", "n_nationkey", "nation", "n_name"))
        .unionByName(t("region").select(F.col("r_regionkey").cast("long").alias("key"), F.lit("part").alias("schema"), F.col("r_name").alias("json")))
    )


@query(f"""SELECT 'order' AS schema, o_orderkey::BIGINT AS key, kind, field, rule FROM ({BAD_ORDERS})
UNION ALL SELECT 'part', p_partkey, 'maximum', 'p_size', NULL FROM part WHERE p_size > 45 UNION ALL SELECT 'part', p_partkey, 'minimum', 'p_size', NULL FROM part WHERE p_size < 3
UNION ALL SELECT 'part', p_partkey, 'not', 'p_brand', NULL FROM part WHERE p_brand IN ('Brand#11', 'Brand#22') UNION ALL SELECT 'part', p_partkey, 'items', 'sizes', NULL FROM part WHERE p_size > 46
UNION ALL SELECT 'customer', c_custkey, 'minimum', 'c_acctbal', 0 FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal < 0 UNION ALL SELECT 'customer', c_custkey, 'required', 'c_phone', 0 FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL SELECT 'nation', n_nationkey, 'schema', '', NULL FROM nation UNION ALL SELECT 'part', r_regionkey, 'json', '', NULL FROM region""")
def validate_many_schemas(t):
    """Records of several schemas, of none, and texts that are no records, in one plan."""
    schemas = t("region").sparkSession.createDataFrame([(k, json.dumps(s)) for k, s in _MANY.items()], "schema string, json string")
    return rules.validate(_many(t), rules.rules(schemas), "schema", "key")


@query("""WITH words AS (SELECT p_type FROM part GROUP BY p_type HAVING min(p_partkey) % 3 > 0), names AS (SELECT p_name FROM part GROUP BY p_name HAVING min(p_partkey) % 4 > 0)
SELECT p_partkey, 'enum' AS kind, 'p_name' AS field, NULL::INT AS rule FROM part WHERE p_name NOT IN (SELECT p_name FROM names)
UNION ALL SELECT p_partkey, 'items', 'types', 0 FROM part WHERE p_size > 25 AND p_type NOT IN (SELECT p_type FROM words)""")
def validate_long_vocabularies(t):
    """Vocabularies made of table rows, too long to stay in a check: one of texts, one of list items under a condition."""
    part = t("part")
    of = lambda c, n: part.groupBy(c).agg(F.min("p_partkey").alias("first")).where(f"first % {n} > 0").agg(F.to_json(F.array_sort(F.collect_set(c))).alias(c))
    names, words = of("p_name", 4), of("p_type", 3)
    text = F.concat(F.lit('{"properties": {"p_name": {"enum": '), F.col("p_name"), F.lit('}}, "if": {"properties": {"p_size": {"minimum": 26}}, "required": ["p_size"]}, "then": {"properties": {"types": {"items": {"enum": '), F.col("p_type"), F.lit("}}}}}"))
    schemas = names.crossJoin(words).select(F.lit("part").alias("schema"), text.alias("json"))  # one row
    records = part.select("p_partkey", F.lit("part").alias("schema"), F.to_json(F.struct("p_name", "p_size", F.array("p_type").alias("types"))).alias("json"))
    return rules.validate(records, rules.rules(schemas, inline=3), "p_partkey")


# --- positional search -----------------------------------------------------------------------------------

_TOKENS = r"list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '')"
_AT = "list_filter(range(1, len(w) + 1), lambda i: w[i:i + len(p) - 1] = p)"


@query(f"""SELECT phrase, doc_id AS id, len({_AT}) AS n FROM (SELECT doc_id, {_TOKENS} AS w FROM documents),
  (SELECT unnest([['the'], ['of', 'the'], ['the', 'and', 'to'], ['en', 'the'], ['a', 'a', 'a']]) AS p), LATERAL (SELECT array_to_string(p, ' ') AS phrase) WHERE len({_AT}) > 0""")
def search_phrases(t):
    """Phrases by places, repeats within a phrase too; the language stands in a field of its own, so `en the` never bridges."""
    index = postings.postings(t("documents"), "doc_id", "lang", "text")
    wanted = index.sparkSession.createDataFrame([("the",), ("of the",), ("the and to",), ("en the",), ("a a a",)], "phrase string")
    return postings.phrases(index, wanted)


@query(f"""SELECT query, doc_id AS id, sum(len({_AT}))::BIGINT AS n FROM (SELECT doc_id, {_TOKENS} AS w FROM documents),
  (VALUES ('The', ['of', 'the']), ('The', ['the', 'and']), ('to', ['to']), ('and', ['and']), ('and', ['that'])) x(query, p) WHERE len({_AT}) > 0 GROUP BY ALL""")
def search_phrases_of_synonyms(t):
    """Queries that stand for several phrases: one is replaced, one is kept beside another, one has no rule."""
    spark = t("documents").sparkSession
    rules = spark.createDataFrame([("REPLACE", ["the", "of the", "the and"]), ("KEEP", ["and", "that"])], "kind string, terms array<string>")
    return postings.search(postings.postings(t("documents"), "doc_id", "text"), spark.createDataFrame([("The",), ("to",), ("and",)], "query string"), rules)


# --- a model out of a graph ------------------------------------------------------------------------------


@query(SQL["model_properties"])
def model_properties_of_graph(t):
    """A model told as triples with blank nodes, read back by patterns, and its properties resolved by the nearest class."""
    d = F.col("def")
    branches = F.coalesce(F.size(F.coalesce(d["any_of"], F.array().cast("array<struct<range:string>>"))), F.lit(0))
    told = graph.model_graph(_model(t))
    renamed = lambda c: F.when(F.col(c).startswith("_:"), F.concat(F.lit("_:x"), F.md5(F.col(c)))).otherwise(F.col(c)).alias(c)
    back = graph.model_items(told.select(renamed("s"), "p", renamed("o"), "s_kind", "o_kind", "datatype"))
    return compile.properties(back).select("class", "property", F.col("order.depth").cast("int").alias("depth"), d["required"].alias("required"), d["range"].alias("range"), branches.alias("branches"))


@query("""WITH first AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS place FROM orders QUALIFY place <= 10)
SELECT o_custkey, o_orderkey, place::INT AS place, row_number() OVER (PARTITION BY o_custkey ORDER BY place)::INT AS rank FROM first
WHERE o_orderpriority = '1-URGENT' QUALIFY rank <= 3""")
def lookup_first_found(t):
    """Of each customer's first 10 orders the first 3 urgent ones."""
    return lookup.first_found(t("orders"), "o_custkey", "o_orderkey", F.col("o_orderpriority") == "1-URGENT").select("o_custkey", "o_orderkey", "place", "rank")


@query("""SELECT p_partkey FROM part WHERE p_brand IN ('Brand#11', 'Brand#12', 'Brand#13')
AND CASE split_part(p_type, ' ', 1) WHEN 'STANDARD' THEN 1 WHEN 'SMALL' THEN 2 WHEN 'MEDIUM' THEN 3 WHEN 'PROMO' THEN 4 ELSE 3 END <= 4
AND p_size % 5 > 0 AND split_part(p_type, ' ', 1) <> 'PROMO' AND p_size >= 10""")
def browse_cards(t):
    """Parts as cards: a tier by type, size as the number of fields, every fifth size abstract."""
    rows = t("part").select("p_partkey", "p_brand", F.split_part("p_type", F.lit(" "), F.lit(1)).alias("tier"), (F.col("p_size") % 5 == 0).alias("abstract"), F.col("p_size").alias("fields"))
    tiers = ["STANDARD", "SMALL", "MEDIUM", "PROMO"]
    return browse.cards(rows, tiers=tiers, upto="PROMO", least_fields=10, p_brand=["Brand#11", "Brand#12", "Brand#13"]).select("p_partkey")
