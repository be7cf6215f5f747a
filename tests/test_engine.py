"""The engine against golden cases of its own: a small model in tests/data, and SQL of the same meaning."""

import importlib.util
import json
import os
import random
import time

import duckdb
import pytest
from pyspark.sql import functions as F

import tesserae.model_queries  # noqa: F401  registers its queries
from tesserae.functions import text
from tesserae.operators import browse, graph, lint, lookup, postings, profile, sync, synonyms
from tesserae.plans import compile, rules, validate
from tesserae.queries import QUERIES, SQL
from tesserae.sources import model, sinks, turtle
from tesserae.streaming import drift

HERE = os.path.dirname(__file__)
DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def items(spark):
    return model.read_modules(spark, f"{HERE}/data/model").persist()


@pytest.fixture(scope="module")
def schemas(items):
    return {r["class"]: json.loads(r["json"]) for r in compile.schemas(items, "org.example-").collect()}


def test_modules(spark, items):
    kinds = {r["kind"]: r["count"] for r in items.groupBy("kind").count().collect()}
    assert kinds["error"] == 1 and kinds["class"] == 4 and kinds["value"] == 9
    assert [r["name"] for r in model.collisions(model.read_declarations(spark, f"{HERE}/data/model")).collect()] == ["note"]
    merged = items.where("kind = 'slot' AND name = 'note'").first()["body"]
    assert json.loads(merged) == {"description": "later", "range": "string"}
    values = {(r["enum"], r["label"]): r for r in model.enum_values(items).collect()}
    assert values["Sex", "Female"]["aliases"] == ["F"] and values["Unit", "days"]["source"] == ["https://example.org/d"]


def test_compiled_schema(schemas):
    assert schemas["Base"] == {"$id": "org.example-base", "$schema": "http://json-schema.org/draft-07/schema#", "title": "Base", "type": "object"}
    assay = schemas["Assay"]
    assert list(assay["properties"]) == ["reads", "kit", "age", "ageUnit", "diagnosis", "sex", "tags"]
    assert assay["required"] == ["reads", "sex"]
    assert assay["properties"]["reads"] == {"title": "reads", "type": "integer", "minimum": 1.0}
    assert assay["properties"]["age"]["anyOf"] == [{"type": "number"}, {"description": "", "title": "Mask", "type": "string", "enum": [">= 90", "Unknown"]}]
    assert assay["properties"]["sex"] == {"description": "", "title": "sex", "type": "string", "enum": ["Female", "Male"]}  # the vocabulary's
    assert assay["properties"]["ageUnit"]["description"] == "Units of age"
    assert assay["properties"]["diagnosis"] == {"title": "diagnosis", "type": "string"}  # a refinement drops any_of
    assert assay["properties"]["tags"]["items"] == {"description": "Units of age", "type": "string", "enum": ["Female", "Male", "days", "years", "hours"]}
    assert [len(r["then"].get("required", [])) for r in assay["allOf"]] == [1, 1, 0]
    assert "if" in schemas["Plain"] and "allOf" not in schemas["Plain"]
    assert "Filename" not in assay["properties"]


def verdict(spark, schema, *records, **options):
    rows = [(i, r if isinstance(r, str) else json.dumps(r)) for i, r in enumerate(records)]
    out = validate.validate(spark.createDataFrame(rows, "i int, json string"), schema, **options)
    return [sorted((v["kind"], v["field"], v["rule"]) for v in r["violations"]) for r in out.orderBy("i").collect()]


def test_verdicts(spark, schemas):
    good = {"reads": 5, "sex": "Male"}
    assert verdict(
        spark, schemas["Assay"], good, good | {"reads": 150.0}, good | {"reads": "5"}, good | {"reads": None}, good | {"reads": 0}, good | {"sex": "male"}, {"sex": "Male"}, good | {"other": 1}, "[]", "{", good | {"tags": []}, good | {"tags": "days"}, good | {"tags": ["days", 1]}, good | {"reads": True}
    ) == [[], [], [("type", "reads", None)], [("type", "reads", None)], [("minimum", "reads", None)], [("enum", "sex", None)], [("required", "reads", None)], [], [("json", "", None)], [("json", "", None)], [], [("type", "tags", None)], [("items", "tags", None)], [("type", "reads", None)]]
    assert verdict(spark, schemas["Assay"], good | {"age": 5}, good | {"age": "Unknown"}, good | {"age": 89.99999, "ageUnit": "years"}, good | {"age": 90, "ageUnit": "years"}, good | {"age": ">= 90", "ageUnit": "years"}, good | {"age": "90", "ageUnit": "years"}) == [
        [("required", "ageUnit", 1)], [], [], [("maximum", "age", 2)], [], [("anyOf", "age", None)]
    ]
    assert verdict(spark, schemas["Assay"], good | {"kit": None}) == [[("required", "diagnosis", 0), ("type", "kit", None)]]
    assert verdict(spark, schemas["Base"], {"anything": 1}) == [[]]
    assert verdict(spark, {"required": ["a"]}, {"a": None}, null_as_absent=True) == [[("required", "a", None)]]


def test_vacuous_rules(spark):
    rule = {"if": {"properties": {"kind": {"const": "x"}}}, "then": {"not": {"properties": {"name": {"const": "n"}}}}}
    assert verdict(spark, rule, {}, {"name": "m"}, {"kind": "y", "name": "n"}, {"name": "n"}) == [[("not", "", 0)], [], [], [("not", "", 0)]]


def test_registry_and_summary(spark, schemas):
    registry = model.read_registry(spark, f"{HERE}/data")
    records = model.read_instances(spark, f"{HERE}/data/records").withColumn("file", F.substring_index("file", "/", -1))
    checked = validate.validate(records, schemas["Assay"])
    agreed = validate.verdicts(checked, registry).collect()
    assert len(agreed) == 3 and all(r["agrees"] for r in agreed)
    assert {(r["kind"], r["records"]) for r in validate.summary(checked).collect()} == {("required", 1), ("enum", 1)}


def test_overlay_and_injection():
    assert compile.overlay({"$id": "a", "required": ["x"], "k": 1}, {"k": 2}, "b") == {"$id": "b", "k": 2}
    rule = {"if": {}, "then": {}}
    once = compile.with_conditional({"if": {"a": 1}, "then": {"b": 1}}, rule)
    assert len(once["allOf"]) == 2 and compile.with_conditional(once, rule) == once


def test_tables_of_a_model(items):
    kinds = {(r["class"], r["property"]): r["column_type"] for r in compile.columns(compile.fields(items)).collect()}
    assert kinds["Assay", "reads"] == "INTEGER" and kinds["Assay", "tags"] == "STRING_LIST(80x20)" and kinds["Assay", "sex"] == "STRING(80)" and kinds["Assay", "age"] == "STRING(80)"
    table = {r["template"]: r for r in compile.template_table(items).collect()}
    assert table["Assay"]["description"] == "Reads of a sample" and table["Assay"]["data_types"] == "a, b" and "Base" not in table


def test_sinks(spark, items, schemas, tmp_path):
    assert sinks.write_schemas(compile.schemas(items, "org.example-"), str(tmp_path)) == ["Alone", "Assay", "Base", "Plain"]
    assert json.loads((tmp_path / "Assay.json").read_text()) == schemas["Assay"]
    assert sinks.enum_yaml("E", {"b": {"meaning": "x: 1"}, "a": None}).splitlines()[:4] == ["# Generated; changes by hand are lost.", "enums:", "  E:", "    permissible_values:"]
    assert json.loads(sinks.bundle(items))["totals"] == {"classes": 4, "slots": 8, "enums": 4, "values": 9}
    assert [tuple(r) for r in sinks.sssom(items).collect()] == [("Mask#Unknown", "skos:exactMatch", "x:1", "Unknown")]
    assert "`reads` BIGINT" in sinks.ddl(compile.columns(compile.fields(items)).where("class = 'Assay'"), "assay")
    found = spark.createDataFrame([("f", '{"a": 2}')], "field string, values string")
    assert json.loads(sinks.suggestions_json(found, {"least": 2})) == {"suggestions": {"f": {"a": 2}}, "filters": {"least": 2}}
    assert sinks.markdown(found, "T").splitlines()[2] == "| field | values |"
    sinks.append_csv(found, f"{tmp_path}/out", ["field"])
    sinks.append_csv(found.union(spark.createDataFrame([("g", "1")], found.schema)), f"{tmp_path}/out", ["field"], spark.read.csv(f"{tmp_path}/out", header=True))
    assert sorted(r["field"] for r in spark.read.csv(f"{tmp_path}/out", header=True).collect()) == ["f", "g"]
    assert one(spark, sinks.key_values(a=F.col("v"), b=F.lit(None)), v="x") == "a=x\nb="


def test_lookups(spark, items):
    found = lookup.enum_file(spark.createDataFrame([("Sex",), ("None",)], "enum string"), model.enum_values(items))
    assert {r["enum"]: bool(r["file"]) for r in found.collect()} == {"Sex": True, "None": False}
    known = spark.createDataFrame([(1, "o", "n"), (2, "o", "m"), (3, "o", "m")], "id int, org string, name string")
    wanted = spark.createDataFrame([("a", 3, "x", "y"), ("b", 9, "o", "m"), ("c", None, "x", "y")], "key string, id int, org string, name string")
    assert {r["key"]: r["found"] for r in lookup.existing(wanted, known).collect()} == {"a": 3, "b": 2, "c": None}
    relations = spark.createDataFrame([("Assay", "T", "suggests"), ("Gone", "T", "suggests"), ("Assay", "U", "other")], "`from` string, `to` string, property string")
    assert [tuple(r) for r in lookup.suggested(relations, model.classes(items)).collect()] == [("Assay", "T")]
    rows = spark.createDataFrame([({"a": "1", "b": " ", "z": "2"},)], "m map<string,string>")
    assert lookup.annotated(rows, "m", ["a", "b"]).first()["present"] == ["a"]
    files = spark.createDataFrame([("a",), ("b",)], "name string")
    assert [r["name"] for r in lookup.chosen(files, ["a"], ["a"]).collect()] == ["a"] and [r["name"] for r in lookup.chosen(files, exclude=["a"]).collect()] == ["b"]
    versions = spark.createDataFrame([("a", "1.0.0"), ("b", "1.0.0")], "name string, version string")
    assert lookup.conflicts(versions, versions.where("name = 'a'")).count() == 1
    facts = spark.createDataFrame([("s", "p", "2"), ("s", "p", "1"), ("s", "q", "3")], "s string, p string, o string")
    assert lookup.multimap(facts, "s", "p", "o").first()["properties"] == {"p": ["1", "2"], "q": ["3"]}


def test_lint(spark, items):
    assert [r["schema_name"] for r in lint.dangling(spark.createDataFrame([("Assay",), ("Gone",)], "schema_name string"), items).collect()] == ["Gone"]
    assert lint.unknown_ranges(items, ["string", "integer", "float"]).count() == 0
    assert lint.shared_labels(items).count() == 0
    found = lint.coverage(items, "dataType", spark.createDataFrame([("a",)], "label string"))
    assert sorted(map(tuple, found.collect()), key=str) == [("Alone", "missing", None), ("Assay", "invalid", "b"), ("Plain", "missing", None)]
    assert lint.without_final_newline(spark.createDataFrame([("x", "a"), ("y", "a\n")], "file string, text string")).first()["file"] == "x"


def test_model_graph(items):
    g = graph.model_triples(items)
    assert {r["o"] for r in graph.pattern(g, "?s", "subClassOf", "?o").collect()} == {"Base", "Plain"}
    more = graph.inferred(g)
    assert more.count() >= g.count()
    assert {(r["c"], r["s"]) for r in graph.basic(g, ("?c", "subClassOf", "Base"), ("?c", "slot", "?s")).collect()} == {("Assay", "reads"), ("Assay", "kit")}


def test_closure_ends_on_cycles(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "a"), ("c", None)], "name string, parent string")
    assert {(r["name"], r["ancestor"]) for r in compile.closure(edges).collect()} == {("a", "a"), ("a", "b"), ("b", "b"), ("b", "a"), ("c", "c")}


def test_closure_counts_pairs_and_not_paths(spark):
    """A ladder of 40 diamonds has 2^40 paths; a dense cycle has infinitely many."""
    edges = [(f"a{i}", f"{side}{i}") for i in range(40) for side in "bc"] + [(f"{side}{i}", f"a{i + 1}") for i in range(40) for side in "bc"]
    got = {(r["name"], r["ancestor"]): r["depth"] for r in compile.closure(spark.createDataFrame(edges, "name string, parent string")).collect()}
    assert got["a0", "a40"] == 80 and got["b0", "c39"] == 78 and ("b0", "c0") not in got
    assert len(got) == sum(2 * (40 - i) + 40 - i for i in range(40)) + 2 * sum(2 * (39 - i) + 40 - i for i in range(40)) + 120
    dense = [(f"n{i}", f"n{(i + k) % 30}") for i in range(30) for k in (0, 1, 2, 3)]
    found = spark.createDataFrame(dense, "name string, parent string")
    assert {(r["name"], r["ancestor"]): r["depth"] for r in compile.closure(found).collect()} == {(f"n{i}", f"n{(i + d) % 30}"): -(-d // 3) for i in range(30) for d in range(30)}
    triples = found.select(F.col("name").alias("s"), F.lit("p").alias("p"), F.col("parent").alias("o"))
    assert graph.path_plus(triples, "p").count() == 900  # each node reaches itself, too


def test_closure_is_whole(spark):
    """A chain of 20 steps, climbed 7 at a time, with a short cut from its end and a cycle at its top."""
    edges = [(f"n{i}", f"n{i + 1}") for i in range(20)] + [("n20", "n18"), ("n0", "n3")]
    got = {(r["name"], r["ancestor"]): r["depth"] for r in compile.closure(spark.createDataFrame(edges, "name string, parent string")).where("name IN ('n0', 'n19')").collect()}
    want = {("n0", f"n{i}"): i if i < 3 else i - 2 for i in range(21)} | {("n19", "n19"): 0, ("n19", "n20"): 1, ("n19", "n18"): 2}
    assert got == want


def test_no_rule_is_dropped(spark):
    patterns = spark.range(1_001).selectExpr("id AS ord", "concat('p', id) AS pattern", "'t' AS target")
    with pytest.raises(ValueError):
        sync.first_route(spark.createDataFrame([("p1000",)], "url string"), "url", patterns)
    rules = spark.range(1).selectExpr("'REPLACE' AS kind", "transform(sequence(0, 1200), x -> concat('t', x)) AS terms")
    assert synonyms.rewrites(rules).count() == 1_200


def test_merge_reaches_leaves(spark):
    rows = [("slot", "s", None, 0, '{"a": {"x": 1, "y": {"z": [1]}}, "b": null}', "1"), ("slot", "s", None, 0, '{"a": {"y": {"z": [2], "w": 3}}, "b": {}}', "2"), ("value", "E", "l", 0, '{"m": 1}', "1"), ("value", "E", "l", 1, '{"n": 2}', "2")]
    got = {r["name"]: json.loads(r["body"]) for r in model.merged(spark.createDataFrame(rows, model.ITEM)).collect()}
    assert got == {"s": {"a": {"x": 1, "y": {"z": [2], "w": 3}}, "b": {}}, "E": {"m": 1, "n": 2}}


def test_titles(spark):
    rows = [("class", "C", None, 0, '{"description": "d"}', "f"), ("class", "A", None, 1, '{"abstract": true, "description": "d"}', "f"), ("enum", "E", None, 0, '{"description": "e\\n"}', "f"), ("value", "E", "v", 0, "{}", "f")]
    for i, (slot, body) in enumerate({"x": '{"range": "E", "description": "own"}', "y": '{"range": "E"}', "z": '{"range": "E", "multivalued": true}'}.items()):
        rows += [("class_slot", "C", slot, i, "{}", "f"), ("slot", slot, None, i, body, "f")]
    items = spark.createDataFrame(rows, model.ITEM)
    shown = lambda **o: {r["class"]: json.loads(r["json"]) for r in compile.schemas(items, **o).collect()}
    plain, shared = shown(), shown(shared_titles=True)
    assert {k: p["title"] for k, p in plain["C"]["properties"].items()} == {"x": "x", "y": "y", "z": "z"}
    assert {k: p["title"] for k, p in shared["C"]["properties"].items()} == {"x": "y", "y": "y", "z": "z"}
    assert plain["C"]["properties"]["x"]["description"] == "e" and plain["C"]["properties"]["z"]["items"] == {"description": "e", "title": "E", "type": "string", "enum": ["v"]}
    assert plain["C"]["description"] == "d" and "description" not in plain["A"]


def test_csv_findings(spark):
    files = [("a", 'x,y\r\n"1,\n""2",3\r\n\r\n4,5,"6"'), ("b", "x\n1,2\n"), ("c", ""), ("d", None)]
    got = sorted(map(tuple, browse.csv_findings(spark.createDataFrame(files, "file string, text string")).collect()))
    assert got == [("a", 3, 1, 2), ("a", 4, 3, 2), ("b", 2, 2, 1)]


def test_lengths_of_lists(spark):
    rows = spark.createDataFrame([("abc", ["a", "abcd"]), (None, None)], "s string, l array<string>")
    assert {tuple(r) for r in browse.lengths(rows, "s", "l", limit=2).collect()} == {("s", 3, 1), ("l", 4, 1)}


def test_deep_blank_nodes(spark):
    """A chain of seven blank nodes under fresh names is the same graph, and so are two that name each other."""
    schema = "s string, p string, o string, s_kind string, o_kind string"
    chain = lambda x: spark.createDataFrame([("a", "p", f"_:{x}0", "iri", "bnode"), *[(f"_:{x}{i}", "p", f"_:{x}{i + 1}", "bnode", "bnode") for i in range(6)], (f"_:{x}6", "p", "end", "bnode", "literal")], schema)
    facts = lambda g: {tuple(r) for r in graph.canonical(g).collect()}
    assert facts(chain("u")) == facts(chain("v"))
    loop = spark.createDataFrame([("_:a", "p", "_:b", "bnode", "bnode"), ("_:b", "p", "_:a", "bnode", "bnode")], schema)
    turned = loop.select(*[F.translate(c, "ab", "yx").alias(c) if c in ("s", "o") else F.col(c) for c in loop.columns])
    assert facts(loop) == facts(turned) and len(facts(loop)) == 2


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'string'}" for k, v in values.items()))
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("function", "value", "want"),
    [
        (text.normalized, "A-b C1!", "abc1"),
        (text.encoded_twice, "a b", "a%2520b"),
        (text.local_name, "http://x.org/a#b%20c+d", "b c+d"),
        (text.last_segment, "a/b/c", "c"),
        (text.humanized, "RNASeqTemplate", "RNA Seq"),
        (text.rrid, " CVCL_1 ", "rrid:CVCL_1"),
        (text.rrid, "RRID:X", "RRID:X"),
        (text.rrid, "  ", None),
        (text.version, "1.10.2", [1, 10, 2]),
        (text.version, "1.x", [0, 0, 0]),
        (text.first_sentence, "One. Two.", "One"),
        (text.unwrapped, "string(a b)", "a b"),
        (text.unwrapped, "other", None),
        (text.escaped_html, '<a & "b">', "&lt;a &amp; &quot;b&quot;&gt;"),
        (text.tokens, "A-b, c3!", ["a", "b", "c3"]),
        (text.split_packed, " a ;; b;", ["a", "b"]),
        (text.is_true, "1", True),
        (text.template_of, "org.x-1.RnaTemplate.1", "RnaTemplate"),
        (text.schema_id, "https://x/org.a-name-1.2.3", ("org.a", "name")),
        (lambda c: text.expand_curie(c, {"X": "http://x/"}), "X:a:b", "http://x/a:b"),
        (lambda c: text.expand_curie(c, {"X": "http://x/"}), "Y:a", "Y:a"),
        (lambda c: text.expand_curie(c, {"http": "bad"}), "http://a", "http://a"),
        (lambda c: text.shortened(c, {"x": "http://x/"}, 3), "http://x/a", "x:a"),
        (lambda c: text.shortened(c, {}, 3), "abcd", "abc..."),
        (lambda c: text.useful_description(c, F.lit("n")), " n ", None),
        (lambda c: text.data_type(c, F.lit("f")), "ATemplate", "A-f"),
    ],
)
def test_functions(spark, function, value, want):
    assert one(spark, function(F.col("v")), v=value) == want


def test_synonyms(spark):
    assert synonyms.filtered("NF1 gene", ["NF1 gene", "nf1-gene", "neurofibromin 1", "neurofibromin  1!", "neurofibromin 2", "other"]) == ["neurofibromin 1", "other"]
    df = spark.createDataFrame([("a", ["A", "bb", "b-b"]), ("x", None)], "term string, synonyms array<string>")
    assert [r["synonyms"] for r in synonyms.filter_synonyms(df).orderBy("term").collect()] == [["bb"], []]
    assert one(spark, synonyms.cleaned_aliases(F.col("a"), F.lit("x y")), a=["X-Y", "z"]) == ["z"]
    assert one(spark, synonyms.merged_aliases(F.col("a"), F.array(F.lit("z"), F.lit("q"))), a=["z", "y"]) == ["z", "y", "q"]
    rules = spark.createDataFrame([("EQUIVALENT", ["a", "b"]), ("REPLACE", ["c", "d"]), ("KEEP", ["e", "f g"]), ("EXPLICIT", ["h", "i"])], "kind string, terms array<string>")
    assert [synonyms.expanded(q, rules) for q in "abcdezh"] == [["a", "b"], ["a", "b"], ["d"], ["d"], ["e", "f g"], ["z"], ["i"]]
    docs = spark.createDataFrame([(1, "x F, G"), (2, "fg"), (3, "E")], "i int, t string")
    assert {r["i"] for r in synonyms.search(docs, "t", "e", rules).collect()} == {1, 3}


def test_profile(spark):
    df = spark.createDataFrame([(1, " a ", ["x", None, "y"]), (2, "b", []), (3, "a", None), (4, " ", ["x"])], "id int, s string, l array<string>")
    values = profile.annotations(df, "id", ["s", "l"])
    assert sorted((r["field"], r["value"]) for r in values.collect()) == [("l", "x"), ("l", "x"), ("l", "y"), ("s", "a"), ("s", "a"), ("s", "b")]
    allowed = spark.createDataFrame([("s", "a")], "field string, value string")
    assert [tuple(r) for r in profile.unmatched(values, allowed).collect()] == [("l", "x", 2)]
    fields = spark.createDataFrame([("s", "E")], "field string, enum string")
    words = spark.createDataFrame([("E", "a", ["b"]), ("E", "c", None)], "enum string, label string, aliases array<string>")
    assert {r["value"] for r in profile.allowed_values(fields, words).collect()} == {"a", "b", "c"}
    assert one(spark, profile.target_enum(F.col("e")), e=["OtherX", "Y"]) == "Y"
    ranges = spark.createDataFrame([("f", ["string", "AEnum"]), ("g", ["AEnum"])], "field string, ranges array<string>")
    assert [r["field"] for r in profile.open_vocabulary(ranges).collect()] == ["f"]


def test_sync(spark):
    rows = spark.createDataFrame([(" a ", 1), ("b", 2), (None, 3)], "k string, v int")
    links = spark.createDataFrame([("a", "u"), ("a ", "u")], "k string, url string")
    assert sorted((r["v"], r["url"]) for r in sync.linked(rows, links, "k").collect()) == [(1, "u"), (2, None), (3, None)]
    assert sync.complete(rows, "k").count() == 2
    assert one(spark, sync.routed(F.col("x"), [("cell line", "c"), ("mouse", "m")]), x="A Mouse") == "m"


def test_graph(spark):
    facts = [("a", "sub", "b", "iri", "iri"), ("b", "sub", "c", "iri", "iri"), ("c", "rule", "_:1", "iri", "bnode"), ("_:1", "x", "1", "bnode", "literal")]
    schema = "s string, p string, o string, s_kind string, o_kind string"
    g = spark.createDataFrame(facts, schema)
    again = spark.createDataFrame([(s.replace(":1", ":9"), p, o.replace(":1", ":9"), a, b) for s, p, o, a, b in facts], schema)
    assert graph.modified(g, again).count() == 2  # fresh names of blank nodes look like changes
    assert graph.modified(graph.canonical(g), graph.canonical(again)).count() == 0
    assert {tuple(r) for r in graph.path_plus(g, "sub").collect()} == {("a", "b"), ("b", "c"), ("a", "c")}
    assert [r["x"] for r in graph.pattern(g.union(spark.createDataFrame([("z", "sub", "z", "iri", "iri")], schema)), "?x", "sub", "?x").collect()] == ["z"]


def test_readers(spark, tmp_path):
    (tmp_path / "a.nt").write_text('<http://x/a> <http://p> "v \\"q\\""@en .\n# no\n\n_:b <http://p> <http://x/c> .\n<http://x/a> <http://n> "1"^^<http://int> .\n')
    got = {tuple(r) for r in model.read_ntriples(spark, f"{tmp_path}/a.nt").collect()}
    blank = next(s for s, *_ in got if s.startswith("_:")).removeprefix("_:").removesuffix(".b")
    assert blank[0] == "f" and len(blank) == 9
    assert got == {("http://x/a", "http://p", 'v "q"', "iri", "literal", None, "en"), (f"_:{blank}.b", "http://p", "http://x/c", "bnode", "iri", None, None), ("http://x/a", "http://n", "1", "iri", "literal", "http://int", None)}
    (tmp_path / "t.csv").write_text('Term,URLs,Synonyms\na,u,"x; y"\nb,u,\na,w,z\n')
    terms = {r["Term"]: r["URLs"] for r in model.read_terms(spark, f"{tmp_path}/t.csv").collect()}
    assert terms == {"a": "w", "b": "u"}
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "m.yaml").write_text("title: t\nmapping:\n- source: A\n  target: {label: b, comment: c}\n- {source: B, target: d}\n- {source: C}\n")
    assert [tuple(r)[1:] for r in model.read_concept_maps(spark, f"{tmp_path}/m").orderBy("ord").collect()] == [(0, "A", "b", "c"), (1, "B", "d", None), (2, "C", None, None)]
    (tmp_path / "f.json").write_text('{"manifest_schemas": [{"display_name": "A", "schema_name": "a", "type": "record"}]}')
    assert model.read_templates(spark, f"{tmp_path}/f.json").first()["schema_name"] == "a"


def test_browse(spark):
    rows = spark.createDataFrame([("a", 1), ("b", None)], "n string, tier int")
    assert [r["n"] for r in browse.by_tier(rows, "tier", "n").collect()] == ["a", "b"]
    assert browse.contains(rows, "x", "n").count() == 0 and browse.contains(rows, "A ", "n").count() == 0
    assert browse.facets(rows, search=F.col("n") == "b", tier=1).first()["n"] == "b"


def test_drift_stream(spark, tmp_path):
    events = spark.createDataFrame([("2024-01-01 00:10:00", "a"), ("2024-01-01 00:20:00", "z"), ("2024-01-01 05:00:00", "a")], "t string, v string").withColumn("t", F.col("t").cast("timestamp"))
    events.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(events.schema).parquet(f"{tmp_path}/in")
    q = drift.drift(stream, "t", "v", F.col("v") == "a").writeStream.format("memory").queryName("drifted").outputMode("append").option("checkpointLocation", f"{tmp_path}/c").start()
    q.processAllAvailable()
    q.stop()
    assert {(r["value"], r["unknown"]) for r in spark.table("drifted").collect()} == {("a", 0), ("z", 1)}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def rows_of(columns, rows):
    plain = lambda v: round(v, 6) if isinstance(v, float) else str(list(v)) if isinstance(v, (list, tuple)) else str(v)
    return sorted(tuple(str(plain(r[columns.index(c)])) for c in sorted(columns)) for r in rows)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(SQL))
def test_queries(spark, duck, name):
    got = QUERIES[name](spark, DATA)
    want = duck.sql(SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of(want.columns, want.fetchall())


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).limit(1).count() == 1 if os.path.isdir(DATA) else True
    if importlib.util.find_spec("tesserae.llm") is None:
        assert not any(k.startswith("op") for k in entry.queries())


# --- Turtle and blank nodes -------------------------------------------------------------------------

TURTLE = r'''@prefix ex: <http://e.org/x#> . # a comment
@base <http://e.org/dir/doc> .
PREFIX xsd: <http://www.w3.org/2001/XMLSchema#>
ex:a a ex:C ; ex:p "xé\n\"q\"\\", 'y'@en-GB , """long "" "quoted"
line"""^^xsd:string ; ; ex:n 1 , -2.5 , 1e3 .
<#rel> ex:sub [ a ex:R ; ex:on ex:part\.of ; ex:some [ ex:deep () ] ] ; ex:list ( 1 "two" [ ex:k true ] ) .
_:b1 ex:q _:b1.x . [ ex:alone "\U0001F600 yes" ] .
<up> ex:p%20q ex:a:b.c .
'''
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
TWIN = r'''<http://e.org/x#a> <RDFtype> <http://e.org/x#C> .
<http://e.org/x#a> <http://e.org/x#p> "xé\n\"q\"\\" .
<http://e.org/x#a> <http://e.org/x#p> "y"@en-GB .
<http://e.org/x#a> <http://e.org/x#p> "long \"\" \"quoted\"\nline" .
<http://e.org/x#a> <http://e.org/x#n> "1"^^<http://www.w3.org/2001/XMLSchema#integer> .
<http://e.org/x#a> <http://e.org/x#n> "-2.5"^^<http://www.w3.org/2001/XMLSchema#decimal> .
<http://e.org/x#a> <http://e.org/x#n> "1e3"^^<http://www.w3.org/2001/XMLSchema#double> .
<http://e.org/dir/doc#rel> <http://e.org/x#sub> _:r .
_:r <RDFtype> <http://e.org/x#R> .
_:r <http://e.org/x#on> <http://e.org/x#part.of> .
_:r <http://e.org/x#some> _:d .
_:d <http://e.org/x#deep> <RDFnil> .
<http://e.org/dir/doc#rel> <http://e.org/x#list> _:l1 .
_:l1 <RDFfirst> "1"^^<http://www.w3.org/2001/XMLSchema#integer> .
_:l1 <RDFrest> _:l2 .
_:l2 <RDFfirst> "two"^^<http://www.w3.org/2001/XMLSchema#string> .
_:l2 <RDFrest> _:l3 .
_:l3 <RDFfirst> _:k .
_:k <http://e.org/x#k> "true"^^<http://www.w3.org/2001/XMLSchema#boolean> .
_:l3 <RDFrest> <RDFnil> .
_:x <http://e.org/x#q> _:y .
_:z <http://e.org/x#alone> "\U0001F600 yes" . # said alone
<http://e.org/dir/up> <http://e.org/x#p%20q> <http://e.org/x#a:b.c> .
'''.replace("RDF", RDF)


def test_turtle_equals_its_ntriples(spark, tmp_path):
    (tmp_path / "a.ttl").write_text(TURTLE)
    (tmp_path / "a.nt").write_text("# twin\n\n" + TWIN)
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b.ttl").write_text("<x> <y> _:b1 . _:1 <y> [] .")
    (tmp_path / "bad.ttl").write_text("@prefix e: <http://e/> .\ne:a e:b e:c .\ne:a e:b ] .")
    rows = turtle.read_turtle(spark, str(tmp_path)).persist()
    errors = rows.where("s_kind = 'error'").collect()
    assert len(errors) == 1 and errors[0]["o"].startswith("line 3: ") and errors[0]["file"].endswith("bad.ttl") and rows.where("file LIKE '%bad.ttl'").count() == 1
    mine, twin = rows.where("file LIKE '%/a.ttl'"), model.read_ntriples(spark, f"{tmp_path}/a.nt")
    full = ["p", "o", "o_kind", "datatype", "lang"]
    literal = lambda g: sorted(map(repr, g.where("o_kind <> 'bnode'").select(*full).collect()))
    assert literal(mine) == literal(twin) and mine.count() == twin.count() == 23
    canon = lambda g: sorted(map(tuple, graph.canonical(g.where("p <> 'http://e.org/x#q'")).collect()))
    assert canon(mine) == canon(twin)
    names = [{r["s"] for r in rows.where(f"file LIKE '%/{f}.ttl' AND s_kind = 'bnode'").collect()} | {r["o"] for r in rows.where(f"file LIKE '%/{f}.ttl' AND o_kind = 'bnode'").collect()} for f in "ab"]
    assert not names[0] & names[1] and len(names[1]) == 3  # blank nodes of two files, and given and made names, stay apart


@pytest.mark.parametrize(
    "text",
    ["ex:a ex:b ex:c .", "<a> <b> .", "<a> <b> <c>", "<a> <b> [ <c> <d> .", "'x' <b> <c> .", "<a> _:b <c> .", "<a> <b> <c> , .", "@prefix x <y> .", '<a> <b> "x\\q" .', "<a> <b> ( 1 ] .", "<a b> <c> <d> .", "[] .", "<a> <b> 1 2 .", "<a> a ; .", '<a> <b> "open', "<a> <b> 'x'^^ .", "@base <x>", "<a> <b> a ."],
)
def test_turtle_errors(text):
    with pytest.raises(ValueError, match="line 1"):
        list(turtle.parse(text))


def test_parsed_triples_are_not_broadcast(spark, tmp_path):
    """A file of some kB makes documents of 3 MB: their triples are not joined by its size."""
    spark.range(6_000).coalesce(1).write.parquet(str(tmp_path / "t"))
    text = F.concat(F.lit("<a:"), F.col("id"), F.lit("> <a:p> ( 1 ) ; <a:q> '"), F.repeat(F.lit("x"), 500), F.lit("' ."))
    g = turtle.parsed(spark.read.parquet(str(tmp_path / "t")).select("id", text.alias("text")), "text", "id")
    found = graph.basic(g, ("?s", "a:p", "?l"), ("?l", turtle.RDF + "first", "?x"), ("?s", "a:q", "?q"))
    assert len(found.collect()) == 6_000
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_turtle_nests_deep():
    assert len(list(turtle.parse("<a> <b> " + "[ <c> ( " * 5_000 + "1" + " ) ]" * 5_000 + " ."))) == 15_001


def test_path_through_a_blank_restriction(spark, tmp_path):
    (tmp_path / "o.ttl").write_text("""@prefix e: <http://e/> . e:A e:sub e:B , [ a e:Restriction ; e:on e:has ; e:some e:X ] .
    e:B e:sub [ a e:Restriction ; e:on e:lacks ; e:some e:Y ] , [ e:on e:has ; e:some e:Z ] . e:X e:label "x" .""")
    g = turtle.read_turtle(spark, str(tmp_path))
    found = graph.basic(g, ("?c", "http://e/sub", "?r"), ("?r", RDF + "type", "http://e/Restriction"), ("?r", "http://e/on", "http://e/has"), ("?r", "http://e/some", "?x"))
    assert [(r["c"], r["x"]) for r in found.collect()] == [("http://e/A", "http://e/X")]


def shuffled(edges, seed):
    r = random.Random(seed)
    names = sorted({x for s, _, o in edges for x in (s, o) if x.startswith("_:")})
    new = dict(zip(names, r.sample([f"_:n{i}" for i in range(10 * len(names))], len(names)), strict=True))
    out = [(new.get(s, s), p, new.get(o, o)) for s, p, o in edges]
    r.shuffle(out)
    return out


@pytest.mark.parametrize("name", ["ring", "marked", "two_triangles", "complete", "tail"])
def test_canonical_cycles(spark, name):
    """Renamed graphs become equal, facts and nodes are kept, and a graph that differs by a fact stays different."""
    ring = lambda tag, n: [(f"_:{tag}{i}", "p", f"_:{tag}{(i + 1) % n}") for i in range(n)]
    edges = {
        "ring": ring("a", 6),
        "marked": [*ring("a", 5), ("_:a2", "q", "x"), ("top", "has", "_:a4")],
        "two_triangles": [*ring("a", 3), *ring("b", 3), ("_:b0", "q", "x"), *[(f"_:{k}{i}", "of", "_:hub") for k in "ab" for i in range(3)]],
        "complete": [(f"_:a{i}", "p", f"_:b{j}") for i in range(3) for j in range(3)] + [(f"_:b{j}", "q", f"_:a{i}") for i in range(3) for j in range(3)],
        "tail": [*ring("a", 2), ("_:t", "to", "_:a0"), ("_:u", "to", "_:t"), ("_:u", "is", "u"), ("_:leaf", "v", "1"), ("_:a1", "leaf", "_:leaf")],
    }[name]
    kind = lambda x: "bnode" if x.startswith("_:") else "iri"
    frame = lambda es: spark.createDataFrame([(s, p, o, kind(s), kind(o)) for s, p, o in es], "s string, p string, o string, s_kind string, o_kind string")
    canon = lambda es: {tuple(r)[:3] for r in graph.canonical(frame(es)).collect()}
    one = canon(edges)
    assert one == canon(shuffled(edges, 1)) and len(one) == len(edges)
    assert len({x for s, _, o in one for x in (s, o) if x.startswith("_:")}) == len({x for s, _, o in edges for x in (s, o) if x.startswith("_:")})
    assert canon(shuffled([*edges, (edges[0][0], "more", "y")], 2)) != one


# --- validation as data ------------------------------------------------------------------------------


def by_rules(spark, schemas, records, **options):
    """records: (key, schema, json). {(key, kind, field, rule)} by rules as data, and by one plan a schema."""
    frame = spark.createDataFrame(records, "key int, schema string, json string")
    table = spark.createDataFrame([(k, json.dumps(s)) for k, s in schemas.items()], "schema string, json string")
    data = sorted(map(tuple, rules.validate(frame, rules.rules(table, inline=options.pop("inline", rules.INLINE)), "key", **options).collect()), key=repr)
    one = [tuple(r) for k, s in schemas.items() for r in validate.long_form(validate.validate(frame.where(F.col("schema") == k), s, **options), "key").collect()]
    return data, sorted(one, key=repr)


def made_up(r):
    """A random schema of the supported keywords."""
    label = lambda: r.choice(["a", "b", "c", "yes", 1, 2.5, True, None])

    def value(deep=True):
        s = {}
        if r.random() < 0.4:
            s["type"] = r.choice(["string", "number", "integer", "boolean", "array", "object", ["string", "null"], ["integer", "string"]])
        if r.random() < 0.4:
            s["enum"] = [label() for _ in range(r.randint(1, 4))]
        if r.random() < 0.15:
            s["const"] = label()
        if r.random() < 0.2:
            s["maximum"] = r.choice([1, 2, 2.5])
        if r.random() < 0.2:
            s["minimum"] = r.choice([1, 2, 2.5])
        if r.random() < 0.15:
            s["pattern"] = r.choice(["^a", "e", "b$"])
        if deep and r.random() < 0.3:
            s["anyOf"] = [value(False) for _ in range(r.randint(1, 3))]
        if deep and r.random() < 0.3:
            s["not"] = r.choice([value(False) or {"const": "a"}, {"anyOf": [{"const": label()}, {"type": "integer", "maximum": 1}]}])
        return s

    def part(n):
        names = r.sample("pqrst", n)
        return {"properties": {k: value() | ({"items": value()} if r.random() < 0.3 else {}) for k in names}} | ({"required": r.sample(names, r.randint(1, n))} if r.random() < 0.6 else {})

    s = part(4)
    if r.random() < 0.6:
        s["allOf"] = [{"if": part(r.randint(1, 2)), "then": part(r.randint(1, 2))} for _ in range(r.randint(1, 3))]
    elif r.random() < 0.5:
        s |= {"if": part(1), "then": part(2)}
    if r.random() < 0.2:
        s["not"] = part(1)
    return s


def test_rules_equal_one_plan_a_schema(spark):
    r = random.Random(12)
    schemas = {f"s{i}": made_up(r) for i in range(12)}
    one = lambda: r.choice(["a", "b", "c", "yes", "zebra", 1, 2, 2.0, 2.5, 3, True, False, None, {"x": 1}, [], ["a", 1], [None, "b", 2.5], [["a"]]])
    texts = [json.dumps({k: one() for k in r.sample("pqrst", r.randint(0, 5))}) for _ in range(60)] + ["", "[1]", "{", "3", "null", '{"p": 1e3, "q": 12345678901234567890}']
    records = [(i, k, t) for k in schemas for i, t in enumerate(texts)] + [(0, "s0", None)]
    data, want = by_rules(spark, schemas, records)
    assert data == want and len(want) > 1_000
    data, want = by_rules(spark, schemas, records, null_as_absent=False, inline=1)  # vocabularies leave their checks
    assert data == want


def test_rules_of_no_and_of_unknown_schemas(spark):
    frame = spark.createDataFrame([(1, "a", "{}"), (2, "b", "{}"), (3, None, "{}"), (4, "a", "x")], "key int, schema string, json string")
    table = spark.createDataFrame([("a", '{"required": ["k"]}')], "schema string, json string")
    got = sorted(map(tuple, rules.validate(frame, rules.rules(table), "key").collect()))
    assert got == [(1, "required", "k", None), (2, "schema", "", None), (3, "schema", "", None), (4, "json", "", None)]
    assert rules.validate(frame.where("false"), rules.rules(table), "key").count() == 0
    for bad in ({"properties": {"k": {"anyOf": [{"items": {"type": "string"}}]}}}, {"properties": {"k": {"properties": {}}}, "if": {"not": {}}, "then": {}}):
        with pytest.raises(ValueError, match="not supported"):
            rules.compiled("bad", bad)


def test_long_vocabularies_leave_the_plan(spark, schemas):
    """600 labels give the same violations, none of them stands in the plan, and the plan does not grow with properties."""
    labels = [f"label {i}" for i in range(600)]
    wide = {"properties": {f"p{i}": {"enum": labels} for i in range(54)} | {"many": {"type": "array", "items": {"type": "string", "enum": labels}}}}
    wide["allOf"] = [{"if": {"properties": {"p1": {"const": "label 1"}}, "required": ["p1"]}, "then": {"properties": {"p2": {"enum": labels[:300]}}}}]
    texts = [{"p0": "label 1", "p1": "label 1", "p2": "label 400", "many": ["label 5", "x", "y"]}, {"p0": "label 600", "p53": 7, "p2": "label 400", "many": "label 1"}, {"p1": None, "many": []}]
    records = [(i, "wide", json.dumps(t)) for i, t in enumerate(texts)]
    frame, table = spark.createDataFrame(records, "key int, schema string, json string"), spark.createDataFrame([("wide", json.dumps(wide))], "schema string, json string")
    compiled = rules.rules(table).checkpoint()
    began = time.time()
    found = rules.validate(frame, compiled, "key")
    plan = found._jdf.queryExecution().toString()
    assert time.time() - began < 20 and "label 7" not in plan and "p53" not in plan and "LeftAnti" in plan
    assert sorted(map(tuple, found.collect()), key=repr) == sorted([(0, "enum", "p2", 0), (0, "items", "many", None), (1, "enum", "p0", None), (1, "enum", "p53", None), (1, "type", "many", None), (2, "enum", "p1", None)], key=repr)


def test_rules_on_the_model(spark, schemas):
    """All classes of a compiled model in one plan, records as they stand in its own tests."""
    r = random.Random(5)
    value = lambda: r.choice(["Female", "Male", "days", ">= 90", 5, 0, 2.5, True, None, ["a"], ["Female", "days"], "x"])
    names = sorted({k for s in schemas.values() for k in s.get("properties", {})})
    records = [(i, k, json.dumps({n: value() for n in r.sample(names, r.randint(0, len(names)))})) for k in schemas for i in range(40)]
    data, want = by_rules(spark, schemas, records)
    assert data == want and len(want) > 100


# --- phrases, equal rules, files ---------------------------------------------------------------------


def test_phrases_do_not_bridge_fields(spark):
    docs = spark.createDataFrame([(1, "red", ["big cat", "dog red"], "Cat, dog! cat dog"), (2, None, None, None), (3, "big", ["cat"], "x")], "id int, a string, b array<string>, c string")
    index = postings.postings(docs, "id", "a", "b", "c").persist()
    assert sorted((r["term"], r["place"]) for r in index.where("id = 1").collect()) == sorted([("red", 0), ("big", 101), ("cat", 102), ("dog", 203), ("red", 204), ("cat", 305), ("dog", 306), ("cat", 307), ("dog", 308)])
    wanted = spark.createDataFrame([("cat dog",), ("Red big",), ("big cat",), ("dog cat dog",), ("!",), ("none",)], "phrase string")
    assert sorted(map(tuple, postings.phrases(index, wanted).collect())) == [("big cat", 1, 1), ("cat dog", 1, 2), ("dog cat dog", 1, 1)]


def test_rules_of_equal_purpose(spark):
    one = {"if": {"properties": {"a": {"const": "x"}}, "required": ["a"]}, "then": {"properties": {"b": {"enum": ["p", "q"]}}, "required": ["b", "c"]}}
    same = [
        {"then": {"required": ["c", "b"], "properties": {"b": {"enum": ["q", "p", "q"]}}}, "if": {"required": ["a"], "properties": {"a": {"enum": ["x"]}}}},
        {"if": {"allOf": [{"properties": {"a": {"const": "x"}}, "required": ["a"]}]}, "then": {"properties": {"b": {"anyOf": [{"const": "q"}, {"enum": ["p"]}]}}, "required": ["c", "b"], "allOf": []}},
    ]
    other = [{"if": one["if"], "then": {"required": ["b"]}}, {"if": {"properties": {"a": {"const": "y"}}, "required": ["a"]}, "then": one["then"]}, {"if": {"properties": {"a": {"const": "x"}}}, "then": one["then"]}]
    assert {compile.digest(r) for r in same} == {compile.digest(one)} and len({compile.digest(r) for r in [one, *other]}) == 4
    assert compile.normal({"properties": {"required": {"enum": [2, 1]}, "anyOf": {"const": 1}}}) == {"properties": {"anyOf": {"const": 1}, "required": {"enum": [1, 2]}}}  # names of properties are no keywords
    schemas = spark.createDataFrame([("ATemplate", json.dumps({"allOf": [same[0], other[0]]})), ("BTemplate", json.dumps({"title": "B", **same[1]})), ("CTemplate", json.dumps(other[2])), ("DTemplate", "{}"), ("E", "{}")], "class string, json string")
    added = {r["class"]: r for r in compile.with_conditionals(schemas, one).collect()}
    assert {k for k, r in added.items() if r["added"]} == {"CTemplate", "DTemplate"}
    assert json.loads(added["CTemplate"]["json"])["allOf"] == [other[2], one] and json.loads(added["ATemplate"]["json"])["allOf"] == [same[0], other[0]]
    again = compile.with_conditionals(spark.createDataFrame([(k, r["json"]) for k, r in added.items()], "class string, json string"), one)
    assert again.where("added").count() == 0 and {r["class"]: r["json"] for r in again.collect()} == {k: r["json"] for k, r in added.items()}
    digests = compile.rule_digests(schemas).groupBy("digest").count().collect()
    assert sorted(r["count"] for r in digests) == [1, 1, 2]


def test_files_are_put_in_place_whole(spark, tmp_path):
    rows = spark.createDataFrame([("a b=c.txt", "one\ntwo\n"), ("é.json", "{}"), ("empty", "")], "name string, text string").repartition(3)
    folder = f"file://{tmp_path}/out"
    assert sinks.write_files(rows, folder) == ["a b=c.txt", "empty", "é.json"]
    read = lambda: {p.name: p.read_text() for p in (tmp_path / "out").iterdir() if not p.name.endswith(".crc")}
    assert read() == {"a b=c.txt": "one\ntwo\n", "é.json": "{}\n", "empty": "\n"}
    fails = rows.union(spark.createDataFrame([("z", "new"), ("a b=c.txt", "other")], rows.schema)).withColumn("text", F.when(F.col("name") == "z", F.raise_error(F.lit("no"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="no"):
        sinks.write_files(fails, folder)
    assert read() == {"a b=c.txt": "one\ntwo\n", "é.json": "{}\n", "empty": "\n"}  # nothing half written, nothing left over
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.files.link./out", f"file://{tmp_path}/out")
    assert sinks.write_files(spark.createDataFrame([("empty", "now not")], rows.schema), "viewfs://files/out") == ["empty"] and read()["empty"] == "now not\n"


# --- edits in place -----------------------------------------------------------------------------------

MODULE = """# head comment
enums:
  Sex:   # of a person
    permissible_values:
      Male: {meaning: "x:1", aliases: [M, man]}

      Female:
        description: 'a  b'
        aliases:
        - F   # short
        - woman
      # behind the last one
  Unit:
    permissible_values:
  Tool:
    description: |
      two
      lines

    permissible_values: {}
slots:
  age: {range: integer}
  'note': text
"""


def test_edits_leave_the_rest_alone():
    import difflib

    import yaml

    from tesserae.sources import edits

    cases = [
        ("put", ["enums", "Sex", "permissible_values", "Other"], {"description": "n: 1", "aliases": ["O"]}),
        ("put", ["enums", "Sex", "permissible_values", "Female", "description"], "new: text"),
        ("append", ["enums", "Sex", "permissible_values", "Female", "aliases"], "girl # not a comment"),
        ("append", ["enums", "Sex", "permissible_values", "Male", "aliases"], "boy"),
        ("put", ["enums", "Sex", "permissible_values", "Male", "source"], "https://x"),
        ("put", ["enums", "Unit", "permissible_values", "days"], None),
        ("put", ["enums", "Tool", "permissible_values", "hammer"], {}),
        ("put", ["enums", "Tool", "description"], "one line"),
        ("put", ["slots", "note"], 5),
        ("put", ["slots", "age", "range"], "number"),
        ("put", ["slots", "new", "deep", "er"], [1, {"a": "b"}]),
        ("remove", ["enums", "Sex", "permissible_values", "Male"], None),
        ("remove", ["enums", "Tool", "description"], None),
        ("put", ["prefixes", "x"], "http://x/"),
    ]
    for text in (MODULE, MODULE.removesuffix("\n")):
        for case in cases:
            [(n, line, start, end, new, error)] = edits.script(text, [case])
            assert error is None, (case, error)
            edited = text[:start] + new + text[end:]
            assert yaml.safe_load(edited) == edits._expected(yaml.safe_load(text), *case) != yaml.safe_load(text)
            lost = [x for x in difflib.ndiff(text.splitlines(), edited.splitlines()) if x[0] == "-"]
            assert len(lost) <= (4 if case[0] == "remove" or case[1][-1] == "description" else 1), (case, lost)
        whole = edits.script(text, cases)
        assert [x[0] for x in whole] == list(range(14)) and not any(x[5] for x in whole)
        for _, _, start, end, new, _ in whole:
            text = text[:start] + new + text[end:]
        assert all(f"{c}\n" in text for c in ("# head comment", "  Sex:   # of a person", "        - F   # short", "      # behind the last one"))
        assert edits.script(text, [c for c in cases if c[0] != "remove" and "Male" not in c[1] and c[1] != ["enums", "Tool", "description"]]) == []  # again changes nothing
    bad = [("put", ["slots", "note", "x"], 1), ("append", ["slots", "age"], 1), ("remove", ["slots", "age", "range"], None), ("other", ["a"], 1), ("put", [], 1)]
    assert all(x[5] for x in edits.script(MODULE, bad)) and len(edits.script(MODULE, bad)) == 5
    assert edits.script("a: [", [("put", ["b"], 1)])[0][5] and edits.script("", [("put", ["a", "b"], 1)])[0][4] == "a:\n  b: 1\n"


def test_edits_as_rows(spark, tmp_path):
    from tesserae.sources import edits

    (tmp_path / "a.yaml").write_text(MODULE)
    (tmp_path / "b.yaml").write_text("x: 1 # one\n")
    (tmp_path / "c.yaml").write_text("left: alone\n")
    files = spark.read.text(str(tmp_path), wholetext=True).select(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"), F.col("value").alias("text"))
    asked = [("a.yaml", 2, "put", ["slots", "age", "range"], '"float"'), ("a.yaml", 1, "put", ["slots", "age", "range"], '"number"'), ("a.yaml", 3, "put", ["slots", "age"], '{"range": "float"}'), ("a.yaml", 4, "append", ["slots", "age"], "1"), ("b.yaml", 1, "put", ["x"], "2"), ("none.yaml", 1, "put", ["x"], "2")]
    found = edits.scripted(files, spark.createDataFrame(asked, "file string, ord int, action string, keys array<string>, value string")).persist()
    assert sorted(map(tuple, edits.counts(found).collect())) == [("a.yaml", 2, 1), ("b.yaml", 1, 0)]
    assert {r["line"] for r in found.where("file = 'a.yaml' AND error IS NULL").collect()} == {MODULE.splitlines().index("  age: {range: integer}") + 1}
    done = edits.applied(files, found).collect()
    assert {r["file"]: (r["text"], r["changes"]) for r in done} == {"a.yaml": (MODULE.replace("integer", "float"), 2), "b.yaml": ("x: 2 # one\n", 1)}
    sinks.write_files(edits.applied(files, found).select(F.col("file").alias("name"), "text"), str(tmp_path))
    assert (tmp_path / "b.yaml").read_text() == "x: 2 # one\n" and (tmp_path / "c.yaml").read_text() == "left: alone\n"


def test_model_through_a_graph(spark, items):
    """Model to triples and back: the same declarations, and whole schemas."""
    told = graph.model_graph(items.where("kind <> 'error'"))
    assert {r["o_kind"] for r in told.where("p = 'member'").collect()} == {"bnode"}
    back = graph.model_items(told.union(told).repartition(3))
    shape = lambda rows: sorted(((r["kind"], r["name"], r["key"], r["ord"], json.dumps(json.loads(r["body"]), sort_keys=True)) for r in rows.collect()), key=repr)
    assert shape(back) == shape(items.where("kind <> 'error'"))
    whole = lambda rows: {r["class"]: json.loads(r["json"]) for r in compile.schemas(rows, "org.example-").collect()}
    assert whole(back) == whole(items)


def test_patterns_do_not_multiply_unasked(spark):
    g = spark.createDataFrame([("a", "p", "b"), ("c", "q", "d")], "s string, p string, o string")
    with pytest.raises(ValueError, match="shares no variable"):
        graph.basic(g, ("?a", "p", "?b"), ("?c", "q", "?d"))
    assert graph.basic(g, ("?a", "p", "?b"), ("?c", "q", "?d"), product=True).count() == 1


def test_small_contracts(spark, tmp_path):
    rows = [("A", False, "common", 5), ("B", True, "common", 9), ("C", None, "internal", 9), ("D", False, None, 2), ("E", False, "rare", 7)]
    cards = spark.createDataFrame(rows, "name string, abstract boolean, tier string, fields int")
    names = lambda df: sorted(r["name"] for r in df.collect())
    tiers = ["common", "rare", "internal"]
    assert names(browse.cards(cards)) == ["A", "C", "D", "E"]
    assert names(browse.cards(cards, tiers=tiers, upto="common")) == ["A"]
    assert names(browse.cards(cards, tiers=tiers, upto="internal", least_fields=3)) == ["A", "E"]
    assert names(browse.cards(cards, F.col("name").isin("B", "C", "D"), tiers, "internal")) == ["B", "C", "D"]
    assert names(lookup.selected(cards, ["E", "A"])) == ["A", "E"]
    with pytest.raises(LookupError, match="Y, Z"):
        lookup.selected(cards, ["A", "Y", "Z"])
    schemas = spark.createDataFrame([("XTemplate",), ("TemplateX",), (None,)], "name string")
    assert names(lookup.suffixed(schemas)) == ["XTemplate"]
    ids = spark.createDataFrame([("org-a-b",), ("org-",), ("-a",), ("org",), (None,)], "id string")
    got = [r["p"] and tuple(r["p"]) for r in ids.select(text.id_parts(F.col("id")).alias("p")).collect()]
    assert got == [("org", "a-b"), None, None, None, None]
    (tmp_path / "a.csv").write_text('anything,other\n"x, ""y""",1\nz,2\n,3\n')
    (tmp_path / "b.csv").write_text("odd\nw\n")
    assert {r["Term"] for r in model.read_first_column(spark, str(tmp_path)).collect()} == {'x, "y"', "z", "w"}
