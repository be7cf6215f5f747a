"""Validation as data: schemas become rows of checks, and one plan validates records of any number of schemas.

A schema is one row: its checks as arrays. A check is a keyword of a property, in disjunctive normal form: alternatives of
atoms, an atom being a test of one value. A record is parsed once, its members become a map, and higher-order functions run
the arrays of the record's own schema over it. The plan has the same size for one schema or a thousand, for 5 properties or
500. Long vocabularies do not travel in checks: their labels are a table of their own, which members are anti-joined with.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import product

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesserae.plans.compile import needs_checkpoints
from tesserae.plans.validate import VIOLATION, _once

#: Labels up to which a vocabulary stays in its check, and rows up to which the table of the longer ones is broadcast.
INLINE, BROADCAST_ROWS = 100, 100_000
ATOM = "struct<test:string,negated:boolean,words:array<string>,numbers:array<double>,number:double>"
CHECK = f"struct<field:string,keyword:string,each:boolean,anyof:array<array<{ATOM}>>>"
CONDITIONAL = f"struct<rule:int,refuses:boolean,needs:array<string>,tests:array<{CHECK}>,required:array<string>,checks:array<{CHECK}>>"
RULES = f"schema string, required array<string>, checks array<{CHECK}>, conditionals array<{CONDITIONAL}>, long array<struct<field:string,each:boolean,rule:int,conditional:int,labels:array<string>>>"
KEYWORDS = ("type", "enum", "const", "anyOf", "not", "maximum", "minimum", "pattern", "items")

Atoms = list[list[dict]]


def _atom(test: str, words=(), numbers=(), number=None) -> Atoms:
    return [[{"test": test, "negated": False, "words": list(words), "numbers": list(numbers), "number": number}]]


def _one_of(labels: list) -> Atoms:
    is_number = lambda v: isinstance(v, (int, float)) and not isinstance(v, bool)
    told = lambda v: "s" + v if isinstance(v, str) else "z" if v is None else "b" + str(v).lower()
    return _atom("one", [told(v) for v in labels if isinstance(v, (str, bool)) or v is None], [float(v) for v in labels if is_number(v)])


def alternatives(keyword: str, value) -> Atoms:
    """One keyword of a value as alternatives of atoms."""
    if keyword == "type":
        return _atom("type", value if isinstance(value, list) else [value])
    if keyword in ("enum", "const"):
        return _one_of(value if keyword == "enum" else [value])
    if keyword in ("maximum", "minimum"):
        return _atom(keyword, number=float(value))
    if keyword == "pattern":
        return _atom("pattern", [value])
    if keyword == "anyOf":
        return [a for s in value for a in whole(s)]
    if keyword == "not":
        # none of the alternatives: of each, one atom turned round
        return [list(x) for x in product(*[[a | {"negated": not a["negated"]} for a in alternative] for alternative in whole(value)])]
    raise ValueError(f"`{keyword}` inside a value is not supported")


def whole(schema: dict) -> Atoms:
    """All keywords of a value's schema together; what is no constraint is let pass."""
    unknown = [k for k in schema if k in ("items", "properties", "required", "allOf", "oneOf", "if")]
    if unknown:
        raise ValueError(f"`{unknown[0]}` inside `anyOf`, `not` or `items` is not supported")
    parts = [alternatives(k, schema[k]) for k in KEYWORDS if k in schema]
    return [sum(x, []) for x in product(*parts)]


def _checks(properties: dict) -> list[dict]:
    out = []
    for field, schema in (properties or {}).items():
        for k in KEYWORDS:
            if k in schema and not (k == "items" and not schema[k]):
                each = k == "items"
                out.append({"field": field, "keyword": k, "each": each, "anyof": whole(schema[k]) if each else alternatives(k, schema[k])})
    return out


def compiled(name: str, schema: dict, inline: int = INLINE) -> dict:
    """A schema as a row of RULES. Conditions may speak of properties and of which are there."""
    part = lambda s, what: {"checks": _checks(s.get("properties")), "required": list(s.get("required", []))} if not set(s) & {"allOf", "if", "anyOf"} else _refuse(what)
    conditionals, long = [], []

    def conditional(rule: int | None, condition: dict, then: dict | None) -> None:
        if "not" in condition:
            _refuse("`not` inside a condition")
        of, told = part(condition, "a condition"), part({k: v for k, v in (then or {}).items() if k != "not"}, "`then`")
        conditionals.append({"rule": rule, "refuses": then is None, "needs": of["required"], "tests": of["checks"], "required": told["required"], "checks": told["checks"]})
        if then and "not" in then:
            _refuse("`not` inside `then`")

    if isinstance(schema.get("not"), dict):
        conditional(None, schema["not"], None)
    rules = [*schema.get("allOf", []), *([{"if": schema["if"], "then": schema.get("then", {})}] if "if" in schema else [])]
    for i, rule in enumerate(rules):
        conditional(i, rule["if"], rule.get("then", {}))
    top = {"checks": _checks(schema.get("properties")), "required": list(schema.get("required", []))}
    for at, (place, rule) in enumerate([(top, None), *[(c, c["rule"]) for c in conditionals]]):
        for c in place["checks"]:
            if c["keyword"] not in ("enum", "items") or len(c["anyof"]) != 1:
                continue
            atoms = [a for a in c["anyof"][0] if (a["test"], a["words"]) != ("type", ["string"])]  # labels are texts anyway
            if len(atoms) == 1 and atoms[0]["test"] == "one" and not atoms[0]["negated"] and not atoms[0]["numbers"] and len(atoms[0]["words"]) > inline and all(w[0] == "s" for w in atoms[0]["words"]):
                long.append({"field": c["field"], "each": c["each"], "rule": rule, "conditional": at - 1 if at else None, "labels": atoms[0]["words"]})
                c["anyof"] = _atom("elsewhere")
    return {"schema": name, **top, "conditionals": conditionals, "long": long}


def _refuse(what: str) -> dict:
    raise ValueError(f"{what} is not supported")


def rules(schemas: DataFrame, name: str = "schema", json_text: str = "json", inline: int = INLINE) -> DataFrame:
    """schemas (name, JSON text) -> RULES, one row a schema; a schema that is not supported is an error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([compiled(n, json.loads(t), inline) for n, t in zip(batch["schema"], batch["json"], strict=True)], columns=["schema", "required", "checks", "conditionals", "long"])

    return schemas.select(F.col(name).alias("schema"), F.col(json_text).alias("json")).mapInPandas(run, RULES)


# --- running checks -----------------------------------------------------------------------------------


def _bound(x: Column, of) -> Column:
    """of(x) with x worked out once: inside higher-order functions an expression is worked out as often as it is named."""
    return F.element_at(F.transform(F.array(x), of), 1)


def _told(v: Column, items: bool = False) -> Column:
    """A value as its type, whether a number is whole, its text, its number, and how a vocabulary has it; and the values in a list."""

    def of(k: Column) -> Column:
        numeric = (k == "BIGINT") | k.startswith("DECIMAL") | k.isin("DOUBLE", "FLOAT")
        type = F.when(k == "STRING", "string").when(numeric, "number").when(k == "BOOLEAN", "boolean").when(k.startswith("ARRAY"), "array").when(k.startswith("OBJECT"), "object").otherwise("null")
        # a text is never read as a number: failing to costs more than all the rest
        return F.struct(type.alias("type"), F.when(type.isin("string", "boolean"), F.try_variant_get(v, "$", "string")).alias("text"), F.when(numeric, F.try_variant_get(v, "$", "double")).alias("number"))

    def named(r: Column) -> Column:
        t = r["type"]
        word = F.when(t == "string", F.concat(F.lit("s"), r["text"])).when(t == "boolean", F.concat(F.lit("b"), r["text"])).when(t == "null", "z").otherwise("")
        held = [F.when(t == "array", F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x: _told(x))).alias("items")] if items else []
        return F.struct(t.alias("type"), F.coalesce(r["number"] % 1 == 0, F.lit(False)).alias("integral"), r["text"].alias("text"), r["number"].alias("number"), word.alias("word"), *held)

    return _bound(_bound(F.coalesce(F.schema_of_variant(v), F.lit("VOID")), of), named)


def _met(a: Column, x: Column) -> Column:
    """Whether a value meets an atom; tests of the wrong type are met."""
    plain = (
        F.when(a["test"] == "one", F.array_contains(a["words"], x["word"]) | F.coalesce(F.array_contains(a["numbers"], x["number"]), F.lit(False)))
        .when(a["test"] == "type", F.array_contains(a["words"], x["type"]) | (x["integral"] & F.array_contains(a["words"], F.lit("integer"))))
        .when(a["test"] == "maximum", F.coalesce(x["number"] <= a["number"], F.lit(True)))
        .when(a["test"] == "minimum", F.coalesce(x["number"] >= a["number"], F.lit(True)))
        .when(a["test"] == "pattern", (x["type"] != "string") | F.coalesce(F.rlike(x["text"], a["words"][0]), F.lit(True)))
        .otherwise(F.lit(True))  # a long vocabulary
    )
    return plain != a["negated"]


def _holds(c: Column, members: Column) -> Column:
    """Whether the member that a check is about meets it; an absent one does."""
    value = lambda v: F.exists(c["anyof"], lambda alternative: F.forall(alternative, lambda a: _met(a, v)))
    one = lambda x: x.isNull() | F.when(c["each"], F.coalesce(F.forall(x["items"], value), F.lit(True))).otherwise(value(x))
    return F.exists(F.array(F.try_element_at(members, c["field"])), one)


def _violations(members: Column, absent: Column) -> Column:
    """absent: a function's result per field is not needed: fields not in the map are absent."""
    one = lambda kind, field, rule: F.struct(kind.alias("kind"), field.alias("field"), rule.cast("int").alias("rule"))
    gone = lambda fields, rule: F.transform(F.filter(fields, lambda f: ~F.map_contains_key(absent, f)), lambda f: one(F.lit("required"), f, rule))
    failed = lambda checks, rule: F.transform(F.filter(checks, lambda c: ~_holds(c, members)), lambda c: one(c["keyword"], c["field"], rule))
    applies = lambda r: F.forall(r["needs"], lambda f: F.map_contains_key(members, f)) & F.forall(r["tests"], lambda c: _holds(c, members))
    refused = lambda r: F.when(r["refuses"], F.array(one(F.lit("not"), F.lit(""), r["rule"]))).otherwise(F.array().cast(f"array<{VIOLATION}>"))
    none = F.lit(None)
    conditional = F.flatten(F.transform(F.filter("conditionals", applies), lambda r: F.concat(gone(r["required"], r["rule"]), failed(r["checks"], r["rule"]), refused(r))))
    return F.concat(gone(F.col("required"), none), failed(F.col("checks"), none), conditional)


def _parsed(records: DataFrame, json_text: str) -> DataFrame:
    """records with _members: a map of each member's kind, text, number and items; null if the text is no object."""
    members = F.try_variant_get(F.col("_v"), "$", "map<string,variant>")
    told = F.transform_values(members, lambda _, v: _told(v, items=True))
    object = F.coalesce(F.schema_of_variant("_v"), F.lit("")).startswith("OBJECT")
    parsed = _once(records, {"_v": F.try_parse_json(json_text)})
    return _once(parsed, {"_members": F.when(object, told)}).drop("_v")


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def validate(records: DataFrame, compiled_rules: DataFrame, *keys: str, schema: str = "schema", json_text: str = "json", null_as_absent: bool = False) -> DataFrame:
    """One row per violation: keys, kind, field, rule. records have the name of their schema and a JSON text.

    Text that is no JSON object has one violation of kind `json`, a schema without rules one of kind `schema`. Rules are
    counted and broadcast, or joined; records are read once, and once more where a schema has long vocabularies.
    """
    needs_checkpoints(records.sparkSession)
    known = compiled_rules.checkpoint()
    ruled = records.select(*keys, F.col(schema).alias("_schema"), F.col(json_text).alias("_json")).join(_small(known.drop("long").withColumnRenamed("schema", "_schema").withColumn("_known", F.lit(True))), "_schema", "left")
    parsed = _parsed(ruled, "_json")
    present = F.map_filter("_members", lambda _, x: x["type"] != "null") if null_as_absent else F.col("_members")
    parsed = _once(parsed, {"_present": present}) if null_as_absent else parsed.withColumn("_present", F.col("_members"))
    broken = lambda kind: F.array(F.struct(F.lit(kind).alias("kind"), F.lit("").alias("field"), F.lit(None).cast("int").alias("rule")))
    found = F.when(F.col("_known").isNull(), broken("schema")).when(F.col("_members").isNull(), broken("json")).otherwise(_violations(F.col("_present"), F.col("_present")))
    plain = parsed.select(*keys, F.explode_outer(found).alias("v")).where("v IS NOT NULL").select(*keys, "v.*")
    long = known.select(F.col("schema").alias("_schema"), F.explode("long").alias("l")).select("_schema", "l.*")
    if long.isEmpty():
        return plain
    return plain.unionByName(_outside(records, known, long, keys, schema, json_text, null_as_absent))


def _outside(records: DataFrame, known: DataFrame, long: DataFrame, keys: tuple, schema: str, json_text: str, null_as_absent: bool) -> DataFrame:
    """Violations of long vocabularies: members of their fields, anti-joined with the labels."""
    labels = long.select("_schema", "field", "rule", F.explode("labels").alias("word")).distinct().checkpoint()
    places = F.collect_list(F.struct("field", "each", "rule", "conditional")).alias("places")
    asked = long.groupBy("_schema").agg(places).join(known.select(F.col("schema").alias("_schema"), "conditionals"), "_schema").checkpoint()
    rows = records.select(*keys, F.col(schema).alias("_schema"), F.col(json_text).alias("_json")).withColumn("_row", F.monotonically_increasing_id())
    parsed = _parsed(rows.join(_small(asked), "_schema"), "_json").where("_members IS NOT NULL")
    if null_as_absent:
        parsed = _once(parsed.withColumnRenamed("_members", "_all"), {"_members": F.map_filter("_all", lambda _, x: x["type"] != "null")})
    members = F.col("_members")
    applies = lambda r: F.forall(r["needs"], lambda f: F.map_contains_key(members, f)) & F.forall(r["tests"], lambda c: _holds(c, members))
    met = F.filter("places", lambda p: F.map_contains_key(members, p["field"]) & (p["conditional"].isNull() | applies(F.get(F.col("conditionals"), p["conditional"]))))
    of_item = lambda p, x: F.when(p["each"], F.transform(x["items"], lambda y: y["word"])).otherwise(F.array(x["word"]))
    values = lambda p: F.coalesce(_bound(F.try_element_at(members, p["field"]), lambda x: of_item(p, x)), F.array().cast("array<string>"))
    pairs = F.flatten(F.transform(met, lambda p: F.transform(values(p), lambda w: F.struct(p["field"].alias("field"), p["rule"].alias("rule"), p["each"].alias("each"), w.alias("word")))))
    asked_for = parsed.select(*keys, "_schema", "_row", F.explode(pairs).alias("p")).select(*keys, "_schema", "_row", "p.*")
    of = ["_schema", "field", "word"]
    on = lambda a, b: (a["_schema"] == b["_schema"]) & (a["field"] == b["field"]) & (a["word"] == b["word"]) & a["rule"].eqNullSafe(b["rule"])
    if labels.count() <= BROADCAST_ROWS:
        bad = asked_for.alias("a").join(F.broadcast(labels).alias("l"), on({c: F.col(f"a.{c}") for c in [*of, "rule"]}, {c: F.col(f"l.{c}") for c in [*of, "rule"]}), "left_anti")
    else:  # each distinct value asks once, and only what is unknown is joined back
        distinct = asked_for.select(*of, "rule").distinct()
        unknown = distinct.alias("a").join(labels.alias("l"), on({c: F.col(f"a.{c}") for c in [*of, "rule"]}, {c: F.col(f"l.{c}") for c in [*of, "rule"]}), "left_anti").checkpoint()
        bad = asked_for.alias("a").join(_small(unknown).alias("l"), on({c: F.col(f"a.{c}") for c in [*of, "rule"]}, {c: F.col(f"l.{c}") for c in [*of, "rule"]}), "left_semi")
    kind = F.when(F.col("each"), "items").otherwise("enum")
    return bad.select(*keys, "_row", kind.alias("kind"), "field", "rule").distinct().drop("_row")
