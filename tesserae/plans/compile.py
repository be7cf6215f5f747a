"""Compilation of model tables into flat record schemas, as DataFrame joins and array folds."""

from __future__ import annotations

import json
from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tesserae.sources import model

DROPPED = ("Filename", "Component")
#: Types of the ranges that are no vocabularies.
SCALARS = {"string": "string", "integer": "integer", "float": "number", "double": "number", "boolean": "boolean", "date": "string"}


def needs_checkpoints(spark: SparkSession) -> None:
    """Checkpoints go to the shared folder that the session names; one of our own is set only on a single machine."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir("/tmp/checkpoints")


def closure(edges: DataFrame) -> DataFrame:
    """edges (name, parent) -> (name, ancestor, depth), each name its own ancestor at depth 0; depths are least ones.

    Semi-naive rounds that double path lengths: once all pairs up to depth d are known, a pair at depth d + e (e from 1 to d)
    is one at depth d joined with one at depth e. Only pairs that are not known yet are kept and written, so neither many
    paths between two names nor cycles make work, and the deepest chain of n names takes log2(n) rounds.
    """
    needs_checkpoints(edges.sparkSession)
    edges = edges.select("name", "parent")
    own = edges.select("name", F.col("name").alias("ancestor"), F.lit(0).alias("depth")).distinct()
    steps = edges.where("parent IS NOT NULL AND name <> parent").select("name", F.col("parent").alias("ancestor"), F.lit(1).alias("depth")).distinct()
    first = known = steps.checkpoint()
    new, reach = first, 1
    while not (tips := new.where(F.col("depth") == reach)).isEmpty():
        longer = tips.select("name", F.col("ancestor").alias("via")).join(known.select(F.col("name").alias("via"), "ancestor", "depth"), "via")
        found = longer.where("name <> ancestor").groupBy("name", "ancestor").agg((F.min("depth") + reach).alias("depth"))
        new = found.join(known.select("name", "ancestor"), ["name", "ancestor"], "left_anti").select("name", "ancestor", "depth").checkpoint()
        known, reach = known.unionByName(new), 2 * reach
    return own.unionByName(known)


def _overlay(outer: Column, own: Column) -> Column:
    """A refinement drops the inherited any_of, then its own keys win."""
    names = [x.split(" ")[0] for x in model.SLOT.replace("struct<range:string>", "x").split(", ")]
    return F.struct(*[(own[n] if n == "any_of" else F.coalesce(own[n], outer[n])).alias(n) for n in names])


def properties(items: DataFrame) -> DataFrame:
    """(class, property, def, order, own_pos) of every concrete class: `def` after inheritance and refinement; order:
    position by nearest class, then slots before attributes; own_pos: position among the class's own, null if inherited."""
    of = model.classes(items)
    chain = closure(of.select("name", F.col("is_a").alias("parent")))
    declared = items.where(F.col("kind").isin("class_slot", "attribute")).select(F.col("name").alias("ancestor"), F.col("key").alias("property"), (F.col("kind") == "attribute").alias("late"), "ord")
    named = chain.join(declared, "ancestor").where(~F.col("property").isin(*DROPPED)).groupBy("name", "property").agg(
        F.min(F.struct("depth", "late", "ord")).alias("order"), F.min(F.when(F.col("depth") == 0, F.struct((~F.col("late")).alias("slot"), "ord"))).alias("own")
    )
    named = named.join(of.where("NOT abstract").select("name"), "name", "left_semi")
    ops = items.where(F.col("kind").isin("attribute", "usage") & (F.col("body") != "{}")).select(F.col("name").alias("ancestor"), F.col("key").alias("property"), (F.col("kind") == "usage").alias("usage"), F.from_json("body", model.SLOT).alias("own"))
    steps = chain.join(ops, "ancestor").groupBy("name", "property").agg(F.array_sort(F.collect_list(F.struct((-F.col("depth")).alias("at"), "usage", "own"))).alias("steps"))
    base = model.slots(items).select(F.col("slot").alias("property"), "def")
    empty = F.from_json(F.lit("{}"), model.SLOT)
    joined = named.join(steps, ["name", "property"], "left").join(base, "property", "left")
    folded = F.aggregate(F.coalesce("steps", F.array().cast(steps.schema["steps"].dataType)), F.coalesce("def", empty), lambda acc, x: F.when(x["usage"], _overlay(acc, x["own"])).otherwise(x["own"]))
    return joined.select(F.col("name").alias("class"), "property", folded.alias("def"), "order", "own")


def fields(items: DataFrame, shared_titles: bool = False) -> DataFrame:
    """(class, property, order, own, required, schema): schema is the property's JSON. A vocabulary brings its name as title and
    its description (an empty one too) to wherever it is inlined; as the only range of a single value its description takes
    the place of the property's. Vocabularies joined to one give their first non-empty description, the property's own first.
    Titles are property names; with shared_titles, single values of one vocabulary all have the last of their names, as in
    schemas that were published so.
    """
    of = properties(items)
    values = model.enum_values(items).groupBy("enum").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "label"))), lambda x: x["label"]).alias("labels"))
    told = items.where("kind = 'enum'").select(F.col("name").alias("range"), F.regexp_replace(F.get_json_object("body", "$.description"), r"\s+$", "").alias("told"))
    several = F.size(F.coalesce("def.any_of", F.array().cast("array<struct<range:string>>"))) > 0
    ranges = F.when(several, F.transform("def.any_of", lambda x: x["range"])).otherwise(F.array(F.coalesce("def.range", F.lit("string"))))
    branches = of.select("class", "property", F.posexplode(ranges).alias("pos", "range")).join(values, F.col("range") == F.col("enum"), "left").join(told, "range", "left")
    kind = F.create_map(*[F.lit(x) for pair in SCALARS.items() for x in pair])
    branch = F.struct("pos", F.when(F.col("enum").isNotNull(), F.lit("string")).otherwise(F.coalesce(kind[F.col("range")], F.lit("string"))).alias("type"), F.col("labels").alias("enum"), F.when(F.col("range") == "date", F.lit("date")).alias("format"), F.col("enum").alias("title"), F.when(F.col("enum").isNotNull(), F.coalesce("told", F.lit(""))).alias("description"))
    gathered = branches.groupBy("class", "property").agg(F.array_sort(F.collect_list(branch)).alias("branches"))
    plain = lambda b: F.struct(*[b[k].alias(k) for k in ("description", "type", "enum", "format", "title")])
    one = F.size("branches") == 1
    closed = F.forall("branches", lambda b: b["enum"].isNotNull())
    union = F.flatten(F.transform("branches", lambda b: b["enum"]))
    first = F.col("branches")[0]
    alike = F.size(F.array_distinct(F.transform("branches", lambda b: b["type"]))) == 1
    shown = F.get(F.filter(F.transform("branches", lambda b: b["description"]), lambda x: x != ""), F.lit(0))  # the first that says anything
    anyof = F.when(~(one | closed), F.transform("branches", plain))
    scalar = F.struct(
        F.when(alike, first["type"]).alias("type"), F.when(one, first["enum"]).when(closed, union).alias("enum"), F.when(one, first["format"]).alias("format"), anyof.alias("anyOf"), F.col("def.pattern").alias("pattern"), F.col("def.minimum_value").alias("minimum"), F.col("def.maximum_value").alias("maximum")
    )
    many = F.coalesce("def.multivalued", F.lit(False))
    listed = F.struct(F.when(one, first["description"]).when(closed, shown).alias("description"), F.when(one, first["title"]).alias("title"), *[scalar[k].alias(k) for k in ("type", "enum", "format", "anyOf", "pattern", "minimum", "maximum")])
    own = F.col("def.description")
    alone = F.when(one & closed & ~many, first["title"])
    title = F.when(alone.isNotNull(), F.max("property").over(W.partitionBy("class", alone))).otherwise(F.col("property")) if shared_titles else F.col("property")
    description = F.when(many, own).when(one & closed, first["description"]).when(closed, F.coalesce(own, shown)).otherwise(own)
    whole = F.struct(
        description.alias("description"), title.alias("title"), F.when(many, F.lit("array")).otherwise(scalar["type"]).alias("type"), F.when(many, listed).alias("items"), *[F.when(~many, scalar[k]).alias(k) for k in ("enum", "format", "anyOf", "pattern", "minimum", "maximum")]
    )
    joined = of.join(gathered, ["class", "property"])
    return joined.select("class", "property", "order", "own", F.coalesce("def.required", F.lit(False)).alias("required"), F.to_json(whole).alias("schema"))


def rules(items: DataFrame) -> DataFrame:
    """(class, rules): if/then JSON texts, own ones first, then those of parent after parent."""
    chain = closure(model.classes(items).select("name", F.col("is_a").alias("parent")))
    of = items.where("kind = 'rule'").select(F.col("name").alias("ancestor"), "ord", "body")
    return chain.join(of, "ancestor").groupBy(F.col("name").alias("class")).agg(F.transform(F.array_sort(F.collect_list(F.struct("depth", "ord", "body"))), lambda x: x["body"]).alias("rules"))


def schemas(items: DataFrame, prefix: str = "", version: str | None = None, shared_titles: bool = False) -> DataFrame:
    """(class, json): one JSON Schema per class. An abstract class accepts any object and has no description."""
    quoted = lambda c: F.regexp_extract(F.to_json(F.array(c)), r"(?s)^\[(.*)\]$", 1)  # noqa: E731  a text as JSON
    own = F.when(F.col("own").isNotNull(), 0).otherwise(1)
    place = F.struct(own.alias("a"), F.when(own == 0, F.col("own")).alias("b"), F.col("property").alias("c"))
    entry = F.struct(place.alias("place"), F.concat(quoted(F.col("property")), F.lit(":"), F.col("schema")).alias("text"))
    by_class = fields(items, shared_titles).groupBy("class").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["text"]), ",").alias("properties"),
        F.transform(F.array_sort(F.collect_list(F.when(F.col("required"), F.struct("order", "property")))), lambda x: x["property"]).alias("required"),
    )
    of = model.classes(items).select(F.col("name").alias("class"), F.regexp_replace("description", r"\s+$", "").alias("description"), "abstract")
    joined = of.join(by_class, "class", "left").join(rules(items), "class", "left")
    id = F.concat(F.lit(prefix), F.lower("class"), F.lit(f"-{version}" if version else ""))
    count = F.when(F.col("abstract"), 0).otherwise(F.coalesce(F.size("rules"), F.lit(0)))
    parts = F.array(
        F.concat(F.lit('"$id":'), quoted(id)),
        F.lit('"$schema":"http://json-schema.org/draft-07/schema#"'),
        F.when(count > 1, F.concat(F.lit('"allOf":['), F.array_join("rules", ","), F.lit("]"))),
        F.when(F.col("description").isNotNull() & ~F.col("abstract"), F.concat(F.lit('"description":'), quoted(F.col("description")))),
        F.when(count == 1, F.expr("substr(rules[0], 2, length(rules[0]) - 2)")),
        F.when(~F.col("abstract"), F.concat(F.lit('"properties":{'), F.coalesce("properties", F.lit("")), F.lit("}"))),
        F.when(F.size("required") > 0, F.concat(F.lit('"required":'), F.to_json("required"))),
        F.concat(F.lit('"title":'), quoted(F.col("class"))),
        F.lit('"type":"object"'),
    )
    return joined.select("class", F.concat(F.lit("{"), F.array_join(F.filter(parts, lambda x: x.isNotNull()), ","), F.lit("}")).alias("json"))


def overlay(schema: dict, rule: dict, id: str | None = None) -> dict:
    """A schema with a rule file's keys on top, without `required`."""
    out = {k: v for k, v in {**schema, **rule}.items() if k != "required"}
    return out | ({"$id": id} if id else {})


def normal(schema):
    """A schema's normal form: what says the same is the same. Sets (required, enum, types) are sorted, one label is a constant,
    constants side by side are a vocabulary, a single allOf or anyOf is what it holds, empty keywords go."""
    if isinstance(schema, list):
        return [normal(x) for x in schema]
    if not isinstance(schema, dict):
        return schema
    key = lambda x: json.dumps(x, sort_keys=True)
    distinct = lambda xs: [json.loads(k) for k in sorted({key(x) for x in xs})]
    literal = ("enum", "const", "required", "default", "examples")
    out = {k: {p: normal(s) for p, s in v.items()} if k == "properties" else v if k in literal else normal(v) for k, v in schema.items()}
    if out.get("anyOf") and all(set(s) in ({"const"}, {"enum"}) for s in out["anyOf"]):
        labels = [x for s in out.pop("anyOf") for x in ([s["const"]] if "const" in s else s["enum"])]
        out["enum"] = [x for x in labels if x in out["enum"]] if "enum" in out else labels
    for k in ("enum", "required", "anyOf", "oneOf", "allOf"):
        if isinstance(out.get(k), list):
            out[k] = distinct(out[k])
    if isinstance(out.get("type"), list):
        out["type"] = sorted(out["type"])
        if len(out["type"]) == 1:
            out["type"] = out["type"][0]
    if len(out.get("enum", [])) == 1 and "const" not in out:
        out["const"] = out.pop("enum")[0]
    for k in ("allOf", "anyOf"):
        if len(out.get(k, [])) == 1 and isinstance(out[k][0], dict) and not set(out[k][0]) & (set(out) - {k}):
            out |= normal(out.pop(k)[0])
    return {k: out[k] for k in sorted(out) if not (k in ("required", "properties", "allOf", "anyOf") and not out[k])}


def conditionals(schema: dict) -> list[dict]:
    """The if/then rules of a schema, those inside allOf first."""
    return [r for r in schema.get("allOf", []) if "if" in r] + ([{k: schema[k] for k in ("if", "then", "else") if k in schema}] if "if" in schema else [])


def digest(rule: dict) -> str:
    """Equal for rules of equal purpose."""
    return sha256(json.dumps(normal(rule), sort_keys=True).encode()).hexdigest()


def rule_digests(schemas: DataFrame) -> DataFrame:
    """schemas (class, json) -> (class, rule, digest), one row per if/then rule: what to join and group rules of equal purpose on."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(c, i, digest(r)) for c, t in zip(batch["class"], batch["json"], strict=True) for i, r in enumerate(conditionals(json.loads(t)))]
            yield pd.DataFrame(rows, columns=["class", "rule", "digest"])

    return schemas.select("class", "json").mapInPandas(run, "class string, rule int, digest string")


def with_conditionals(schemas: DataFrame, rule: dict, suffix: str = "Template") -> DataFrame:
    """(class, json, added): the rule is added to each schema whose class ends with suffix, unless one of equal purpose is there;
    adding again changes nothing."""
    has = rule_digests(schemas).where(F.col("digest") == digest(rule)).select("class").distinct().withColumn("has", F.lit(True))
    text = json.dumps(rule)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["json"] = [json.dumps(with_conditional(json.loads(t), json.loads(text))) if a else t for t, a in zip(batch["json"], batch["added"], strict=True)]
            yield batch

    marked = schemas.join(has, "class", "left").select("class", "json", (F.col("has").isNull() & F.col("class").endswith(suffix)).alias("added"))
    return marked.mapInPandas(run, "class string, json string, added boolean")


def with_conditional(schema: dict, rule: dict) -> dict:
    """The schema with an if/then added unless it has one of equal purpose; adding twice changes nothing."""
    held = schema.get("allOf") or ([{"if": schema["if"], "then": schema["then"]}] if "if" in schema else [])
    if digest(rule) in map(digest, conditionals(schema)):
        return schema
    rest = {k: v for k, v in schema.items() if k not in ("if", "then", "allOf")}
    return rest | {"allOf": [*held, rule]}


def template_table(items: DataFrame) -> DataFrame:
    """(template, parent, description, data_types, assays) of concrete classes, lists sorted and joined, first sentences only."""
    of = model.classes(items).where("NOT abstract")
    listed = lambda k: F.array_join(F.array_sort(F.from_json(F.get_json_object(F.col("annotations")["templateFor"], f"$.{k}"), "array<string>")), ", ")
    return of.select(F.col("name").alias("template"), F.col("is_a").alias("parent"), F.substring_index("description", ".", 1).alias("description"), F.coalesce(listed("dataType"), F.lit("")).alias("data_types"), F.coalesce(listed("assay"), F.lit("")).alias("assays"))


def columns(fields: DataFrame) -> DataFrame:
    """Table columns of a compiled class: (class, property, column_type)."""
    return fields.select("class", "property", column_type(F.col("schema")).alias("column_type"))


def column_type(schema: Column) -> Column:
    """The table column of a property schema: vocabulary and text 80 wide, lists of up to 20. Of a list of types the first that is
    not null counts; of a oneOf its only branch that is not null; text where neither tells."""
    known = lambda raw: F.when(raw.startswith("["), F.get(F.filter(F.from_json(raw, "array<string>"), lambda x: x != "null"), F.lit(0))).otherwise(raw)
    at = lambda path: F.get_json_object(schema, path)
    scalar = lambda kind: F.when(kind == "number", "DOUBLE").when(kind == "integer", "INTEGER").when(kind == "boolean", "BOOLEAN").otherwise("STRING(80)")
    listed = lambda item, enum: F.when(enum.isNotNull(), "STRING_LIST(80x20)").when(item == "integer", "INTEGER_LIST(20)").when(item == "boolean", "BOOLEAN_LIST(20)").otherwise("STRING_LIST(80x20)")
    either = lambda kind, item, enum: F.when(kind == "array", listed(item, enum)).otherwise(scalar(kind))
    branches = F.from_json(at("$.oneOf"), "array<struct<type:string,enum:string,items:struct<type:string,enum:string>>>")
    typed = F.filter(branches, lambda b: b["type"].isNotNull() & (b["type"] != "null"))
    only = F.get(typed, F.lit(0))
    of_branches = F.when(F.exists(branches, lambda b: b["enum"].isNotNull()) | (F.size(typed) != 1), "STRING(80)").otherwise(either(known(only["type"]), known(only["items"]["type"]), only["items"]["enum"]))
    whole = either(known(at("$.type")), known(at("$.items.type")), at("$.items.enum"))
    return F.when(at("$.enum").isNotNull(), "STRING(80)").when(at("$.type").isNull() & branches.isNotNull(), of_branches).otherwise(whole)


def nearest(chain: DataFrame, settings: DataFrame, key: str = "name") -> DataFrame:
    """chain (name, ancestor, depth), settings (ancestor, setting) -> each name's setting of its nearest ancestor that has one."""
    w = W.partitionBy(key).orderBy("depth")
    return chain.join(settings, "ancestor").withColumn("rank", F.row_number().over(w)).where("rank = 1").drop("rank")
