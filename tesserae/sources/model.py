"""Model modules (YAML) as tables.

Files are read by Spark and parsed where they are read, one row per file; what leaves the parser are typed rows. A file that
cannot be parsed gives one row of kind `error` and nothing else. Names that several files declare are merged key by key,
the later file (by path) winning.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce

import pandas as pd
import yaml
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

ITEM = "kind string, name string, key string, ord int, body string, file string"
SLOT = "title string, description string, range string, any_of array<struct<range:string>>, multivalued boolean, required boolean, minimum_value double, maximum_value double, pattern string, ifabsent string"
SECTIONS = ("classes", "slots", "enums")


def condition(slot: dict) -> tuple[dict, bool, bool]:
    """(subschema, whether it names a value, whether the slot must be there) of one slot condition."""
    out: dict = {}
    if "equals_string" in slot:
        out["const"] = slot["equals_string"]
    if "none_of" in slot:
        out["not"] = {"anyOf": [{"const": x["equals_string"]} for x in slot["none_of"]]}
    if "maximum_value" in slot:
        out["maximum"] = slot["maximum_value"]
    if "minimum_value" in slot:
        out["minimum"] = slot["minimum_value"]
    return out, bool(out), slot.get("value_presence") == "PRESENT" or "equals_string" in slot


def conditional(rule: dict) -> dict:
    """A rule as if/then: preconditions always need their slot, postconditions only where they ask for presence."""

    def side(name: str, always: bool) -> dict:
        slots = (rule.get(name) or {}).get("slot_conditions") or {}
        made = {k: condition(v or {}) for k, v in slots.items()}
        out: dict = {"properties": {k: c for k, (c, _, _) in made.items()}}
        needed = [k for k, (c, valued, present) in made.items() if (always or present) and not (not always and valued)]
        if needed:
            out["required"] = needed
        return out

    return {"if": side("preconditions", True), "then": side("postconditions", False)}


def _items(path: str, text: str) -> Iterator[tuple]:
    try:
        module = yaml.safe_load(text) or {}
    except yaml.YAMLError as e:
        yield "error", path, None, 0, str(e)[:500]
        return
    if not isinstance(module, dict):
        yield "error", path, None, 0, "no mapping at the top"
        return
    dump = lambda x: json.dumps(x, default=str)
    for i, (name, c) in enumerate((module.get("classes") or {}).items()):
        c = c or {}
        plain = {k: v for k, v in c.items() if k not in ("slots", "attributes", "slot_usage", "rules")}
        yield "class", name, None, i, dump(plain)
        for kind, part in (("class_slot", {s: {} for s in c.get("slots") or []}), ("attribute", c.get("attributes") or {}), ("usage", c.get("slot_usage") or {})):
            for k, (slot, body) in enumerate(part.items()):
                yield kind, name, slot, k, dump(body or {})
        for k, rule in enumerate(c.get("rules") or []):
            yield "rule", name, None, k, dump(conditional(rule))
    for i, (name, slot) in enumerate((module.get("slots") or {}).items()):
        yield "slot", name, None, i, dump(slot or {})
    for i, (name, e) in enumerate((module.get("enums") or {}).items()):
        values = (e or {}).get("permissible_values") or {}
        yield "enum", name, None, i, dump({k: v for k, v in (e or {}).items() if k != "permissible_values"})
        for k, (label, v) in enumerate(values.items()):
            yield "value", name, str(label), k, dump(v or {})


def read_declarations(spark: SparkSession, path: str) -> DataFrame:
    """All declarations under path, recursively, as each file has them: (kind, name, key, ord, body, file)."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.yaml").text(path, wholetext=True)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(*x, path) for path, text in zip(batch["path"], batch["value"], strict=True) for x in _items(path, text)]
            yield pd.DataFrame(rows, columns=["kind", "name", "key", "ord", "body", "file"])

    return files.select("value", F.col("_metadata.file_path").alias("path")).mapInPandas(parse, ITEM)


def read_modules(spark: SparkSession, path: str) -> DataFrame:
    """The model under path: its declarations, merged."""
    return merged(read_declarations(spark, path))


def merged(items: DataFrame) -> DataFrame:
    """One row per (kind, name, key, and ord of rules): bodies of later files win key by key, at every depth; lists are replaced."""
    by = ["kind", "name", "key", F.when(F.col("kind") == "rule", F.concat_ws("#", "file", "ord")).alias("rule")]
    body = F.struct("file", "ord", "body")
    rows = items.groupBy(*by).agg(F.array_sort(F.collect_list(body)).alias("all"), F.max(body).alias("last"))
    several = F.when((F.size("all") > 1) & ~F.col("kind").isin("rule", "error"), F.transform("all", lambda x: x["body"]))
    whole = F.coalesce(_laid_over(several), F.col("last.body"))
    return rows.select("kind", "name", "key", F.col("last.ord").alias("ord"), whole.alias("body"), F.col("last.file").alias("file"))


def _over(held, new):
    """new on top of held: mappings key by key, anything else replaced."""
    return held | {k: _over(held.get(k), v) for k, v in new.items()} if isinstance(held, dict) and isinstance(new, dict) else new


@F.pandas_udf(StringType())
def _laid_over(bodies: pd.Series) -> pd.Series:
    return bodies.map(lambda all: None if all is None else json.dumps(reduce(_over, map(json.loads, all))))


def collisions(declarations: DataFrame) -> DataFrame:
    """Names that several files declare: (kind, name, files)."""
    of = declarations.where(F.col("kind").isin("class", "slot", "enum")).groupBy("kind", "name").agg(F.array_sort(F.collect_set("file")).alias("files"))
    return of.where(F.size("files") > 1)


def classes(items: DataFrame) -> DataFrame:
    kind = "is_a string, abstract boolean, description string, title string, annotations map<string,string>, source string"
    return items.where("kind = 'class'").select("name", "file", "ord", F.from_json("body", kind).alias("b")).select("name", "file", "ord", "b.*").withColumn("abstract", F.coalesce("abstract", F.lit(False)))


def slots(items: DataFrame) -> DataFrame:
    return items.where("kind = 'slot'").select(F.col("name").alias("slot"), "ord", F.from_json("body", SLOT).alias("def"), "file")


def _text_list(name: str) -> F.Column:
    """A scalar or list in JSON text as an array of strings."""
    raw = F.get_json_object("body", f"$.{name}")
    return F.when(raw.isNull(), F.array().cast("array<string>")).when(raw.startswith("["), F.from_json(raw, "array<string>")).otherwise(F.array(raw))


def enum_values(items: DataFrame) -> DataFrame:
    """(enum, ord, label, description, meaning, source, aliases, file); a scalar source is a list of one."""
    return items.where("kind = 'value'").select(
        F.col("name").alias("enum"), "ord", F.col("key").alias("label"), *[F.get_json_object("body", f"$.{k}").alias(k) for k in ("description", "meaning")], _text_list("source").alias("source"), _text_list("aliases").alias("aliases"), "file"
    )


def read_schemas(spark: SparkSession, path: str) -> DataFrame:
    """JSON Schema files of one folder, not of those below: (file, name, json)."""
    files = spark.read.option("pathGlobFilter", "*.json").text(path, wholetext=True)
    file = F.substring_index(F.col("_metadata.file_path"), "/", -1)
    return files.select(file.alias("file"), F.regexp_replace(file, r"\.json$", "").alias("name"), F.col("value").alias("json"))


def read_instances(spark: SparkSession, path: str) -> DataFrame:
    """JSON records, one per file: (file, json). The raw text is kept: absent, null and wrong type stay apart."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("json"))


def read_registry(spark: SparkSession, path: str, pattern: str = "test_registry*.yaml") -> DataFrame:
    """Expected verdicts from multi-document YAML: (registry, schema, file, description, expected); empty documents are skipped."""
    files = spark.read.option("pathGlobFilter", pattern).text(path, wholetext=True)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (name, doc.get("schema"), x.get("file"), x.get("description"), x.get("expected"))
                for name, text in zip(batch["name"], batch["value"], strict=True)
                for doc in yaml.safe_load_all(text)
                if doc
                for x in doc.get("instances") or []
            ]
            yield pd.DataFrame(rows, columns=["registry", "schema", "file", "description", "expected"])

    named = files.select("value", F.substring_index(F.col("_metadata.file_path"), "/", -1).alias("name"))
    return named.mapInPandas(parse, "registry string, schema string, file string, description string, expected string").orderBy("registry", "schema", "file")


def read_terms(spark: SparkSession, path: str) -> DataFrame:
    """Term tables (Term, URLs, Synonyms packed with `;`), every column as text; of repeated terms the last row stays."""
    rows = spark.read.csv(path, header=True, multiLine=True, escape='"', inferSchema=False)
    place = F.monotonically_increasing_id()
    last = W.partitionBy("Term").orderBy(F.desc("place"))
    return rows.withColumn("place", place).withColumn("rank", F.row_number().over(last)).where("rank = 1").drop("place", "rank")


def read_first_column(spark: SparkSession, path: str, name: str = "Term") -> DataFrame:
    """First column of CSV files by place, whatever their first line (skipped) calls it; rows without it are left out."""
    return spark.read.csv(path, schema=f"`{name}` string", header=True, enforceSchema=True, multiLine=True, escape='"').where(F.col(name).isNotNull())


def read_concept_maps(spark: SparkSession, path: str) -> DataFrame:
    """Concept maps (YAML: `mapping`, a list of source and target): (file, ord, source, target, comment)."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.yaml").text(path, wholetext=True)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for file, value in zip(batch["file"], batch["value"], strict=True):
                for i, m in enumerate((yaml.safe_load(value) or {}).get("mapping") or []):
                    target = m.get("target")
                    target = target if isinstance(target, dict) else {"label": target}
                    rows.append((file, i, *[None if x is None else str(x) for x in (m.get("source"), target.get("label"), target.get("comment"))]))
            yield pd.DataFrame(rows, columns=["file", "ord", "source", "target", "comment"])

    return files.select("value", F.col("_metadata.file_path").alias("file")).mapInPandas(parse, "file string, ord int, source string, target string, comment string")


def read_templates(spark: SparkSession, path: str) -> DataFrame:
    """Template registry of a form: (display_name, schema_name, type)."""
    raw = spark.read.json(path, multiLine=True, schema="manifest_schemas array<struct<display_name:string,schema_name:string,type:string>>")
    return raw.select(F.explode("manifest_schemas").alias("m")).select("m.*")


def _decoded(c: Column) -> Column:
    """A literal's text without its escapes. An escaped backslash is set aside first; what is left is JSON's but for two."""
    x = F.replace(F.replace(c, F.lit("\\\\"), F.lit("\\u005c")), F.lit("\\'"), F.lit("'"))
    parts = F.split(x, r"\\U")
    wide = F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(F.concat(F.decode(F.unhex(F.substring(p, 1, 8)), "UTF-32"), F.substring(p, F.lit(9), F.length(p)))))
    options = {"allowUnquotedControlChars": "true"}
    return F.when(c.contains("\\"), F.from_json(F.concat(F.lit('["'), F.array_join(wide, ""), F.lit('"]')), "array<string>", options)[0]).otherwise(c)


def read_ntriples(spark: SparkSession, path: str) -> DataFrame:
    """N-Triples as triples (s, p, o, s_kind, o_kind, datatype, lang); comments and blank lines are skipped. Blank nodes are
    named by file, so that files can be put together; a literal typed as text is a plain one."""
    line = F.trim("value")
    pattern = r'^(<[^>]*>|_:\S+)\s+<([^>]*)>\s+(<[^>]*>|_:\S+|"(?:[^"\\]|\\.)*"(?:@[A-Za-z0-9-]+|\^\^<[^>]*>)?)\s*\.\s*(?:#.*)?$'
    part = lambda i: F.regexp_extract(line, pattern, i)
    mark = F.concat(F.lit("_:f"), F.lpad(F.lower(F.hex(F.crc32(F.col("_metadata.file_path").cast("binary")))), 8, "0"), F.lit("."))
    rows = spark.read.text(path).where(line.rlike(pattern)).select(part(1).alias("s"), part(2).alias("p"), part(3).alias("o"), mark.alias("mark"))
    kind = lambda c: F.when(F.col(c).startswith("<"), "iri").when(F.col(c).startswith("_:"), "bnode").otherwise("literal")
    bare = lambda c: F.when(F.col(c).startswith("<"), F.expr(f"substr({c}, 2, length({c}) - 2)")).when(F.col(c).startswith('"'), _decoded(F.regexp_extract(c, r'^"((?:[^"\\]|\\.)*)"', 1))).otherwise(F.concat("mark", F.expr(f"substr({c}, 3)")))
    datatype = F.nullif(F.nullif(F.regexp_extract("o", r'"\^\^<([^>]*)>$', 1), F.lit("")), F.lit("http://www.w3.org/2001/XMLSchema#string"))
    return rows.select(bare("s").alias("s"), "p", bare("o").alias("o"), kind("s").alias("s_kind"), kind("o").alias("o_kind"), datatype.alias("datatype"), F.nullif(F.regexp_extract("o", r'"@([A-Za-z0-9-]+)$', 1), F.lit("")).alias("lang"))
