"""Writers: schema files, vocabulary files, tables, reports. Reports are small; files and records are written by Spark."""

from __future__ import annotations

import json
from urllib.parse import unquote
from uuid import uuid4

import pandas as pd
import yaml
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tesserae.sources import model


def write_files(rows: DataFrame, folder: str) -> list[str]:
    """rows (name, text): one file per name in a folder of any file system that Spark reaches; gives the names.

    Tasks write below a folder of their own; only when all are done is each file renamed to its place, in one step, so a
    failed task leaves the folder as it was. A text ends with one line end; of rows of one name the texts follow each other.
    """
    spark = rows.sparkSession
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path
    scratch = f"{folder.rstrip('/')}/_writing-{uuid4().hex}"
    fs = path(scratch).getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        rows.select(F.col("name").alias("_name"), F.regexp_replace("text", r"\n$", "").alias("value")).repartition("_name").write.partitionBy("_name").text(scratch)
        written = sorted((unquote(s.getPath().getParent().getName().partition("=")[2]), s.getPath()) for s in fs.globStatus(path(f"{scratch}/_name=*/part-*")) or [])
        for name, at in written:
            to = path(f"{folder.rstrip('/')}/{name}")
            if fs.exists(to):
                fs.delete(to, False)
            if not fs.rename(at, to):
                raise OSError(f"{name} could not be put in place")
        return [name for name, _ in written]
    finally:
        fs.delete(path(scratch), True)


@F.pandas_udf(StringType())
def indented(texts: pd.Series) -> pd.Series:
    """JSON texts with two spaces a level, keys in their order."""
    return texts.map(lambda t: json.dumps(json.loads(t), indent=2))


def write_schemas(schemas: DataFrame, folder: str) -> list[str]:
    """One indented JSON file per class (class, json); gives the classes."""
    named = schemas.select(F.concat("class", F.lit(".json")).alias("name"), indented("json").alias("text"))
    return [n.removesuffix(".json") for n in write_files(named, folder)]


def enum_yaml(name: str, entries: dict[str, dict], warning: str = "Generated; changes by hand are lost.") -> str:
    """A vocabulary module: sorted labels, a warning on top; texts are quoted where YAML needs it."""
    body = {"enums": {name: {"permissible_values": {k: entries[k] or {} for k in sorted(entries)}}}}
    return f"# {warning}\n" + yaml.safe_dump(body, allow_unicode=True, sort_keys=True, width=1_000)


def append_csv(rows: DataFrame, path: str, keys: list[str], done: DataFrame | None = None) -> None:
    """Appends the rows that are not done yet; every part file has its header."""
    left = rows.join(done.select(*keys), keys, "left_anti") if done is not None else rows
    left.write.mode("append").option("header", True).csv(path)


def suggestions_json(suggestions: DataFrame, filters: dict[str, int]) -> str:
    """suggestions (field, values as JSON) with the thresholds they were found under."""
    found = {r["field"]: json.loads(r["values"]) for r in suggestions.orderBy("field").collect()}
    return json.dumps({"suggestions": found, "filters": filters}, indent=2)


def markdown(rows: DataFrame, title: str, most: int = 1_000) -> str:
    """A small result as a table; what is beyond `most` rows is told, not shown."""
    held = rows.limit(most + 1).collect()
    cell = lambda v: "" if v is None else ", ".join(map(str, v)) if isinstance(v, list) else str(v).replace("|", "\\|")
    lines = [f"## {title}", "", "| " + " | ".join(rows.columns) + " |", "|" + " --- |" * len(rows.columns)]
    lines += ["| " + " | ".join(cell(v) for v in r) + " |" for r in held[:most]]
    return "\n".join([*lines, *(["", "... and more"] if len(held) > most else [])]) + "\n"


def bundle(items: DataFrame) -> str:
    """Classes, slots and vocabularies with totals, as one JSON text for a browser."""
    of = model.classes(items).orderBy("name").collect()
    words = model.enum_values(items).groupBy("enum").agg(F.array_sort(F.collect_list("label")).alias("labels")).orderBy("enum").collect()
    names = [r["slot"] for r in model.slots(items).orderBy("slot").collect()]
    data = {
        "classes": [{"name": r["name"], "parent": r["is_a"], "abstract": r["abstract"], "description": r["description"]} for r in of],
        "slots": names,
        "enums": {r["enum"]: r["labels"] for r in words},
        "totals": {"classes": len(of), "slots": len(names), "enums": len(words), "values": sum(len(r["labels"]) for r in words)},
    }
    return json.dumps(data)


def sssom(items: DataFrame) -> DataFrame:
    """Mappings of vocabulary values to their meanings: (subject_id, predicate_id, object_id, subject_label)."""
    return model.enum_values(items).where("meaning IS NOT NULL").select(F.concat_ws("#", "enum", "label").alias("subject_id"), F.lit("skos:exactMatch").alias("predicate_id"), F.col("meaning").alias("object_id"), F.col("label").alias("subject_label"))


def ddl(columns: DataFrame, table: str) -> str:
    """CREATE TABLE of compiled columns (property, column_type), with an id and a name before them."""
    kind = {"DOUBLE": "DOUBLE", "INTEGER": "BIGINT", "BOOLEAN": "BOOLEAN", "INTEGER_LIST(20)": "ARRAY<BIGINT>", "BOOLEAN_LIST(20)": "ARRAY<BOOLEAN>", "STRING_LIST(80x20)": "ARRAY<STRING>"}
    rows = [f"`{r['property']}` {kind.get(r['column_type'], 'STRING')}" for r in columns.orderBy("property").collect()]
    return f"CREATE TABLE {table} (\n  " + ",\n  ".join(["`id` STRING", "`name` STRING", *rows]) + "\n)"


def key_values(**pairs) -> Column:
    """key=value lines of a row."""
    return F.concat_ws("\n", *[F.concat(F.lit(f"{k}="), F.coalesce(c.cast("string"), F.lit(""))) for k, c in pairs.items()])


def annotation(level: str, file: Column, line: Column, message: Column) -> Column:
    """A build annotation line of a finding."""
    return F.format_string(f"::{level} file=%s,line=%d::%s", file, line, message)
