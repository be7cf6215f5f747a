"""Annotation profiling: values outside their vocabulary, frequencies, distinct counts, top values per field."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tesserae.sources import model

#: How often an unmatched value, and how many different values of a field, are seen before they are told.
LEAST_COUNT = 2
LEAST_DISTINCT = 5


def annotations(records: DataFrame, id: str, fields: list[str]) -> DataFrame:
    """Wide records -> (record_id, field, value): lists exploded, values trimmed, null and blank ones left out. Narrow."""
    types = dict(records.dtypes)
    as_list = lambda f: F.transform(f, lambda x: x.cast("string")) if types[f].startswith("array") else F.array(F.col(f).cast("string"))
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), as_list(f).alias("values")) for f in fields])
    flat = records.select(F.col(id).alias("record_id"), F.explode(pairs).alias("p")).select("record_id", "p.field", F.explode("p.values").alias("value"))
    return flat.withColumn("value", F.trim("value")).where("value <> ''")


def unmatched(values: DataFrame, allowed: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """(field, value, n): values (field, value) outside allowed (field, value), seen `least` times or more. Counted before
    the anti join, so what is joined is distinct pairs."""
    counts = values.groupBy("field", "value").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return counts.join(allowed.select("field", "value").distinct(), ["field", "value"], "left_anti")


def allowed_values(fields: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """fields (field, enum), vocabulary (enum, label, aliases) -> (field, value): labels and aliases of all mapped enums."""
    names = vocabulary.select("enum", F.explode(F.array_union(F.array("label"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("value"))
    return fields.join(names, "enum").select("field", "value").distinct()


def model_fields(items: DataFrame, vocabulary: Callable[[Column], Column] = lambda r: r.endswith("Enum")) -> DataFrame:
    """(field, enums, open) of the slots of a model that take a vocabulary: its names in order, the plain range before the branches,
    and whether any text is taken, too."""
    ranges = F.array_compact(F.array_prepend(F.coalesce(F.transform("def.any_of", lambda x: x["range"]), F.array().cast("array<string>")), F.col("def.range")))
    of = model.slots(items).select(F.col("slot").alias("field"), ranges.alias("ranges"))
    return of.select("field", F.filter("ranges", vocabulary).alias("enums"), F.array_contains("ranges", "string").alias("open")).where(F.size("enums") > 0)


def open_vocabulary(ranges: DataFrame) -> DataFrame:
    """ranges (field, ranges array) -> fields that take a vocabulary or any text."""
    return ranges.where(F.array_contains("ranges", "string") & F.exists("ranges", lambda x: x.endswith("Enum"))).select("field")


def target_enum(enums: F.Column) -> F.Column:
    """Of a field's enums the first that is no Other* one, else the first."""
    return F.coalesce(F.get(F.filter(enums, lambda e: ~e.startswith("Other")), F.lit(0)), F.get(enums, F.lit(0)))


def distinct_facets(values: DataFrame, least: int = LEAST_DISTINCT) -> DataFrame:
    """(field, n_distinct) of fields with at least `least` different values, most first."""
    counts = values.groupBy("field").agg(F.countDistinct("value").alias("n_distinct"))
    return counts.where(F.col("n_distinct") >= least).orderBy(F.desc("n_distinct"), "field")


def top_per_field(counts: DataFrame, most: int = 20) -> DataFrame:
    """counts (field, value, n) -> the `most` most frequent values of each field with rank and how many more there are."""
    order = W.partitionBy("field").orderBy(F.desc("n"), "value")
    top = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    sizes = counts.groupBy("field").agg(F.count("*").alias("size"))
    return top.join(sizes, "field").select("field", "value", "n", "rank", F.greatest(F.col("size") - most, F.lit(0)).alias("more"))


def suggestions(found: DataFrame) -> DataFrame:
    """(field, values): unmatched values of each field as a JSON map, most frequent first."""
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "value", "n")))
    return found.groupBy("field").agg(F.to_json(F.map_from_entries(F.transform(ordered, lambda x: F.struct(x["value"], x["n"])))).alias("values"))
