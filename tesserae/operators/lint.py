"""Checks of a model and its side tables; each returns the findings as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.sources import model


def dangling(names: DataFrame, items: DataFrame, column: str = "schema_name") -> DataFrame:
    """Rows that name a class which the model lacks."""
    of = model.classes(items).select(F.col("name").alias(column))
    return names.join(of, column, "left_anti")


def unknown_ranges(items: DataFrame, scalars: list[str]) -> DataFrame:
    """(slot, range) of slots whose range is neither a scalar nor a vocabulary nor a class."""
    of = model.slots(items)
    several = F.transform(F.coalesce("def.any_of", F.array().cast("array<struct<range:string>>")), lambda x: x["range"])
    ranges = of.select("slot", F.explode(F.array_compact(F.array_append(several, F.col("def.range")))).alias("range")).where(~F.col("range").isin(*scalars))
    known = items.where("kind IN ('enum', 'class')").select(F.col("name").alias("range"))
    return ranges.join(known, "range", "left_anti").select("slot", "range").distinct()


def shared_labels(items: DataFrame) -> DataFrame:
    """(label, enums) of labels that several vocabularies have."""
    return model.enum_values(items).groupBy("label").agg(F.array_sort(F.collect_set("enum")).alias("enums")).where(F.size("enums") > 1)


def coverage(items: DataFrame, key: str, allowed: DataFrame) -> DataFrame:
    """(class, finding, value): concrete classes without the annotation `templateFor.<key>`, and values outside allowed (label)."""
    of = model.classes(items).where("NOT abstract")
    listed = of.select(F.col("name").alias("class"), F.from_json(F.get_json_object(F.col("annotations")["templateFor"], f"$.{key}"), "array<string>").alias("values"))
    missing = listed.where(F.coalesce(F.size("values"), F.lit(0)) <= 0).select("class", F.lit("missing").alias("finding"), F.lit(None).cast("string").alias("value"))
    given = listed.select("class", F.explode("values").alias("value"))
    bad = given.join(allowed.select(F.col("label").alias("value")), "value", "left_anti").select("class", F.lit("invalid").alias("finding"), "value")
    return missing.unionByName(bad)


def without_final_newline(files: DataFrame) -> DataFrame:
    """files (file, text) that do not end in a line end."""
    return files.where((F.col("text") != "") & ~F.col("text").endswith("\n")).select("file")
