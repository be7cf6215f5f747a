"""Reference tables kept in step: lookups, anti joins, full-outer merges, keyed upserts, versions, concept maps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: first_route() folds so many patterns into one expression and fails above.
MOST_PATTERNS = 1_000


def complete(rows: DataFrame, *required: str) -> DataFrame:
    """Rows whose required fields are neither null nor blank."""
    return rows.where(reduce(lambda a, b: a & b, [F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) != "" for c in required]))


def routed(text: Column, rules: list[tuple[str, str]], other: str | None = None) -> Column:
    """Target of the first rule whose text is contained, letter case aside."""
    lower = F.lower(text)
    return reduce(lambda rest, rule: F.when(lower.contains(rule[0]), rule[1]).otherwise(rest), reversed(rules), F.lit(other))


def linked(rows: DataFrame, links: DataFrame, key: str) -> DataFrame:
    """Left lookup on the trimmed key; the lookup side keeps one row per key."""
    one = links.withColumn(key, F.trim(key)).dropDuplicates([key])
    return rows.withColumn(key, F.trim(key)).join(one, key, "left")


def without(rows: DataFrame, known: DataFrame, *keys: str) -> DataFrame:
    return rows.join(known.select(*keys), list(keys), "left_anti")


def within(rows: DataFrame, known: DataFrame, *keys: str) -> DataFrame:
    return rows.join(known.select(*keys), list(keys), "left_semi")


def merged_links(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """Full outer merge: the left value stays where there is one, else the right one's; keys of either side."""
    other = right.select(F.col(key).alias("_k"), F.col(value).alias("_v"))
    joined = left.join(other, F.col(key) == F.col("_k"), "full_outer")
    origin = F.when(F.col(key).isNull(), "added").when(F.col(value).isNull() & F.col("_v").isNotNull(), "filled").otherwise("kept")
    return joined.select(F.coalesce(key, "_k").alias(key), F.coalesce(value, "_v").alias(value), origin.alias("origin"))


def latest(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The last row of each key in an order that should be total."""
    columns = rows.columns
    w = W.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").select(*columns)


def upserted(base: DataFrame, changes: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """base with the rows of changes replacing those of the same keys or added; missing columns become null. order: of
    several changes of one key the one with the greatest value in this column counts; without it each key should have one."""
    if order:
        changes = latest(changes, keys, F.desc_nulls_last(order))
    kept = base.join(changes.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(changes, allowMissingColumns=True)


def latest_version(versions: DataFrame, key: str, version: Column) -> DataFrame:
    """(key, latest, versions): the greatest version in numeric order and how many there are. version: sortable array."""
    return versions.groupBy(key).agg(F.max_by("version", version).alias("latest"), F.count("*").alias("versions"))


def first_route(rows: DataFrame, address: str, patterns: DataFrame) -> DataFrame:
    """rows with `target` of the first pattern (ord, pattern, target) that the address contains; the pattern table is
    small by nature and is folded into one expression, so there is no nested-loop join."""
    rules = [(r["pattern"], r["target"]) for r in patterns.orderBy("ord").limit(MOST_PATTERNS + 1).collect()]
    if len(rules) > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} patterns do not fit an expression")
    text = F.col(address)
    return rows.withColumn("target", reduce(lambda rest, rule: F.when(text.contains(rule[0]), rule[1]).otherwise(rest), reversed(rules), F.lit(None).cast("string")))


def translated(rows: DataFrame, column: str, concept_map: DataFrame) -> DataFrame:
    """rows with the column's label translated where the map (ord, source, target) has it. A source that is mapped several
    times takes its first target, so rows never multiply; `ambiguous` tells."""
    first = concept_map.groupBy("source").agg(F.min_by("target", "ord").alias("target"), (F.count("*") > 1).alias("ambiguous"))
    joined = rows.join(first, rows[column] == first["source"], "left").drop("source")
    return joined.withColumn(f"{column}_mapped", F.coalesce("target", column)).withColumn("ambiguous", F.coalesce("ambiguous", F.lit(False))).drop("target")


def entry(name: str, description: str, meaning: str, source: str) -> Column:
    """An enum entry of a resource: members that are null are left out of its JSON."""
    from tesserae.functions import text

    return F.to_json(F.struct(text.useful_description(F.col(description), F.col(name)).alias("description"), text.rrid(F.col(meaning)).alias("meaning"), F.col(source).alias("source")))
