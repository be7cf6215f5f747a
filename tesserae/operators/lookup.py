"""Lookups around a model and its side tables: first matches, fallbacks, parent chains, inclusion lists, tallies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tesserae.plans.compile import closure


def scan(rows: DataFrame, columns: list[str], limit: int | None = None, **wanted) -> DataFrame:
    """One projected and filtered scan for all wanted values of a column, instead of one query per value."""
    for name, values in wanted.items():
        rows = rows.where(F.col(name).isin(*values) if isinstance(values, (list, tuple)) else F.col(name) == values)
    out = rows.select(*columns)
    return out if limit is None else out.limit(limit)


def first_found(rows: DataFrame, group: str, order: str, found: Column, scanned: int = 10, reported: int = 3) -> DataFrame:
    """Of each group's first `scanned` rows in an order, the first `reported` that `found` holds for. The first limit is taken
    before the shuffle of each group is sorted in full (a window's group limit), so large groups stay cheap."""
    window = W.partitionBy(group).orderBy(order)
    first = rows.withColumn("place", F.row_number().over(window)).where(F.col("place") <= scanned)
    return first.where(found).withColumn("rank", F.row_number().over(W.partitionBy(group).orderBy("place"))).where(F.col("rank") <= reported)


def selected(rows: DataFrame, names: list[str], column: str = "name") -> DataFrame:
    """The rows of the wanted names; LookupError names those that no row has. `names` is a short list typed by a user."""
    out = rows.where(F.col(column).isin(*names))
    held = {r[0] for r in out.select(column).distinct().collect()}
    if missing := [n for n in names if n not in held]:
        raise LookupError("not found: " + ", ".join(missing))
    return out


def suffixed(rows: DataFrame, column: str = "name", suffix: str = "Template") -> DataFrame:
    """Rows whose name ends so."""
    return rows.where(F.col(column).endswith(suffix))


def enum_file(names: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """names (enum) with the first file, in path order, that declares the vocabulary."""
    return names.join(vocabulary.groupBy("enum").agg(F.min("file").alias("file")), "enum", "left")


def detail_address(base: str, id: Column, fallback: Column) -> Column:
    """Address of a resource by its id, else by its row number."""
    return F.concat(F.lit(base), F.coalesce(F.nullif(F.trim(id), F.lit("")), fallback.cast("string")))


def first_use(fields: DataFrame) -> DataFrame:
    """fields (class, ord, property) -> each property with the first class, in order, that has it."""
    return fields.groupBy("property").agg(F.min_by("class", F.struct("ord", "class")).alias("class"))


def existing(wanted: DataFrame, known: DataFrame) -> DataFrame:
    """wanted (key, id, org, name) with the id of the known set of that id, else of that org and name; the smallest of several."""
    by_id = known.select(F.col("id").alias("by_id")).distinct()
    by_name = known.groupBy("org", "name").agg(F.min("id").alias("by_name"))
    joined = wanted.join(by_id, F.col("id") == F.col("by_id"), "left").join(by_name, ["org", "name"], "left")
    return joined.select("key", F.coalesce("by_id", "by_name").alias("found"))


def root_of(nodes: DataFrame, kind: str) -> DataFrame:
    """nodes (name, parent, type) -> each name with its nearest ancestor of a type; null if it has none."""
    up = closure(nodes.select("name", "parent"))
    roots = nodes.where(F.col("type") == kind).select(F.col("name").alias("ancestor"))
    near = up.join(roots, "ancestor").groupBy("name").agg(F.min_by("ancestor", "depth").alias("root"))
    return nodes.select("name").join(near, "name", "left")


def suggested(relations: DataFrame, classes: DataFrame, property: str = "suggests") -> DataFrame:
    """relations (from, to, property) -> (class, template) pairs of one property whose source is a known class."""
    of = relations.where(F.col("property") == property).select(F.col("from").alias("class"), F.col("to").alias("template"))
    return of.join(classes.select(F.col("name").alias("class")), "class", "left_semi")


def annotated(rows: DataFrame, annotations: str, fields: list[str]) -> DataFrame:
    """rows with `present`: the schema fields that their annotation map already fills."""
    held = F.map_filter(annotations, lambda k, v: k.isin(*fields) & v.isNotNull() & (F.trim(v) != ""))
    return rows.withColumn("present", F.array_sort(F.map_keys(held)))


def chosen(files: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None) -> DataFrame:
    """Files to work on: an inclusion list overrides an exclusion list."""
    if include:
        return files.where(F.col("name").isin(*include))
    return files.where(~F.col("name").isin(*(exclude or []))) if exclude else files


def conflicts(wanted: DataFrame, versions: DataFrame) -> DataFrame:
    """wanted (name, version) that exist already."""
    return wanted.join(versions.select("name", "version").distinct(), ["name", "version"], "left_semi")


def tally(rows: DataFrame, status: str) -> DataFrame:
    """(status, n, share in percent)."""
    counts = rows.groupBy(status).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select(status, "n", F.round(F.col("n") / F.col("total") * 100, 1).alias("percent"))


def string_lists(rows: DataFrame, key: str, value: str, mark: str = ",") -> DataFrame:
    """(key, values): a key's different values, sorted and joined."""
    return rows.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(value)), mark).alias("values"))


def multimap(rows: DataFrame, key: str, name: str, value: str) -> DataFrame:
    """(key, properties): a map from each name to its sorted values."""
    lists = rows.groupBy(key, name).agg(F.array_sort(F.collect_list(value)).alias("v"))
    return lists.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(name, "v")))).alias("properties"))


def range_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """(slot, range) tables -> (slot, added, removed) of slots in both whose ranges differ."""
    lists = lambda df, n: df.groupBy("slot").agg(F.array_sort(F.collect_set("range")).alias(n))
    both = lists(before, "a").join(lists(after, "b"), "slot").where("a <> b")
    return both.select("slot", F.array_except("b", "a").alias("added"), F.array_except("a", "b").alias("removed"))
