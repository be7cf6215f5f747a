"""Search, facets, hierarchies and size limits of a model or any table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tesserae.plans.compile import needs_checkpoints

#: Fixed values of the table service whose limits are checked.
ROW_LIMIT, ROW_WARNING, OVERHEAD = 64_000, 57_600, 14_554
TEXT_BYTES, LIST_BYTES = 80 * 4, 80 * 20 * 4


def index(*parts: tuple[str, DataFrame, str, str]) -> DataFrame:
    """(type, name, text): one search index of several tables, each (type, rows, name column, text column)."""
    rows = [df.select(F.lit(t).alias("type"), F.col(n).cast("string").alias("name"), F.col(x).cast("string").alias("text")) for t, df, n, x in parts]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def contains(rows: DataFrame, query: str, *columns: str) -> DataFrame:
    """Rows with the query in one of the columns, letter case aside; a query of under two characters finds nothing."""
    q = query.strip().lower()
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.contains(F.lower(F.coalesce(F.col(c), F.lit(""))), F.lit(q))
    return rows.where(hit if len(q) >= 2 else F.lit(False))


def first_matches(rows: DataFrame, query: str, order: str, most: int, *columns: str) -> DataFrame:
    """The first `most` matches in the index's own order, with their place (from 1); matches are not ranked."""
    found = contains(rows, query, *columns).orderBy(order).limit(most)
    return found.withColumn("place", F.row_number().over(W.orderBy(order)))  # `most` rows


def sorted_by(rows: DataFrame, *columns: str, falling: bool = False, collation: str | None = None) -> DataFrame:
    """A user's sort on any columns, rising or falling; texts by code point, or in a collation (UNICODE: as people read)."""
    types = dict(rows.dtypes)
    key = lambda c: F.collate(F.col(c), collation) if collation and types[c] == "string" else F.col(c)
    return rows.orderBy(*[key(c).desc() if falling else key(c).asc() for c in columns])


def facets(rows: DataFrame, search: Column | None = None, **chosen) -> DataFrame:
    """Rows that meet every chosen facet (a value or list); a search lifts them all."""
    if search is not None:
        return rows.where(search)
    for name, wanted in chosen.items():
        rows = rows.where(F.col(name).isin(*wanted) if isinstance(wanted, (list, tuple)) else F.col(name) == wanted)
    return rows


def cards(rows: DataFrame, search: Column | None = None, tiers: list[str] = (), upto: str | None = None, least_fields: int = 0, **chosen) -> DataFrame:
    """rows (abstract, tier, fields and facet columns) that a catalogue shows. Facets, the tier (`upto` and those before it in
    `tiers`; a row of no known tier counts as the one before the last) and the least number of fields always hold. Abstract
    rows, and with a tier chosen those of the last one, show only in a search."""
    for name, wanted in chosen.items():
        rows = rows.where(F.col(name).isin(*wanted) if isinstance(wanted, (list, tuple)) else F.col(name) == wanted)
    if upto is not None:
        known = F.array_position(F.array(*map(F.lit, tiers)), F.col("tier"))
        rank = F.coalesce(F.nullif(known, F.lit(0)), F.lit(len(tiers) - 1))
        rows = rows.where(rank <= tiers.index(upto) + 1)
    if search is not None:
        rows = rows.where(search)
    else:
        rows = rows.where(~F.coalesce("abstract", F.lit(False)))
        if upto is not None:
            rows = rows.where(~F.col("tier").eqNullSafe(F.lit(tiers[-1])))
    return rows.where(F.col("fields") >= least_fields) if least_fields else rows


def any_nested(rows: DataFrame, values: str, query: str) -> DataFrame:
    """Rows of which a value in the array matches."""
    return rows.where(F.exists(values, lambda v: F.contains(F.lower(v), F.lit(query.lower()))))


def placed(rows: DataFrame, *order: Column) -> DataFrame:
    """rows with their place (from 1) in an order. Ranges of the order are written, counted, and numbered each by itself, so
    no task sorts the whole; equal rows have places next to each other, in no fixed order."""
    needs_checkpoints(rows.sparkSession)
    keys = {f"_k{i}": c for i, c in enumerate(order)}
    ranged = rows.withColumns(keys).repartitionByRange(*[F.col(k) for k in keys]).withColumn("_range", F.spark_partition_id()).checkpoint()
    sizes = {r["_range"]: r["count"] for r in ranged.groupBy("_range").count().collect()}  # one number a range
    before, offsets = 0, []
    for r in sorted(sizes):
        offsets += [F.lit(r), F.lit(before).cast("long")]
        before += sizes[r]
    within = F.row_number().over(W.partitionBy("_range").orderBy(*keys))
    offset = F.create_map(*offsets)[F.col("_range")] if offsets else F.lit(0)
    return ranged.withColumn("place", (offset + within).cast("long")).drop("_range", *keys)


def by_tier(rows: DataFrame, tier: str, name: str) -> DataFrame:
    """rows with their place in the order of tiers (rows without one as of tier 2), then of names."""
    return placed(rows, F.coalesce(F.col(tier), F.lit(2)), F.col(name))


def children(rows: DataFrame, parent: str, name: str) -> DataFrame:
    """(parent, children, n): sorted names below each parent."""
    return rows.where(F.col(parent).isNotNull()).groupBy(F.col(parent).alias("parent")).agg(F.array_sort(F.collect_list(name)).alias("children"), F.count("*").alias("n"))


def largest(rows: DataFrame, group: str, most: int = 5) -> DataFrame:
    """The `most` largest groups."""
    return rows.groupBy(F.col(group).alias("name")).agg(F.count("*").alias("size")).orderBy(F.desc("size"), "name").limit(most)


def lengths(rows: DataFrame, *columns: str, limit: int = 80) -> DataFrame:
    """(column, longest, over): longest text of each column and how many are over the limit; of lists, their elements."""
    types = dict(rows.dtypes)
    sizes = lambda c: F.transform(c, lambda x: F.length(x)) if types[c].startswith("array") else F.array(F.length(c))
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), sizes(c).alias("sizes")) for c in columns]))
    return rows.select(each.alias("x")).select("x.column", F.explode_outer("x.sizes").alias("n")).groupBy("column").agg(F.max("n").alias("longest"), F.count_if(F.col("n") > limit).alias("over"))


def row_budget(counts: DataFrame) -> DataFrame:
    """counts (name, texts, lists) -> bytes of a row, share of the limit in percent, status; largest first."""
    size = F.col("texts") * TEXT_BYTES + F.col("lists") * LIST_BYTES + OVERHEAD
    status = F.when(F.col("bytes") > ROW_LIMIT, "over").when(F.col("bytes") > ROW_WARNING, "near").otherwise("ok")
    return counts.select("name", size.cast("long").alias("bytes")).withColumns({"percent": F.round(F.col("bytes") / ROW_LIMIT * 100, 1), "status": status}).orderBy(F.desc("bytes"), "name")


def odd_widths(lines: DataFrame, header_width: int, column: str = "value", mark: str = ",") -> DataFrame:
    """Lines with another number of fields than the header."""
    return lines.withColumn("width", F.size(F.split(column, mark))).where(F.col("width") != header_width)


def csv_findings(files: DataFrame, mark: str = ",") -> DataFrame:
    """files (file, text) -> (file, line, width, header): CSV records with another number of fields than their file's first,
    numbered from 1. Marks and line ends inside quotes belong to their field; an empty line has one field."""
    record = r'((?:[^"\r\n]++|"[^"]*+"?+)*+)(\r?\n|\r|$)'
    found = F.regexp_extract_all("text", F.lit(record), F.lit(1))
    records = F.when(F.get(found, F.size(found) - 1) == "", F.slice(found, 1, F.greatest(F.size(found) - 1, F.lit(0)))).otherwise(found)
    widths = F.transform(records, lambda r: F.size(F.split(F.regexp_replace(r, '"[^"]*"', ""), F.lit(rf"\Q{mark}\E"))))
    each = files.select("file", widths.alias("w")).select("file", F.get("w", F.lit(0)).alias("header"), F.posexplode("w").alias("pos", "width"))
    return each.where(F.col("width") != F.col("header")).select("file", (F.col("pos") + 1).alias("line"), "width", "header")
