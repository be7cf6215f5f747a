"""Mixing sources to target weights by Efraimidis-Spirakis sampling (operator 6), DataFrame functions only.

Each document gets the key -ln(u)/w: u is uniform, drawn from a digest of its id, and w its quality weight, so the order
by key is a weighted sample without replacement and reruns agree. A source's target is spent on complete epochs first;
what is left goes to the documents with the smallest keys whose sizes, summed in that order, come nearest to it.

No source is sorted as a whole. Equal (source, key, id, size) collapse to one row with a count first. A source's keys are
counted into buckets of equal width, bucket sums are prefix-summed, and the range narrows to the bucket in which the budget
ends, again and again until few rows are left to sort. Where the budget ends inside equal rows, so many of them are taken as
come nearest to it; which ones is settled by their place in the written table, counted file by file. What remains per source
is one cut, so the last step is narrow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tesserae.llm.common import WORD, materialize, small

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_EPOCHS = 2
#: Characters that count against a document's quality weight.
JUNK = "#$%&*|<>{}[]=@0123456789"
LEAST_WEIGHT = 0.05
#: Buckets into which a range of keys is cut, and rows of a range that may be sorted by one task.
BUCKETS = 1_000
SORTED_ROWS = 100_000


def quality_weight(text: str = "text") -> Column:
    """Share of characters that are no markup, symbols or digits, LEAST_WEIGHT at least; empty and null: LEAST_WEIGHT."""
    clean = F.length(F.translate(F.col(text), JUNK, "")) / F.length(text)
    return F.greatest(F.lit(LEAST_WEIGHT), F.when(F.length(text) > 0, clean).otherwise(F.lit(0.0)))


def sample_key(id: str, weight: Column) -> Column:
    """-ln(u)/weight with u in (0, 1) from 52 bits of the id's MD5; a null id counts as the empty text."""
    bits = F.conv(F.substring(F.md5(F.coalesce(F.col(id).cast("string"), F.lit(""))), 1, 13), 16, 10).cast("long")
    return -F.log((bits + 0.5) / F.lit(2.0**52)) / weight


def _targets(totals: DataFrame, weights: tuple, share: float, epochs: int) -> DataFrame:
    """Shares by weight, none above epochs x its source's size: sources fill up in the order of size over weight."""
    every = W.orderBy(F.asc_nulls_last("source"))
    n = len(weights)
    rank = F.row_number().over(every) - 1
    ranked = totals.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % n + 1).cast("int")).cast("double"))
    ranked = ranked.withColumns({"cap": F.col("source_size") * epochs, "ratio": F.col("source_size") * epochs / F.col("weight")})
    filled = W.orderBy("ratio", F.asc_nulls_last("source"))
    before, rest = filled.rowsBetween(W.unboundedPreceding, -1), filled.rowsBetween(0, W.unboundedFollowing)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    level = (F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(rest)
    levelled = ranked.withColumn("level", level).withColumn("full", F.col("weight") * F.col("level") >= F.col("cap"))
    open_level = F.first(F.when(~F.col("full"), F.col("level")), ignorenulls=True).over(filled.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("weight") * F.col("open"))
    return levelled.withColumn("open", open_level).withColumn("target", target).select("source", "source_size", "target")


def _narrowed(keyed: DataFrame, plan: DataFrame, sorted_rows: int, buckets: int) -> DataFrame:
    """Per source with something left: the range [lo, hi] of keys in which its budget ends and the words before it (start).
    keyed: source, key, size, n; a range has `sorted_rows` rows at most, or one key."""
    ranges = keyed.groupBy("source").agg(F.min("key").alias("lo"), F.max("key").alias("hi"), F.count("*").alias("rows"))
    ranges = ranges.alias("r").join(plan.alias("p"), F.col("r.source").eqNullSafe(F.col("p.source"))).where("left > 0").select("r.*", "left", F.lit(0).cast("long").alias("start"))
    ranges = materialize(ranges)
    while not ranges.where((F.col("rows") > sorted_rows) & (F.col("hi") > F.col("lo"))).isEmpty():
        inside = keyed.alias("k").join(small(ranges).alias("r"), F.col("k.source").eqNullSafe(F.col("r.source")) & F.col("key").between(F.col("lo"), F.col("hi")))
        place = F.when(F.col("hi") > F.col("lo"), F.least(F.lit(buckets - 1), F.floor((F.col("key") - F.col("lo")) / (F.col("hi") - F.col("lo")) * buckets))).otherwise(0)
        sums = inside.select("k.source", "key", (F.col("size") * F.col("n")).alias("words"), place.alias("bucket"), "left", "start").groupBy("source", "bucket").agg(
            F.sum("words").alias("words"), F.min("key").alias("lo"), F.max("key").alias("hi"), F.count("*").alias("rows"), F.first("left").alias("left"), F.first("start").alias("start")
        )
        upto = F.col("start") + F.sum("words").over(W.partitionBy("source").orderBy("bucket"))
        sums = sums.withColumn("upto", upto).where("upto >= left AND upto - words < left")
        ranges = materialize(sums.select("source", "lo", "hi", "rows", "left", (F.col("upto") - F.col("words")).alias("start")))
    return ranges


def _order() -> list[Column]:
    return [F.col("key"), F.asc_nulls_last("id"), F.col("size")]


def cuts(rows: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, epochs: int = MOST_EPOCHS, sorted_rows: int = SORTED_ROWS, buckets: int = BUCKETS) -> DataFrame:
    """Per source: source_size, target, full (complete epochs), and the cut of the fractional one: the last key, id and size
    that are taken, and the last place among rows that are equal in them. rows: source, id, size, key, place."""
    keyed = materialize(rows.groupBy("source", "key", "id", "size").agg(F.count("*").alias("n")))
    totals = keyed.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = materialize(_targets(totals, weights, share, epochs).withColumn("full", full).withColumn("left", F.col("target") - F.col("full") * F.col("source_size")))
    ranges = materialize(_narrowed(keyed, plan, sorted_rows, buckets))
    inside = keyed.alias("k").join(small(ranges).alias("r"), F.col("k.source").eqNullSafe(F.col("r.source")) & F.col("key").between(F.col("lo"), F.col("hi"))).select("k.*", "left", "start")
    words = F.col("size") * F.col("n")
    inside = inside.withColumn("before", F.col("start") + F.sum(words).over(W.partitionBy("source").orderBy(*_order())) - words)
    # so many of a row's equals as come nearest to what is left, the fewer on ties
    some = F.when(F.col("size") > 0, F.greatest(F.lit(0), F.least(F.col("n"), F.ceil((F.col("left") - F.col("before")) / F.col("size") - 0.5)))).otherwise(F.lit(0)).cast("long")
    inside = inside.withColumn("copies", some).withColumn("gap", F.abs(F.col("before") + F.col("copies") * F.col("size") - F.col("left")))
    best = F.struct("gap", "before", "key", F.col("id").isNull().alias("last"), "id", "size", "copies", "n")
    ends = materialize(inside.groupBy("source").agg(F.min(best).alias("best")).select("source", "best.*"))
    # of equal rows at the cut, the place of the last one taken: counts by file, then inside the file
    tied = rows.alias("k").join(small(ends.where("copies > 0 AND copies < n")).alias("e"), F.col("k.source").eqNullSafe(F.col("e.source")) & (F.col("k.key") == F.col("e.key")) & F.col("k.id").eqNullSafe(F.col("e.id")) & (F.col("k.size") == F.col("e.size")))
    tied = tied.select("k.source", "place", "copies", F.shiftright("place", 33).alias("file"))
    files = tied.groupBy("source", "file").agg(F.count("*").alias("n"))
    files = materialize(files.withColumn("before", F.sum("n").over(W.partitionBy("source").orderBy("file")) - F.col("n")))
    ranked = tied.withColumn("rank", F.row_number().over(W.partitionBy("source", "file").orderBy("place")))
    ranked = ranked.alias("t").join(small(files).alias("f"), F.col("t.source").eqNullSafe(F.col("f.source")) & (F.col("t.file") == F.col("f.file")))
    last = ranked.where(F.col("before") + F.col("rank") == F.col("copies")).select(F.col("t.source").alias("source"), "place")
    found = ends.alias("e").join(materialize(last).alias("l"), F.col("e.source").eqNullSafe(F.col("l.source")), "left").select("e.*", "l.place")
    place = F.when(F.col("copies") == F.col("n"), F.lit((1 << 63) - 1)).when(F.col("copies") == 0, F.lit(-1)).otherwise(F.col("place"))
    return plan.alias("p").join(found.alias("e"), F.col("p.source").eqNullSafe(F.col("e.source")), "left").select(
        "p.source", "p.source_size", "p.target", "p.full", F.col("e.key").alias("cut_key"), F.col("e.id").alias("cut_id"), F.col("e.size").alias("cut_size"), place.alias("cut_place")
    )


def mix(docs: DataFrame, text: str = "text", id: str = "doc_id", source: str = "source", weights: tuple = WEIGHTS, share: float = SHARE, epochs: int = MOST_EPOCHS, columns: list[str] | None = None, sorted_rows: int = SORTED_ROWS, buckets: int = BUCKETS) -> DataFrame:
    """One row per row of docs: row (its columns, or those named), size (words; null text: 0), source_size, target, copies
    (how often the mix takes it) and taken (words).

    Null is a source of its own, last in order. Rows with one id (null among them) and size have one key: of those at which
    the budget ends, so many are taken as come nearest to it, so results agree between reruns but for which of them it is.
    A source without words has target 0 and takes no copies. An empty table gives no rows. The shares of sources are worked
    out in one task over one row a source.
    """
    base = docs.select(
        F.struct(*([f"`{c}`" for c in columns] if columns else ["*"])).alias("row"), F.col(source).alias("source"), F.col(id).alias("id"), F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"), sample_key(id, quality_weight(text)).alias("key")
    )
    base = materialize(base.withColumn("place", F.monotonically_increasing_id()))
    plan = small(materialize(cuts(base.drop("row"), weights, share, epochs, sorted_rows, buckets)))
    joined = base.alias("d").join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")))
    own = F.struct("d.key", F.col("d.id").isNull().alias("last"), "d.id", "d.size", "d.place")
    cut = F.struct(F.col("cut_key").alias("key"), F.col("cut_id").isNull().alias("last"), F.col("cut_id").alias("id"), F.col("cut_size").alias("size"), F.col("cut_place").alias("place"))
    extra = F.col("cut_key").isNotNull() & (own <= cut)
    copies = F.col("full") + F.coalesce(extra, F.lit(False)).cast("long")
    return joined.select("row", "size", "source_size", "target", copies.cast("long").alias("copies")).withColumn("taken", F.col("copies") * F.col("size"))


def repeated(mixed: DataFrame) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns it came with."""
    times = F.sequence(F.lit(1), F.col("copies").cast("int"))
    return mixed.where("copies > 0").select("row", F.explode(times).alias("epoch")).select("row.*")
