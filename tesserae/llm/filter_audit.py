"""Filter interaction audit (operator 12): what each filter of a sequence removes, in every order.

Each document gets one failure flag a filter. Documents collapse to counts by part, flags and labels (a table of parts x 32 x 4
rows at most); SQL's CUBE over the flags and the part then gives, for every subset of filters, the documents that fail none
of them: the row of that grouping set whose flags are all false. A step of an order is a pair of subsets, before and
after its filter, so every figure of all 120 orders is a difference of two survivor counts, found by joining pairs of subsets.

The flag of repeated texts needs no join back to the rows: of a text's rows all fail but those with its smallest id, so counts
by (text digest, flags, part, labels) and the smallest id among them say how many fail.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tesserae.llm.common import materialize, small, text_or_empty

LEAST_WORDS = 200
#: Per cent: least share of distinct words, most share of capitals.
DISTINCT_SHARE, CAPITAL_SHARE = 50, 3
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOLS = r"[#$%&*|]"
FILTERS = "ABCDE"
#: The filter whose flag is whether a smaller id has the same text; it follows from counts.
REPEATED = "E"


def text_flags(text: Column) -> dict[str, Column]:
    """The failure flags that a text alone decides; none is null where the text is not."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n = F.size(words)
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    return {"A": n < LEAST_WORDS, "B": 100 * F.size(F.array_distinct(words)) < DISTINCT_SHARE * n, "C": 100 * capitals > CAPITAL_SHARE * F.length(text), "D": text.rlike(SYMBOLS)}


def profile(docs: DataFrame, labels: DataFrame, text: str = "text", id: str = "doc_id", part: str = "lang") -> DataFrame:
    """(part, A, B, C, D, E, good, toxic, n): documents counted by their flags and labels; parts x 32 x 4 rows at most.

    Null text counts as empty, a null part as the empty text. A document is good (toxic) if any row of labels with its id says
    so; rows of one id share their labels. E: a smaller id has the same text (SHA-256 and length); rows of one id do not fail
    each other, and a null id is neither smaller nor larger than any.
    """
    flags = text_flags(F.col("text"))
    facts = docs.select(F.col(id).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text_or_empty(text).alias("text"))
    facts = materialize(facts.select("id", "part", *[c.alias(k) for k, c in flags.items()], F.unhex(F.sha2("text", 256)).alias("digest"), F.length("text").alias("length")))
    known = labels.where(F.col(id).isNotNull()).groupBy(F.col(id).alias("id")).agg(*[F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(k) for c, k in (("quality", "good"), ("toxic", "toxic"))])
    marks = {k: F.coalesce(k, F.lit(False)) for k in ("good", "toxic")}
    labelled = facts.where("id IS NOT NULL").join(small(materialize(known)), "id", "left").withColumns(marks)
    unnamed = facts.where("id IS NULL").withColumns({k: F.lit(False) for k in marks})  # apart: null keys would meet in one task
    of_text = ["digest", "length", *flags]
    kinds = [*of_text, "part", *marks]
    named = labelled.groupBy(*kinds, "id").agg(F.count("*").alias("rows"))
    grouped = named.groupBy(*kinds).agg(F.sum("rows").alias("n"), F.min(F.struct("id", "rows")).alias("first"))
    least = grouped.groupBy("digest", "length").agg(F.min("first.id").alias("least"), F.count("*").alias("groups"))
    # a text has one row a part and label here, so no text is hot in this join
    met = grouped.join(least, ["digest", "length"])
    stays = F.when(F.col("first.id") == F.col("least"), F.col("first.rows")).otherwise(0)
    split = F.inline(F.array(F.struct(F.lit(False).alias(REPEATED), stays.alias("n")), F.struct(F.lit(True).alias(REPEATED), (F.col("n") - stays).alias("n"))))
    counted = met.select("part", *flags, *marks, split).where("n > 0")
    alone = unnamed.select("part", *flags, *marks, F.lit(False).alias(REPEATED), F.lit(1).cast("long").alias("n"))
    order = ["part", *flags, REPEATED, *marks]
    return counted.unionByName(alone).groupBy(*order).agg(F.sum("n").alias("n"))


def survivors(profiled: DataFrame) -> DataFrame:
    """(part, every, mask, n, good, toxic): documents that fail no filter of a subset, zeros included; bit i of mask is the
    i-th filter. Rows with every = 1 speak of the whole table, and their part is empty."""
    cube = profiled.cube("part", *FILTERS).agg(
        F.grouping("part").alias("every"), *[F.grouping(f).alias(f"g{f}") for f in FILTERS], F.sum("n").alias("n"), *[F.sum(F.when(F.col(k), F.col("n")).otherwise(0)).alias(k) for k in ("good", "toxic")]
    )
    mask = sum(((1 - F.col(f"g{f}").cast("int")) * (1 << i) for i, f in enumerate(FILTERS)), F.lit(0))
    passed = ~F.greatest(*[F.coalesce(F.col(f), F.lit(False)) for f in FILTERS])  # a flag outside the grouping set is null
    count = lambda c: F.sum(F.when(passed, F.col(c)).otherwise(0)).cast("long").alias(c)
    rows = cube.select(F.coalesce("part", F.lit("")).alias("part"), F.col("every").cast("int").alias("every"), mask.alias("mask"), passed.alias("passed"), *FILTERS, "n", "good", "toxic")
    return rows.groupBy("part", "every", "mask").agg(*[count(c) for c in ("n", "good", "toxic")])


def steps() -> list[tuple[str, int, str, int, int]]:
    """(order, step, its filter, subset before, subset after) of every order: 600 rows."""
    bit = {f: 1 << i for i, f in enumerate(FILTERS)}
    return [("".join(o), i + 1, f, sum(bit[x] for x in o[:i]), sum(bit[x] for x in o[: i + 1])) for o in permutations(FILTERS) for i, f in enumerate(o)]


def audit(docs: DataFrame, labels: DataFrame, text: str = "text", id: str = "doc_id", part: str = "lang") -> DataFrame:
    """part, filter_order, step, filter, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley, for each part,
    every order of the filters and each step, zeros included; the part null stands for the whole table.

    A filter removes all that fail it where it comes first, and what fails it alone where it comes last. Edge cases are those
    of `profile`; an empty text fails A, and no other filter but E. An empty table gives no rows. Other columns are ignored.
    """
    left = materialize(survivors(profile(docs, labels, text, id, part)))
    plan = docs.sparkSession.createDataFrame(steps(), "filter_order string, step int, filter string, before int, after int")
    side = lambda name: left.select("part", "every", F.col("mask").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in ("n", "good", "toxic")])
    pairs = side("before").join(F.broadcast(plan), "before").join(side("after"), ["part", "every", "after"])
    lost = lambda c: F.col(f"{c}_before") - F.col(f"{c}_after")
    of_filter = W.partitionBy("part", "every", "filter")  # 120 rows each
    at = lambda step: F.max(F.when(F.col("step") == step, F.col("removed"))).over(of_filter)
    figures = pairs.select("part", "every", "filter_order", "step", "filter", F.col("n_after").alias("kept"), lost("n").alias("removed"), lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost")).withColumns(
        {"redundant": at(1) - F.col("removed"), "unique_fails": at(len(FILTERS)), "shapley": F.sum("removed").over(of_filter)}
    )
    return figures.select(F.when(F.col("every") == 0, F.col("part")).alias("part"), "filter_order", "step", "filter", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
