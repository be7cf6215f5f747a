"""Exact dedup by content sort (operator 5), DataFrame functions only.

Splitters sampled by Spark range-partition the rows on the leading bytes of the text and a 64-bit hash of all of it, so
splitters stay small however long the texts are. Inside a partition an external sort places equal texts next to each
other, and the window compares each text with its neighbour byte by byte. A text with very many copies would fill one
partition: a first count by hash finds such texts, their rows are dealt over salted runs that are sorted in the same
pass, and only the head of each run takes part in a second, small content sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tesserae.llm.common import materialize, small, text_or_empty

PREFIX = 32
HOT_ROWS = 200


def _order(keep: str) -> Column:
    return F.desc_nulls_last("id") if keep == "max" else F.asc_nulls_last("id")


def _sorted(rows: DataFrame, keys: list[str], keep: str) -> DataFrame:
    """Adds head (id of the row that stays), n (rows) and rank within equal texts under `keys`."""
    run = W.partitionBy(*keys, "text")
    ranked = run.orderBy(_order(keep))
    whole = ranked.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return rows.repartitionByRange(*keys).withColumns(
        {"rank": F.row_number().over(ranked), "head": F.first("id").over(whole), "n": F.sum("weight").over(whole)}
    )


def _keyed(docs: DataFrame, text: Column, id: str, hot_rows: int) -> tuple[DataFrame, bool]:
    base = docs.select(F.struct("*").alias("row"), F.col(id).alias("id"), text.alias("text")).withColumns(
        {"hash": F.xxhash64("text"), "prefix": F.substring("text", 1, PREFIX), "weight": F.lit(1).cast("long"), "place": F.monotonically_increasing_id()}
    )
    hot = materialize(base.groupBy("hash").agg(F.count("*").alias("copies")).where(F.col("copies") > hot_rows))
    if hot.isEmpty():
        return base.drop("place").withColumn("salt", F.lit(-1).cast("long")), False
    runs = F.ceil(F.col("copies") / hot_rows)
    salt = F.when(F.col("copies").isNull(), F.lit(-1).cast("long")).otherwise(F.pmod(F.col("place"), runs))  # by row, so that repeated ids share no run
    return base.join(small(hot), "hash", "left").withColumn("salt", salt).drop("copies", "place"), True


def survivors(docs: DataFrame, text: str = "text", id: str = "doc_id", keep: str = "min", hot_rows: int = HOT_ROWS) -> DataFrame:
    """The rows of docs that stay, all columns: of equal texts (null counts as empty) the one with the smallest
    (keep="max": largest) id. A null id loses to any other; of repeated rows with that id, any one stays."""
    base, some_hot = _keyed(docs, text_or_empty(text), id, hot_rows)
    heads = _sorted(base, ["prefix", "hash", "salt"], keep).where("rank = 1").drop("rank", "head", "weight")
    if not some_hot:
        return heads.select("row.*")
    again = heads.where("salt >= 0").withColumnRenamed("n", "weight")
    hot = _sorted(again, ["prefix", "hash"], keep).where("rank = 1")
    return heads.where("salt < 0").select("row.*").unionByName(hot.select("row.*"))


def decisions(docs: DataFrame, text: str = "text", id: str = "doc_id", keep: str = "min", hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per row of docs: id, keep_id (the id that stays among equal texts: the smallest, or keep="max" the largest),
    group_size, kept, text_sha256.

    Null text counts as empty. A null id loses to any other id; a group of null ids keeps one row and has a null keep_id.
    Of repeated rows with the id that stays, one is kept. An empty table gives no rows. Other columns are ignored.
    """
    base, some_hot = _keyed(docs.select(id, text), text_or_empty(text), id, hot_rows)
    base = base.drop("row").withColumn("sha", F.sha2("text", 256))
    rows = _sorted(base, ["prefix", "hash", "salt"], keep)
    done = lambda df: df.select(
        F.col("id").alias(id), F.col("head").alias("keep_id"), F.col("n").alias("group_size"), (F.col("rank") == 1).alias("kept"), F.col("sha").alias("text_sha256")
    )
    if not some_hot:
        return done(rows)
    head_text = F.when((F.col("salt") >= 0) & (F.col("rank") == 1), F.col("text"))
    rows = materialize(rows.withColumn("text", head_text).drop("prefix", "weight"))
    heads = rows.where("salt >= 0 AND rank = 1").select("id", "text", "sha", "salt", "hash", F.col("n").alias("weight"))
    heads = _sorted(heads.withColumn("prefix", F.substring("text", 1, PREFIX)), ["prefix", "hash"], keep)
    heads = materialize(heads.select("sha", "salt", F.col("rank").alias("run"), F.col("head").alias("keep_id"), F.col("n").alias("all")))
    joined = rows.where("salt >= 0").join(small(heads), ["sha", "salt"]).withColumns(
        {"head": F.col("keep_id"), "n": F.col("all"), "rank": F.when((F.col("rank") == 1) & (F.col("run") == 1), 1).otherwise(2)}
    )
    return done(rows.where("salt < 0")).unionByName(done(joined))
