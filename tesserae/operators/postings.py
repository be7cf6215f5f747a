"""Positional search: every word with its place, phrases as joins on places."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.functions import text
from tesserae.operators.synonyms import rewrites

#: Places between the last word of a field (or of a value in a list) and the first of the next: no phrase bridges them.
GAP = 100


def postings(docs: DataFrame, id: str, *fields: str, gap: int = GAP) -> DataFrame:
    """(term, id, place): the words of the fields in order, lists value by value, each behind a gap. Null fields have no words."""
    types = dict(docs.dtypes)
    parts = F.concat(*[F.coalesce(F.col(f), F.array().cast("array<string>")) if types[f].startswith("array") else F.array(F.col(f)) for f in fields])
    words = F.transform(parts, lambda p: F.coalesce(text.tokens(p), F.array().cast("array<string>")))
    # each part begins where the one before ends, and a gap later
    begun = F.aggregate(words, F.struct(F.lit(0).alias("next"), F.array().cast("array<struct<term:string,place:int>>").alias("out")), lambda a, w: F.struct(
        (a["next"] + F.size(w) + gap).alias("next"), F.concat(a["out"], F.transform(w, lambda t, i: F.struct(t.alias("term"), (a["next"] + i).cast("int").alias("place")))).alias("out")
    ))
    return docs.select(F.col(id).alias("id"), F.explode(begun["out"]).alias("w")).select("w.term", "id", "w.place")


def phrases(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted (phrase) -> (phrase, id, n): how often each phrase stands in a document, its words side by side. A phrase without a word is
    found nowhere."""
    split = wanted.select("phrase").distinct().withColumn("words", text.tokens(F.col("phrase"))).where(F.size("words") > 0)
    terms = split.select("phrase", F.size("words").alias("size"), F.posexplode("words").alias("k", "term"))
    met = index.join(terms, "term").select("phrase", "size", "id", (F.col("place") - F.col("k")).alias("start"))
    return met.groupBy("phrase", "id", "start", "size").count().where("count = size").groupBy("phrase", "id").agg(F.count("*").alias("n"))


def search(index: DataFrame, queries: DataFrame, rules: DataFrame) -> DataFrame:
    """queries (query) -> (query, id, n): documents with a phrase that the query stands for by the synonym rules."""
    stands = rewrites(rules)
    asked = queries.select("query", F.lower("query").alias("phrase")).distinct()
    meant = asked.join(stands, "phrase", "left").select("query", F.coalesce("replacement", "phrase").alias("phrase")).distinct()
    found = phrases(index, meant.select("phrase"))
    return meant.join(found, "phrase").groupBy("query", "id").agg(F.sum("n").alias("n"))
