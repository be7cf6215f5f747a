"""Synonym curation and search-time rewriting."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesserae.functions import text

LEAST_RATIO = 0.9


def filtered(term: str, synonyms: list[str], ratio: float = LEAST_RATIO) -> list[str]:
    """Synonyms in order, without the term, texts that differ from it in case or punctuation only, and texts at least
    `ratio` similar to one that is kept already or to the term."""
    plain = lambda s: "".join(c for c in s.lower() if c.isascii() and c.isalnum())
    kept: list[str] = []
    near = lambda a, b: len(a) + len(b) > 0 and 2 * min(len(a), len(b)) >= ratio * (len(a) + len(b)) and SequenceMatcher(None, a, b).ratio() >= ratio
    own = plain(term)
    for s in synonyms:
        p = plain(s)
        if s != term and p != own and not any(near(p, plain(k)) for k in kept) and not near(p, own):
            kept.append(s)
    return kept


def filter_synonyms(terms: DataFrame, term: str = "term", synonyms: str = "synonyms", ratio: float = LEAST_RATIO) -> DataFrame:
    """terms with the greedy filter applied to each row's list. Greedy order has no column form: Arrow batches, no shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch[synonyms] = [filtered(t or "", list(s) if s is not None else [], ratio) for t, s in zip(batch[term], batch[synonyms], strict=True)]
            yield batch

    return terms.mapInPandas(run, terms.schema)


def cleaned_aliases(aliases: Column, label: Column) -> Column:
    """Aliases that differ from the label in more than case and punctuation; null if none is left."""
    kept = F.filter(aliases, lambda a: text.normalized(a) != text.normalized(label))
    return F.when(F.size(kept) > 0, kept)


def merged_aliases(held: Column, new: Column) -> Column:
    return F.array_union(F.coalesce(held, F.array().cast("array<string>")), new)


def fallback(first: Column, second: Column) -> Column:
    return F.when(F.size(F.coalesce(first, F.array().cast("array<string>"))) > 0, first).otherwise(second)


def rewrites(rules: DataFrame) -> DataFrame:
    """rules (kind, terms) -> (phrase, replacement). EQUIVALENT: each term stands for all; REPLACE: the first for the
    others only; KEEP: the first for itself and the others. EXPLICIT, of rule lists that do not tell the two apart, is REPLACE."""
    equal = rules.where("kind = 'EQUIVALENT'").select(F.explode("terms").alias("phrase"), "terms").select("phrase", F.explode("terms").alias("replacement"))
    directed = rules.where("kind IN ('REPLACE', 'KEEP', 'EXPLICIT')").select(F.col("terms")[0].alias("phrase"), F.explode(F.when(F.col("kind") == "KEEP", F.col("terms")).otherwise(F.filter("terms", lambda t, i: i > 0))).alias("replacement"))
    return equal.union(directed).distinct()


def expanded(query: str, rules: DataFrame) -> list[str]:
    """The phrases that a query stands for, itself if no rule names it. Rules of one phrase are few."""
    return sorted(r["replacement"] for r in rewrites(rules).where(F.col("phrase") == query.lower()).collect()) or [query.lower()]


def search(docs: DataFrame, column: str, query: str, rules: DataFrame) -> DataFrame:
    """Rows whose tokens hold one of the query's phrases, word by word."""
    phrases = expanded(query, rules)
    line = F.concat(F.lit(" "), F.array_join(text.tokens(F.col(column)), " "), F.lit(" "))
    hit = F.lit(False)
    for p in phrases:
        hit = hit | line.contains(f" {p} ")
    return docs.where(hit)
