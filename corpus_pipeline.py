"""Corpus pipeline over `documents`: language ID, exact dedup, SimHash near-dedup, source mixing, best-fit packing.

Each stage reads what its predecessor wrote. The first four return the columns of documents; the last returns one row per
packed piece. `mixing` may return a document twice: a complete epoch over its source comes before fractional selection.

All stages take null in any column, empty and very long texts, repeated rows, empty tables and extra columns, which they
hand on; each says below what becomes of such rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tesserae.llm import exact_dedup, langid, mixing, near_copies, packing
from tesserae.llm.common import materialize
from tesserae.llm.queries import TOKENIZER


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a learned language; drops those without a letter (null and empty texts among them) and those
    unlike every profile. Ties go to the language first in order; repeated rows share their fate."""
    return langid.known(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (null counts as empty) keeps the row with the smallest doc_id; a null id loses to any other, and of
    repeated rows with the id that stays one is kept."""
    return exact_dedup.survivors(docs, keep="min")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (shingles of 5 words, Jaccard similarity 0.8 or more, linked pair by pair) keeps the
    document with the smallest doc_id. SimHash of several hundred bits finds the pairs, an exact check confirms them; a pair
    at exactly 0.8 meets with probability 0.98. Texts without a word are alike; of a group without any id all rows stay."""
    return near_copies.one_of_each(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it. Null is a source of its own; of equal rows at which a source's budget
    ends so many are taken as come nearest to it; documents without words are worth nothing and come with complete epochs."""
    return mixing.repeated(mixing.mix(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a packed sequence, which holds 64 pieces and 90 % of the attention cost of one full piece at
    most, besides its tokens; a longer piece stands alone. Null and empty texts are a piece of one id; rows with one id are
    packed apart."""
    # workers of the stages before still hold memory: fewer words are remembered
    return packing.pack(docs, TOKENIZER, documents=64, attention=0.9 * packing.CAPACITY**2, cached_words=200_000)


STAGES = [("language_id", language), ("exact_dedup", exact), ("simhash_near_dedup", near), ("mixing", mixture), ("packing", packed)]

#: Rank-order profiles, XXH64 fingerprints and the tokenizer have no SQL form; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
