"""From raw documents to a deduplicated, mixed and encoded corpus, in five stages.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is written as
Parquet and read again for the next one. All but the last return the columns of documents.

Rows are decided on by id and text together, so rows that repeat an id, or have none, are judged
by their own text. A null text counts as empty and fails the quality rules. Of rows equal in id
and text one stays. Empty tables pass every stage; further columns are handed through.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from footfall.llm import bpe, exact_dedup, minhash_dedup, quality_rules, source_mixing
from footfall.llm.tables import hand_over, table

#: Share of the input's tokens to aim at, and how they divide. The budget lets every clean
#: document stay: scarce tokens are made up for by copies, not by dropping clean text.
MIX_BUDGET = 1.1
MIX_WEIGHTS = {"clean": 0.97, "low_quality": 0.02, "toxic": 0.01}


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules or are outliers; null, empty and short texts go."""
    return quality_rules.keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id stays; without any id, any one row."""
    return exact_dedup.keep_first_copies(docs, exact_dedup.open_index(spark))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8) stays: that with the
    smallest id. Texts without words are no duplicates."""
    return minhash_dedup.keep_one_of_each(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the fitted rates say; labels whose ids are gone teach nothing."""
    return source_mixing.copies_of(docs, table(spark, sf_dir, "labels"), MIX_WEIGHTS, MIX_BUDGET)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and of the decoded text."""
    return bpe.round_trip(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("exact dedup", exact),
    ("MinHash near-dedup", near),
    ("mixing sources to target weights", mixture),
    ("BPE encoding and decoding", encoded),
]

#: The outlier estimates, near-duplicate components and fitted rates have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = hand_over(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
