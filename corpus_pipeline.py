"""A pipeline over ``documents``: toxic documents go, copies and near copies go, personal data is masked, the rest is packed.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; all but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txnsieve.llm import exact_dedup, ngram_join, packing, pii, toxicity
from txnsieve.llm.common import documents, ship_package, table
from txnsieve.llm.queries import tokenizer_path
from txnsieve.session import staged

#: Models and groups decide about single documents, which SQL cannot repeat; tests use brute force instead.
ORACLE_SQL = None


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose toxicity reaches the threshold."""
    ship_package(spark)
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row of the largest id of each text."""
    return exact_dedup.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each group of near duplicates."""
    ship_package(spark)
    return ngram_join.keep_one(docs)


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind; ``n_chars`` follows the text."""
    return pii.mask_pii(docs, length_col="n_chars")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences with their places."""
    ship_package(spark)
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("ngram_join", without_near_copies),
    ("pii", masked),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written once and read again by the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
