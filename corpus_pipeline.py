"""A corpus pipeline over ``documents``, stage by stage.

Each stage takes what the one before it kept, as written and read again. All but the last give
the columns of ``documents``; the last gives each remaining document's ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, decontam, exact_dedup, jaccard, langid
from tidemark.llm.queries import tokenizer_path
from tidemark.llm.tables import kept, table

#: Near duplicates share 80 % of their sets of five words in a row.
NEAR_SHINGLE, NEAR_SIMILAR = 5, (80, 100)


def accept_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that language ID accepts, by models of the labelled ones among them."""
    return langid.keep_accepted(docs, langid.train(docs))


def dedup_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return exact_dedup.keep_one(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the least id stays."""
    return jaccard.keep_one(docs, NEAR_SHINGLE, NEAR_SIMILAR)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that know no benchmark item."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of each document."""
    return bpe.encode(docs, tokenizer_path())


STAGES = [
    ("language ID", accept_language),
    ("exact dedup", dedup_exact),
    ("n-gram Jaccard join", dedup_near),
    ("benchmark decontamination", decontaminate),
    ("BPE encoding", tokenize),
]
#: Language models and tokenizers can't be put in SQL; a brute-force version is in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each over everything that the one before it kept."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)
