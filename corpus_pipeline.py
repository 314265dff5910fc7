"""From documents to packed training sequences: five stages, each by one operator of setforge.llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from setforge.llm.common import stage, table
from setforge.llm.jaccard import one_of_each
from setforge.llm.linededup import deduped
from setforge.llm.mixing import mixed
from setforge.llm.packing import pack
from setforge.llm.quality import good_documents
from setforge.llm.tokens import word_bpe


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the isolation forest keep."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near-equal lines stay once; a document of which no line is left goes."""
    return deduped(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words a shingle, a similarity of 0.8."""
    return one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 token ids."""
    return pack(docs, word_bpe())


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("mixing", mixing),
    ("packing", packing),
]

#: Forest, retrieval order and token ids are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
