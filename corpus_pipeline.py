"""From raw documents to token ids: each stage takes (spark, docs, sf_dir) and gives the next one its documents.

Every stage calls one operator on all that its predecessor kept; between stages the documents are written and read again.
Documents have at least doc_id, text and source; other columns are carried along. The last stage gives the ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plumbline.llm import fertility, grace, jaccard, mixing, ranker, viterbi
from plumbline.llm.common import prepared, settle, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier, learned from `labels`, does not reject."""
    return ranker.accepted(docs, table(prepared(spark), sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    prepared(spark)
    return grace.without_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    prepared(spark)
    return jaccard.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, each as often as the mix of sources takes it."""
    prepared(spark)
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' ids."""
    prepared(spark)
    return viterbi.encoded(docs, fertility.vocabulary_path())


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("mixing sources to target weights", mix),
    ("SentencePiece encoding and decoding", encode),
]

#: The classifier is trained by steps of descent, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder of tables."""
    docs = table(prepared(spark), sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
