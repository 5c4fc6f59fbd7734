"""The corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept, written as Parquet and read again.
All but the last return the columns of documents; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from metricwatch.llm import decontamination, near, packing, private, quality
from metricwatch.llm.shared import stored, table
from metricwatch.llm.tokens import BYTE_BPE, vocabulary


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise quality classifier rejects go."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the least id stays; rows without an id are compared too."""
    return near.one_of_each(docs, unnamed=True)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def hide_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts, and terms that disclose it, are replaced."""
    return private.sanitised(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts as token pieces, each with its place in a sequence."""
    return packing.best_fit(packing.token_pieces(docs, vocabulary(BYTE_BPE)))


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("PII", hide_private),
    ("best-fit packing", pack_sequences),
]

#: SQL has no tokenizer, nor the fitted classifier.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stored(docs)
    return docs
