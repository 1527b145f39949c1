"""A cleaning pipeline over ``documents``: classify, deduplicate, decontaminate, redact, encode.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sunledger.llm import common, decontaminate, ngram_join, pii, quality_gam, sentence_pieces
from sunledger.session import materialise


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality_gam.accepted(docs, quality_gam.fit(docs, common.table(spark, sf_dir, "labels")))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8)."""
    return ngram_join.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark, by the contamination rule."""
    return decontaminate.clean(docs, common.table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return pii.redact(docs, pii.fit(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text."""
    return sentence_pieces.encode(docs, sentence_pieces.model_path(), digests=True)


STAGES = [
    ("quality classifier", classify),
    ("n-gram Jaccard join", deduplicate),
    ("benchmark decontamination", decontaminated),
    ("personal data", redact),
    ("SentencePiece encoding", encode),
]

#: Models, components and subword ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
