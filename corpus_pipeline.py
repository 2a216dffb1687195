"""The corpus pipeline: five stages over documents, each written as Parquet and read again.

Rows that a stage rejects are gone for the next one. All stages but the last return the columns of
documents; the last returns the encoded texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, langid, near_copies, quality, sentencepiece_nbest
from tessera.llm.queries import PIECES, read
from tessera.llm.shared import fresh_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the multiple-instance classifier, fitted on the labels, does not reject."""
    model = quality.fit(docs, read(spark, sf_dir, "labels"), ~langid.in_part("doc_id", 4, 2))
    return quality.keep_good(docs, model)


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language compression tells with no narrow margin."""
    return langid.keep_identified(docs)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that a Jaccard similarity of 0.8 over five-word shingles connects, the document with the smallest id.

    SimHash classes find the close copies; what lies beyond their 4 bits is found by prefixes. Both are
    confirmed on whole sets.
    """
    return near_copies.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not repeat the benchmark."""
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece ids of every text that is left, with the next best segmentations."""
    return sentencepiece_nbest.encode(docs, PIECES)


STAGES = [
    ("quality", keep_quality),
    ("language", keep_language),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("decontamination", drop_contaminated),
    ("encoding", encode),
]

#: No SQL expresses the classifiers; tests/llm/test_pipeline.py checks the rows against plain Python instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, each to what its predecessor kept."""
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = fresh_path(spark, f"pipeline-{k}-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
