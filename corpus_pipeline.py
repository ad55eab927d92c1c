"""Corpus pipeline: documents -> quality rules -> line dedup -> near duplicates -> source mix -> pieces.

Each stage takes all that its predecessor kept and returns the columns of
``documents`` (the last: piece ids); ``run`` writes every stage's result to the
shared folder and reads it back, so a lost executor or a rerun starts from there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rekindle.llm import line_chunks, mixing, ngram_join, pieces, quality
from rekindle.llm.common import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents inside the adaptive fences of their language and source; the others go."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated multi-line chunks go from all documents but the first; documents left without a word go."""
    return line_chunks.drop_repeated_chunks(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of "Jaccard of 5-word shingles >= 0.8"."""
    return ngram_join.keep_one(docs, width=5, threshold=0.8)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mixture takes it."""
    return mixing.repeat_documents(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two distinct sampled segmentations of every document's text."""
    return pieces.encode(docs, k=2)


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
          ("mix_sources", mix_sources), ("encode_pieces", encode_pieces)]

#: The lattice sampling is not expressible in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, f"pipeline-{name}")
    return docs
