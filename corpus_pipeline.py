"""The corpus pipeline: raw documents to a mixed, tokenized training set.

Each stage takes (spark, docs, sf_dir) and returns what it kept; all but the last return the
columns of documents. ``run`` writes every stage's result as Parquet in the shared folder and
reads it back for the next one, so a lost executor never costs more than its stage. Stages follow each
other in the same executors, so each first bounds the Arrow batches of the session (``bounded_batches``).

Rows with nulls, empty or repeated texts, ties and empty tables have the results that each operator's
docstring defines; an empty table passes through all stages as an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablewright.llm import bpe, host_quality, jaccard_join, mixing, weak_quality
from tablewright.llm.common import bounded_batches, table, written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps."""
    bounded_batches(spark)
    return weak_quality.keep_documents(docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and their host's verdict keep."""
    bounded_batches(spark)
    return host_quality.keep_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    bounded_batches(spark)
    return jaccard_join.keep_one(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each time a document is taken."""
    bounded_batches(spark)
    return mixing.mix_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document of the mix."""
    bounded_batches(spark)
    return bpe.encode(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("source_mix", source_mix),
    ("tokens", tokens),
]

#: SQL can't express the classifier, the components or the tokenizer; tests hold the stages
#: against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
