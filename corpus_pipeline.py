"""Corpus pipeline: ``documents`` through five training-data operators.

``STAGES`` lists (name, function); a function takes ``(spark, docs, sf_dir)``
and returns a DataFrame.  Each stage's rows are written as Parquet under the
shared checkpoint folder and read again as the next stage's ``docs``, so a
lost executor repeats at most one stage.  All stages but the last return the
columns of ``documents``.

Defined results: a document without text or letters goes at language
identification; of near duplicates the one with the least doc_id stays (rows
repeating it stay once; a row without doc_id stays where no other of its group
has one; rows that share a doc_id are told apart by their texts); a document that overlaps a benchmark item goes; personal data is replaced in
what is left; the rest is encoded whole.  Extra columns are passed through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from duetlog.llm import decontam, langid, pieces, pii, simhash
from duetlog.llm.common import read, saved


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach."""
    return langid.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return simhash.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ``benchmark``."""
    return decontam.cleaned(docs, read(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redacted(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled pieces of every document, checked to decode to its text."""
    return pieces.encoded(docs, pieces.load())


STAGES = [
    ("language_id", language),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("personal_data", personal_data),
    ("piece_encoding", encoding),
]

#: Learned and sampled stages have no SQL form; tests compare ``run`` with
#: brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's rows."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
