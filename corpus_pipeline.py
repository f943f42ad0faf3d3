"""Cleaning of a document corpus in stages, each by one operator of ``skyledger.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from skyledger.llm import jaccard, langid, line_runs, packing, secrets
from skyledger.llm.batches import held_out, stored
from skyledger.llm.tables import table
from skyledger.session import scratch_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the model knows; rejected ones go."""
    model = langid.fit(docs.filter(~held_out(F.col("doc_id"))))
    return langid.identify(docs, model).filter(~F.col("rejected")).select(docs.columns)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are cut from the texts; emptied documents go."""
    return line_runs.without_later_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the least id."""
    return jaccard.one_of_each_group(docs)


def secret_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; the documents stay."""
    return secrets.redact(docs)


def batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length bucket and batch of every document that is left."""
    sized = stored(packing.token_lengths(docs.select("doc_id", "text")).drop("text"), "lengths")
    return packing.pack(sized, length="n_tokens")


STAGES = [
    ("language", language),
    ("repeated_lines", repeated_lines),
    ("near_copies", near_copies),
    ("secrets", secret_spans),
    ("packing", batches),
]

# Language, near copies and packing rest on trained or searched models: no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and reread by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
