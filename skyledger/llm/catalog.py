"""One query per operator over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from skyledger.llm import (
    bpe_tree, hard_negatives, jaccard, langid, line_runs, mixing, packing, pii, pivots,
    quality_embed, quality_rules, ranked_search, secrets,
)
from skyledger.llm.batches import held_out, stored
from skyledger.llm.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

PREDICTED = 0.7  # least score of predicted quality


def query(run):
    QUERIES[run.__name__] = run
    return run


@query
def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality_embed.fit(
        quality_embed.fold_labels(docs, table(spark, folder, "labels"), held_out)
    )
    return quality_embed.score(docs, model, positive=1).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= PREDICTED).cast("int").alias("predicted"),
    )


@query
def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pii.find(docs).select(
        "doc_id", *[f"n_{kind}" for kind in pii.KINDS],
        F.sha2("base_spans", 256).alias("base_sha256"), "spans",
    )


@query
def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document."""
    docs = table(spark, folder, "documents")
    model = langid.fit(docs.filter(~held_out(F.col("doc_id"))))
    return langid.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected"
    )


@query
def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts, rule failures and the classifier's verdict for every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality_rules.fit(
        quality_embed.fold_labels(
            docs, table(spark, folder, "labels"), held_out, quality_rules.SAMPLE
        )
    )
    return quality_rules.judge(docs, model).drop("text")


@query
def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Length bucket and batch of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    sized = stored(packing.token_lengths(docs).drop("text"), "lengths")
    return packing.pack(sized, length="n_tokens")


@query
def op6_pivots(spark: SparkSession, folder: str) -> DataFrame:
    """Links and group of near-duplicate vectors of every embedding."""
    return pivots.near_duplicates(table(spark, folder, "embeddings"))


ORACLES["op6_pivots"] = pivots.oracle()


@query
def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secret spans of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return secrets.scan(docs).select(
        "doc_id", "n_assign", "n_access", "n_hex",
        F.sha2("base_spans", 256).alias("base_sha256"), "spans",
    )


@query
def op8_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Links and group of near copies of every document."""
    return jaccard.join_groups(table(spark, folder, "documents"))


ORACLES["op8_jaccard"] = jaccard.oracle()


@query
def op9_line_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Lines, deleted lines and the digest of the remaining text of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_runs.mark_lines(docs).select(
        "doc_id",
        F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("__deleted"), F.lit(0)).cast("long").alias("n_deleted"),
        F.sha2(F.coalesce(line_runs.remaining(), F.lit("")), 256).alias("left_sha256"),
    )


ORACLES["op9_line_runs"] = line_runs.oracle()


@query
def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of the ids of every document and of the bytes they decode to."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return bpe_tree.digest_column(docs).drop("text")


@query
def op11_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return ranked_search.search(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )


ORACLES["op11_search"] = ranked_search.oracle()


@query
def op12_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix(table(spark, folder, "documents"))


ORACLES["op12_mix"] = mixing.oracle()


@query
def op13_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every anchor and positive."""
    return hard_negatives.mine(table(spark, folder, "embeddings"))


ORACLES["op13_negatives"] = hard_negatives.oracle()
