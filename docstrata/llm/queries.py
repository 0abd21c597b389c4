"""The training-data queries; each runs its operator with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docstrata.llm import clusters, history, leaks, mixing, readlevel, subjects, survivor
from docstrata.sources.tables import cut, table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return p1_reasons(spark, d).select("item_key")


def p1_reasons(spark: SparkSession, d: str) -> DataFrame:
    return history.repeated_rows(*(table(spark, d, t) for t in ("docs", "documents", "claims_done", "fulltext_md")))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return survivor.best_values(survivor.values_judged(table(spark, d, "documents")))


def p2_values(spark: SparkSession, d: str) -> DataFrame:
    return survivor.values_judged(table(spark, d, "documents")).drop("last")


def _subjects(spark: SparkSession, d: str) -> DataFrame:
    return subjects.document_subjects(*(table(spark, d, t) for t in ("documents", "auto_topics", "subjects")))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _subjects(spark, d).select("doc_id", "subject")


def p3_composition(spark: SparkSession, d: str) -> DataFrame:
    return _subjects(spark, d).groupBy("subject").agg(F.count(F.lit(1)).alias("n_docs"), F.round(F.avg("posterior"), 3).alias("avg_posterior"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return clusters.cluster_pairs(cut(clusters.similarity_clusters(table(spark, d, "documents"))))


def p4_clusters(spark: SparkSession, d: str) -> DataFrame:
    return clusters.describe_clusters(cut(clusters.similarity_clusters(table(spark, d, "documents"))))


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    return leaks.leaked_items(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d).filter("kind = 'verbatim'").select("doc_id", "item_id")


def p6_items(spark: SparkSession, d: str) -> DataFrame:
    """Which test items leaked, how and into how many documents."""
    return _leaks(spark, d).groupBy("item_id", "kind").agg(F.count(F.lit(1)).alias("n_docs"), F.max("words").alias("longest_run"))


def p7_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mixed_documents(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_report(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return readlevel.reading_levels(table(spark, d, "documents"), table(spark, d, "labels"))


def p8_profile(spark: SparkSession, d: str) -> DataFrame:
    """How demanding the corpus is: documents of each level, with what the formula measures."""
    g = readlevel.graded(table(spark, d, "documents"), table(spark, d, "labels")).groupBy("reading_level")
    return g.agg(F.count(F.lit(1)).alias("n_docs"), F.round(F.avg("unfamiliar"), 4).alias("unfamiliar_share"), F.round(F.avg("sentence"), 2).alias("words_per_sentence"))


def queries() -> dict:
    fs = [
        p1_found, p1_reasons, p2_found, p2_values, p3_found, p3_composition, p4_found, p4_clusters,
        p6_found, p6_items, p7_mix, p7_report, p8_found, p8_profile,
    ]
    return {f.__name__: f for f in fs}


def oracle_sql() -> dict[str, str]:
    """None: whole-table SQL of these operators is too slow; they are tested against brute force."""
    return {}
