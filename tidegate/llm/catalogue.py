"""Queries of the pipeline operators and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import (
    chat_format, fingerprints, jaccard_join, license_scan, mixing, piece_codec, prefix_trie,
    quality_rules, secret_scan, token_counts, toxicity, url_filter, whitening,
)
from tidegate.llm.shared import ship, table
from tidegate.llm.sql import SQL


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.license_report(table(spark, folder, "documents"))


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op3_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprint_report(table(spark, folder, "documents"))


def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.url_report(table(spark, folder, "pages"))


def op5_piece_codec(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return piece_codec.encode_documents(docs, with_ids=False, with_text=False)


def op6_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    classes = jaccard_join.similarity_classes(table(spark, folder, "documents"))
    return classes.select("doc_id", "class_id", "n_copies", "n_links")


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents").select("doc_id", "text"))


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.quality_report(table(spark, folder, "documents").select("doc_id", "text", "lang"))
    return judged.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept", *quality_rules.MEASURES)


def op9_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    return chat_format.conversation_report(turns.unionByName(extra))


def op10_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.secret_report(table(spark, folder, "documents"))


def op11_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return toxicity.toxicity_report(docs, table(spark, folder, "labels"))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.trie_report(table(spark, folder, "conversations"))


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitening_report(table(spark, folder, "embeddings"))


def _shipped(query):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return query(ship(spark), folder)

    return run


QUERIES = {
    query.__name__: _shipped(query)
    for query in (
        op1_license_scan, op2_mixing, op3_fingerprints, op4_url_filter, op5_piece_codec,
        op6_jaccard_join, op7_token_counts, op8_quality_rules, op9_chat_format, op10_secret_scan,
        op11_toxicity, op12_prefix_trie, op13_whitening,
    )
}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
