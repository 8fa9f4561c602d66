"""A training-data pipeline over ``documents`` in five stages, each one of the operators.

Every stage reads what its predecessor wrote. Quality rules drop documents, the n-gram Jaccard
join keeps one document of each group of near duplicates, secret scans mask what they find,
mixing takes documents as often as their source's target asks (a document taken twice is two
rows), and piece encoding adds ids and digests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidegate.llm import jaccard_join, mixing, piece_codec, quality_rules, secret_scan
from tidegate.llm.shared import ship, written
from tidegate.session import prepare


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text the rules and the perplexity bands keep."""
    prepare(ship(spark))
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    prepare(ship(spark))
    return jaccard_join.one_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with secrets masked and ``n_chars`` set anew where that changed it."""
    prepare(ship(spark))
    return secret_scan.without_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, one row for each time."""
    prepare(ship(spark))
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids with begin and end, their digest and the decoded text's digest."""
    prepare(ship(spark))
    return piece_codec.encode_documents(docs, with_text=False)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scans", secrets),
    ("mixing sources to target weights", mix),
    ("SentencePiece encoding and decoding", encode),
]

# piece encoding and the character model have no SQL form; tests/llm compares with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other; intermediate tables lie in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
