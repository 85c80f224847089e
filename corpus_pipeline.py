"""A corpus pipeline over ``documents``: every stage's result is written and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from silverline.llm import mixing, quality, secrets, sentencepiece, simhash
from silverline.llm.common import materialise, table
from silverline.llm.queries import piece_model


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the certified cutoffs."""
    return quality.kept_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return simhash.representatives(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with secrets masked."""
    return secrets.redacted_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the sources' targets."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document."""
    return sentencepiece.encode_documents(docs, piece_model())


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("secret scans", secret_scan),
    ("source mixing", mix_sources),
    ("SentencePiece encoding", encode),
]

# Fingerprints and piece merges have no SQL form; tests/llm/test_pipeline.py holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``.

    Every row that a stage keeps goes to the next. Null texts and ids, empty and very long texts, repeated rows and further columns
    are taken as the stages' operators say; an empty table gives no rows.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
