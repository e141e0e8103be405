"""The corpus pipeline: stages over documents, each written as Parquet and read again.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import mixing, near_dedup, pieces, substring_dedup, toxicity
from skyledger.llm.queries import table, vocabulary
from skyledger.sources.staging import stage

PASSAGE_WORDS = 50


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 per cent of its five-word shingles."""
    return near_dedup.keep_one(docs, percent=80, shingle=5)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 50 words that also stand elsewhere; n_chars follows the text."""
    cut = substring_dedup.without_repeats(docs, window=PASSAGE_WORDS)
    return cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in cut.columns else cut


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target asks for."""
    return mixing.mix(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text that is left."""
    return pieces.encode(docs, vocabulary("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near-copies", drop_near_copies),
    ("passages", cut_passages),
    ("mixture", mix_sources),
    ("pieces", encode_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


# the models, groupings and encodings of the stages are beyond SQL; tests hold each stage against a plain version
ORACLE_SQL = None
