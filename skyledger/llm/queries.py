"""The registered queries of this subpackage and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import (
    collocations, license_scan, mixing, near_dedup, pieces, prefix_trie, quality_model, quality_rules, shards,
    substring_dedup, token_counts, toxicity, vector_dedup,
)

TOKENIZERS = "/opt/tokenizers"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function=None, *, sql: str | None = None):
    """Register a query under its function's name."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register(function) if function else register


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file."""
    try:
        from public_tokenizers import path
    except ImportError:
        return f"{TOKENIZERS}/{name}"
    return path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(sql=substring_dedup.REPEATS_SQL)
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without repeated passages of 35 words."""
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), window=35)


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(sql=near_dedup.NEAR_SQL)
def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document, over word triples at 85 per cent."""
    return near_dedup.near_groups(table(spark, sf_dir, "documents"), percent=85, shingle=3)


@query
def op4_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality_model.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and whether they are over 2048."""
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document."""
    return quality_rules.judge(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@query(sql=mixing.MIX_SQL)
def op7_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    taken = mixing.copies(table(spark, sf_dir, "documents"))
    return taken.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("n_copies")).alias("taken"))


@query
def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document, and whether decoding gives its text back."""
    return pieces.encode(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"), with_pieces=False)


@query
def op9_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return shards.shard_table(table(spark, sf_dir, "documents"), 8)


@query(sql=vector_dedup.LINKS_SQL)
def op10_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every embedding at a cosine of 0.9."""
    return vector_dedup.link_vectors(table(spark, sf_dir, "embeddings"), least=0.9)


@query(sql=collocations.PHRASES_SQL)
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest phrases of every language, with their exact counts."""
    return collocations.mine_phrases(table(spark, sf_dir, "documents"), least=30, top=2000)


@query(sql=prefix_trie.NODES_SQL)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the rebuilt conversations' prefix trie."""
    return prefix_trie.prefix_nodes(table(spark, sf_dir, "conversations"))


@query
def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices and expressions of every document."""
    return license_scan.scan_licenses(table(spark, sf_dir, "documents")).drop("places", "found")
