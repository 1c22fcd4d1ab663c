"""From raw documents to token ids: filter, deduplicate, mask secrets, mix sources, encode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cytoloom.llm import jaccard_join, mixing, pieces, secrets, toxicity
from cytoloom.session import stored

# Words of a shingle and the similarity from which on two documents are near copies.
SHINGLE_WORDS = 5
SIMILARITY = (4, 5)
# The mix repeats no source more often than this, relative to the source repeated least.
MAX_REPETITION = 2.0


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.drop_near_copy_rows(docs, SHINGLE_WORDS, *SIMILARITY)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(docs, max_repetition=MAX_REPETITION)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode(docs, pieces.read_model())


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("secret_scan", mask_secrets),
    ("source_mixing", mix_sources),
    ("sentencepiece", encode),
]

# A trained classifier and a Viterbi search are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; every stage is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
