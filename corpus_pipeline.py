"""A training corpus from raw documents: filter, deduplicate, mix, tokenize.

Each stage takes ``(spark, docs, sf_dir)`` and returns a table; ``run`` writes
each one as Parquet in the shared folder and reads it again for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.llm import mixing, quality, repeats, simhash, tokens
from punctual.llm.common import stored, table

RANK_FILE = "byte_bpe_multi_50k.tiktoken"


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the line-first rules reject."""
    return quality.accepted(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of linked fingerprints: words in threes,
    two differing bits."""
    return simhash.without_near_copies(docs, width=3, radius=2)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove the word sequences that occur again anywhere in the corpus."""
    return repeats.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents until the sources meet their targets."""
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Add the token ids of every text and their number."""
    path = public_tokenizers.path(RANK_FILE)
    encoded = tokens.encode_texts(docs, path, public_tokenizers.PATTERN)
    return encoded.withColumn("n_tokens", F.size("token_ids").cast("long"))


STAGES = [
    ("quality", keep_quality),
    ("near_copies", drop_near_copies),
    ("repeats", cut_repeats),
    ("mixing", mix_sources),
    ("tokens", encode),
]

# Fingerprints and token ids have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
