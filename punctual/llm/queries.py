"""Registered queries of the operators: production parameters, whole tables."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from punctual.llm import (
    html_text,
    importance,
    line_copies,
    mixing,
    ngram,
    quality,
    repeats,
    sharding,
    simhash,
    tokens,
    topk,
    warc,
    whitening,
)
from punctual.llm.common import table

RANK_FILE = "byte_bpe_multi_50k.tiktoken"


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.grouped(table(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_digests(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path(RANK_FILE),
        public_tokenizers.PATTERN,
    )


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents"))


def op5_ngram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram.scored_texts(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf_dir, "pages"))


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeat_digests(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"), columns=["doc_id"])


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.page_texts(table(spark, sf_dir, "pages"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resampled(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op12_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_copies.line_digests(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    operators = (
        op1_topk,
        op2_simhash,
        op3_bpe,
        op4_mixing,
        op5_ngram,
        op6_warc,
        op7_repeats,
        op8_quality,
        op9_sharding,
        op10_html,
        op11_importance,
        op12_lines,
        op13_whitening,
    )
    return {f.__name__: f for f in operators} | {"pipeline": corpus_pipeline.run}
