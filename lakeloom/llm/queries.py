"""The queries of this subpackage: each applies an operator to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lakeloom.llm import bpe, decontaminate, html_extract, lm_score, near_dedup, shards, telephony, token_counts, token_store, toxicity
from lakeloom.llm.common import new_path, table, written

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(table(spark, sf_dir, "pages"))


def op2_telephony(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telephony.analysed(written(telephony.store(table(spark, sf_dir, "documents")), "media", compression="zstd"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "tokens")
    token_store.write(table(spark, sf_dir, "documents"), path, TOKENIZER)
    return token_store.digests(spark, path)


def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shards(table(spark, sf_dir, "documents"), 16)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), PIECES)


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), k=3, num=85, den=100, bands=20, rows=4)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.scores(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), exclude_remainder=0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_html_extract, op2_telephony, op3_decontaminate, op4_token_store, op5_shards, op6_token_counts, op7_near_dedup, op8_bpe, op9_lm_score, op10_toxicity)}

#: None of these can be said in SQL (hashes of the tokenizers' ids, trained models, float scores); tests hold them against brute force.
ORACLE_SQL: dict[str, str] = {}
