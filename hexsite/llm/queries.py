"""The queries of this subpackage: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from hexsite.llm import audio, chat, decontam, html, jaccard, langid, mixing, suffix, tokens, warc
from hexsite.llm._shared import table


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.op5(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.op6(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op7(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.op8(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.op2(table(spark, sf_dir, "documents"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.op9(table(spark, sf_dir, "documents"))


def op3_telephony_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audio.op3(table(spark, sf_dir, "documents"))


def op4_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.op4(table(spark, sf_dir, "pages"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.op10(table(spark, sf_dir, "pages"))


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.op1(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op5_benchmark_decontamination, op6_token_id_output, op7_source_mixing, op8_language_id, op2_ngram_jaccard_join, op9_suffix_array_dedup, op3_telephony_audio, op4_warc_zstd, op10_html_extraction, op1_chat_formatting)}


def oracle_sql() -> dict[str, str]:
    return {"op5_benchmark_decontamination": decontam.ORACLE_SQL, "op2_ngram_jaccard_join": jaccard.ORACLE_SQL, "op4_warc_zstd": warc.ORACLE_SQL, "op1_chat_formatting": chat.ORACLE_SQL, "op7_source_mixing": mixing.ORACLE_SQL}
