"""The thin registered queries of the corpus operators, and their oracle SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from larder.llm import (
    bpe,
    collocations,
    exact_dedup,
    language,
    licenses,
    line_dedup,
    minhash,
    mixing,
    oracle,
    periodic_runs,
    quality,
    speculative_bpe,
    suffix_dedup,
    toxicity,
)
from larder.llm.tables import read_table

#: The rank file of the registered encoding query; a parameter of the operator.
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: The tokenizer file of the query with merges; a parameter of the operator.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read_table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(read_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    )


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(read_table(spark, sf_dir, "documents"), k=3, percent=85)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    )


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(read_table(spark, sf_dir, "documents"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return bpe.encoding_report(docs, RANKS, public_tokenizers.PATTERN)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(read_table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_report(read_table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeats_report(read_table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return periodic_runs.run_report(periodic_runs.with_cycles(docs))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speculative_bpe.encoding_report(read_table(spark, sf_dir, "documents"), TOKENIZER)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_exact_dedup,
        op2_line_dedup,
        op3_toxicity,
        op4_near_dedup,
        op5_quality_rules,
        op6_mix_sources,
        op7_byte_bpe,
        op8_license_scan,
        op9_language_id,
        op10_suffix_dedup,
        op11_collocations,
        op12_periodic_runs,
        op13_bpe,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op1_exact_dedup": oracle.EXACT_DEDUP,
    "op2_line_dedup": oracle.LINE_DEDUP,
    "op4_near_dedup": oracle.NEAR_DEDUP,
    "op10_suffix_dedup": oracle.SUFFIX_DEDUP,
    "op11_collocations": oracle.COLLOCATIONS,
}
