"""Registered queries of the text operators and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from framelake.llm import (alignment, decontaminate, exact_dedup, jaccard, language, packing, passages, phrases, pii, quality, simhash,
                           substrings, toxicity)
from framelake.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


@register("op1_quality")
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op2_language")
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.digest(table(spark, sf_dir, "documents"))


@register("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op4_passages")
def op4_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.digest(table(spark, sf_dir, "documents"))


@register("op5_substrings")
def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest(table(spark, sf_dir, "documents"))


@register("op6_jaccard", jaccard.DIGEST_SQL)
def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.digest(table(spark, sf_dir, "documents"))


@register("op7_fingerprints")
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(table(spark, sf_dir, "documents"))


@register("op8_decontaminate", decontaminate.DIGEST_SQL)
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op9_pii")
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


@register("op10_pack")
def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(table(spark, sf_dir, "documents"))


@register("op11_exact", exact_dedup.DIGEST_SQL)
def op11_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.digest(table(spark, sf_dir, "documents"))


@register("op12_phrases", phrases.DIGEST_SQL)
def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.digest(table(spark, sf_dir, "documents"))


@register("op13_alignment")
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.digest(table(spark, sf_dir, "documents"))
