"""The corpus pipeline: documents to packed training sequences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from framelake.llm import decontaminate, jaccard, packing, pii, quality
from framelake.llm.common import cut, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below its threshold go."""
    labels = quality.labelled(table(spark, sf_dir, "labels"), "quality", quality.learn_rows(5, 0))
    stats = cut(quality.with_statistics(docs), "quality-statistics")
    return quality.keep(docs, quality.fit(stats, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: that of the least
    id.  Five-word shingles, similarity of 0.8 or more."""
    return jaccard.keep_one(docs, n=5, part=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by ``benchmark`` go; all others stay unchanged."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data becomes its kind in angle brackets."""
    return pii.mask(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all that is left, packed into sequences."""
    return packing.digest(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_filter),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("best-fit packing", best_fit_packing),
]

#: a trained classifier decides which rows are left: not expressible in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
