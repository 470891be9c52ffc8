"""From raw documents to packed training sequences: five operators, one after another.

Toxic documents go, then exact copies, then near copies (one document of each group stays); the rest is mixed to the sources' target weights, in
whole repetitions of documents, and packed. Every stage works on all that the one before kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillstone.llm import exact, mixing, neardup, packing, toxicity
from quillstone.llm.common import Scratch

#: Near copies share this much of their five-word shingles, or more; op5 alone takes 85.
NEAR_PERCENT = 80
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that don't score as toxic; learned from the labels beside them."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:  # noqa: ARG001
    return exact.deduplicated(docs)


def unlike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:  # noqa: ARG001
    return neardup.without_near_duplicates(docs, NEAR_PERCENT)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:  # noqa: ARG001
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:  # noqa: ARG001
    return packing.packed(docs)


STAGES: list[tuple[str, Stage]] = [("toxicity", clean), ("exact dedup", distinct), ("near dedup", unlike), ("mixing", mixed), ("packing", packed)]

#: SQL can't express the stages (trained scores, seeded hashes); tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = scratch.cut(docs)
    return docs
