"""The corpus pipeline: what is left of ``documents`` after five stages, mixed to target weights."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gameflow.llm import decontam, mixing, quality, simhash, suffixes
from gameflow.session import delete_path, scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules accept, unchanged."""
    return quality.keep_good(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts with near fingerprints the document with the smallest doc_id."""
    return simhash.keep_one(docs)


def repeat_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of over 50 words, or strings of 400 bytes, that repeat in the corpus;
    ``n_chars`` follows the text."""
    return suffixes.remove_repeats(docs, "n_chars", words=51)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixing.mix_sources(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_stage),
    ("near duplicates", near_duplicate_stage),
    ("repeated strings", repeat_stage),
    ("decontamination", decontamination_stage),
    ("source mix", mixing_stage),
]

#: Suffix sorting, fingerprint trees and block-max retrieval have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each result is written and read again, and goes once
    the next one is there."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            delete_path(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
