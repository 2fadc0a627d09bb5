"""A training corpus in stages, from raw documents to packed sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larchfield.llm import contamination, language, lines, minhash, packing
from larchfield.llm.common import materialise, table, tuned


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language can be told; ``lang`` becomes the prediction.

    Rejected are documents that are null or without a letter.
    """
    tuned(spark)
    named = language.identify(docs, language.train(docs))
    kept = named.where(F.col("lang_pred") != language.UNKNOWN)
    return kept.withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove repeated windows of lines; documents with nothing left go."""
    tuned(spark)
    cleaned = lines.dedup_lines(docs)
    emptied = (F.col("lines_removed") > 0) & (F.regexp_replace("text", r"\s", "") == "")
    sized = cleaned.where(~emptied).withColumn("n_chars", F.length("text").cast("long"))
    return sized.select(*docs.columns)


def duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate class."""
    tuned(spark)
    return minhash.keep_one(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove documents that leak an item of the benchmark."""
    tuned(spark)
    found = contamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.where(~F.col("contaminated")).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of 2048 tokens, mixed by source."""
    tuned(spark)
    # Smaller slices of text keep the fifth stage of a run within its executors' memory.
    return packing.pack(docs, packing.default_tokenizer(), slice_bytes=1_000_000).drop("queue")


STAGES = [
    ("language ID", language_stage),
    ("line dedup", line_stage),
    ("near-dedup", duplicate_stage),
    ("decontamination", benchmark_stage),
    ("packing", packing_stage),
]

# SQL cannot state most of the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
