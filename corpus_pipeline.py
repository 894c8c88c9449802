"""Corpus pipeline: quality rules, near-duplicates, shared passages, benchmark overlap, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage
before it kept; ``run`` applies them to ``documents`` and stores every result
in the shared folder before the next stage reads it.  All stages but the last
return the columns of ``documents``.

A table without rows gives a result without rows.  Null texts fail the quality
rules and go.  Documents whose bytes all repeat earlier ones stay, with an
empty text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isograd.llm import decontaminate, minhash, packing, quality, suffix
from isograd.llm.queries import table, tokenizer_path
from isograd.llm.storage import free_names, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the repetition rules."""
    return quality.quality(docs, only_kept=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, the one of least id."""
    return minhash.one_of_each(docs)


def shared_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the characters of passages that occurred before; ``n_chars`` is counted anew."""
    (dedup,) = free_names(docs.columns, "__dedup")
    found = suffix.dedup_substrings(docs, into=dedup, characters=True)
    text = F.when(F.col("text").isNotNull(), F.col(f"{dedup}.kept").cast("string"))
    changed = F.col(f"{dedup}.n_removed") > 0
    return found.withColumns(
        {"text": F.when(changed, text).otherwise(F.col("text")), "n_chars": F.when(changed, F.length(text)).otherwise(F.col("n_chars"))}
    ).select(*docs.columns)


def benchmark_overlap(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), only_clean=True)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    found = packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))
    return found.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("shared_passages", shared_passages),
    ("benchmark_overlap", benchmark_overlap),
    ("packing", packed),
]

#: Packing depends on a tokenizer, which SQL cannot express; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
