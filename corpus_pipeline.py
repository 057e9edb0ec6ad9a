"""Corpus pipeline: quality rules, toxicity, near duplicates, substring dedup, packing.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before kept and returns
its own rows, with the columns of ``documents`` but for the last, which returns packed pieces.
Null, empty and repeated rows are handled as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strataforge.llm import ngram_join, packing, quality_rules, substring_dedup, toxicity
from strataforge.llm.shared import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or the threshold table go."""
    return quality_rules.keep_good(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is 0.5 or more go; the lexicon is learned from the training labels."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of five-word-shingle similarity of 0.75 or more stays, that with the smallest id."""
    return ngram_join.keep_one(docs, 75, 5)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in windows of 35 that occur elsewhere too are cut out; no document goes."""
    return substring_dedup.remove_repeats(docs, 35)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 ids."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), 1024, 0)


STAGES = [("quality_rules", quality), ("toxicity", clean), ("near_duplicates", near_duplicates), ("substring_dedup", repeated_passages), ("packing", packed)]

#: Learned scores and tokens are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
