"""The corpus pipeline: toxicity, quality, near-duplicates, repeated substrings, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.llm import near_dedup, packing, quality, substring_dedup, toxicity
from inkwell.llm.common import table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold."""
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model).where("predicted = 0").select(*docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifiers accept."""
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model).where("predicted = 1").select(*docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dedup.drop_near_copies(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of repeated 35-word windows; one that loses all its words stays with an empty text."""
    cut = substring_dedup.remove_repeats(docs, tidy=True)
    changed = F.col("n_removed") > 0
    cut = cut.withColumn("text", F.when(changed, F.col("kept")).otherwise(F.col("text")))
    cut = cut.withColumn("n_chars", F.when(changed, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return cut.select(*docs.columns)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the texts, packed into sequences of at most 1024."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage),
    ("quality classifier", quality_stage),
    ("MinHash near-dedup", near_stage),
    ("substring dedup", substring_stage),
    ("best-fit packing", pack_stage),
]

#: A trained classifier and a tokenizer decide the rows, which SQL cannot state.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
