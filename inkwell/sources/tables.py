"""The essay tables as views over the parquet tables of a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def essays(spark: SparkSession, folder: str) -> DataFrame:
    """``id, text, source, prompt_name, n_chars, generated``; unlabelled rows have a null label."""
    documents = table(spark, folder, "documents")
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    return documents.join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("id"),
        "text",
        "source",
        F.col("lang").alias("prompt_name"),
        "n_chars",
        (1 - F.col("quality")).alias("generated"),
    )


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """``id, text, source, prompt_name, n_chars`` without the label join."""
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), "text", "source", F.col("lang").alias("prompt_name"), "n_chars"
    )


def targets(spark: SparkSession, folder: str) -> DataFrame:
    """The texts to score: ``id, text``."""
    return table(spark, folder, "benchmark").select(F.col("item_id").alias("id"), "text")


def graded_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Two graded score vectors per document, with ties: ``id, score_a, score_b``."""
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"),
        ((F.col("n_chars") * 37) % 1001 / F.lit(1000.0)).alias("score_a"),
        ((F.col("doc_id") * 7919) % 997 / F.lit(996.0)).alias("score_b"),
    )


def labelled_scores(spark: SparkSession, folder: str) -> DataFrame:
    """``id, label, score`` of the labelled documents."""
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("id"), (1 - F.col("quality")).alias("label"))
    return labels.join(graded_scores(spark, folder), "id").select("id", "label", F.col("score_a").alias("score"))
