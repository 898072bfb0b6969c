"""Which training texts are nearest to each target text?"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions.text import words
from inkwell.operators.features import tfidf_pair, topk_cosine_join
from inkwell.operators.relational import dedup_key_first, first_orders
from inkwell.session import spread
from inkwell.sources import tables


def nearest_documents(spark: SparkSession, folder: str, k: int = 3, low: int = 3, high: int = 3) -> DataFrame:
    """``query_id, id, sim, rank`` of the ``k`` nearest distinct documents per target."""
    texts = spread(tables.documents(spark, folder).select("id", "text"))
    docs = dedup_key_first(texts, "text", "id")
    targets = spread(tables.targets(spark, folder))
    doc_weights, target_weights = tfidf_pair(docs, targets, words(F.col("text")), low, high, split=str.split)
    nearest = topk_cosine_join(targets, target_weights, doc_weights, first_orders(texts, "text", "id"), k)
    return nearest.select("query_id", "id", F.round("sim", 6).alias("sim"), "rank")
