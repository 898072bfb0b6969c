"""Writers for submissions and their fallback."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.sources.schemas import require_columns


def write_submission(df: DataFrame, path: str) -> None:
    """Write ``id, generated`` as headed CSV part files."""
    require_columns(df, "id", "generated").select("id", "generated").write.mode("overwrite").csv(path, header=True)


def constant_fallback(scores: DataFrame, ids: DataFrame, value: float, min_rows: int) -> DataFrame:
    """``scores`` if the test table has at least ``min_rows`` rows, else ``value`` for every id.

    The size test is a scalar subquery, so both branches stay in one lazy plan.
    """
    enough = ids.agg(F.count("*") >= min_rows).scalar()
    filled = ids.select("id", F.lit(float(value)).alias("generated")).where(~enough)
    return scores.select("id", F.col("generated").cast("double").alias("generated")).where(enough).unionByName(filled)
