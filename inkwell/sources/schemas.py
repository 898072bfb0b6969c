"""Column types of the essay tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

TRAIN_ESSAYS = "id STRING, prompt_id INT, text STRING, generated INT"
TEST_ESSAYS = "id STRING, prompt_id INT, text STRING"
TRAIN_PROMPTS = "prompt_id INT, prompt_name STRING, instructions STRING, source_text STRING"
SUBMISSION = "id STRING, generated DOUBLE"
CORPUS = "text STRING, label INT, prompt_name STRING, source STRING"
ARGUMENT_CORPUS = "id STRING, text STRING, model STRING"


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """Return ``df`` unchanged, or fail at once if a column is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; present are {df.columns}")
    return df


def struct_type(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)
