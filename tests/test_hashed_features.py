"""Hashed features of tree learners."""

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from inkwell.operators import learners as ln


def test_rows_of_features_equal_plain_sums(spark, monkeypatch):
    monkeypatch.setattr(ln, "FEATURE_ROWS", 3)
    rows = [(i, f"t{j}", (i + 1) / (j + 1)) for i in range(20) for j in range(i)]
    weights = spark.createDataFrame(rows, "id bigint, term string, weight double")
    found = ln.hashed_features(weights, spark.range(25), 8).select("id", vector_to_array("features").alias("v")).collect()
    slot = {r["term"]: r["s"] for r in weights.select("term", F.pmod(F.xxhash64("term"), F.lit(8)).alias("s")).distinct().collect()}
    assert len(found) == 25
    for row in found:
        wanted = np.zeros(8)
        for i, term, weight in rows:
            wanted[slot[term]] += weight if i == row["id"] else 0.0
        assert np.allclose(row["v"], wanted)


def test_a_large_batch_is_filled_in_parts(spark, monkeypatch):
    """The step that fills rows hands on parts of a batch, whatever the batch's size."""
    step, given = [], type(spark.range(1)).mapInArrow
    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", lambda df, f, schema: step.append(f) or given(df, f, schema))
    ln.hashed_features(spark.createDataFrame([(0, "a", 1.0)], "id bigint, term string, weight double"), spark.range(1), 4)
    n = 5_000
    lists = lambda kind: pa.array([[1, 2]] * n, pa.list_(kind))
    batch = pa.RecordBatch.from_arrays([pa.array(range(n)), lists(pa.int32()), lists(pa.float64())], ["id", "_slots", "_values"])
    sizes = [part.num_rows for part in step[0](iter([batch]))]
    assert sum(sizes) == n and max(sizes) <= ln.FEATURE_ROWS
