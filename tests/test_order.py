"""Indexes, ranks, totals, folds and metrics on small made cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkwell.operators import metrics, order, pseudo, relational, sampling


def rows(spark, n, groups=3):
    """One group holds a third of all rows or more."""
    return spark.range(n).select(
        F.col("id"), F.when(F.col("id") % 3 < 2, "big").otherwise(F.concat(F.lit("g"), (F.col("id") % groups).cast("string"))).alias("g"),
        (F.col("id") * 7 % 13).cast("double").alias("v"),
    )


@pytest.mark.parametrize("partitions", [1, 4, 50])
def test_range_index_does_not_depend_on_partitions(spark, partitions):
    df = rows(spark, 200).repartition(partitions)
    got = {r.id: r.row_index for r in order.range_index(df, ["v", "id"]).collect()}
    want = sorted((r.v, r.id) for r in df.collect())
    assert got == {key: i for i, (_, key) in enumerate(want)}


@pytest.mark.parametrize("partitions", [1, 7])
def test_running_totals_over_a_large_group(spark, partitions):
    df = rows(spark, 300).repartition(partitions)
    got = {r.id: r.total for r in order.running_totals(df, ["id"], {"total": "v"}, ("g",)).collect()}
    sums, want = {}, {}
    for r in sorted(df.collect(), key=lambda r: r.id):
        sums[r.g] = sums.get(r.g, 0) + r.v
        want[r.id] = sums[r.g]
    assert got == want


def test_hash_rank_is_a_permutation_in_each_group(spark):
    ranked = order.hash_rank(rows(spark, 300), 1, group=["g"]).groupBy("g").agg(
        F.sort_array(F.collect_list("row_index")).alias("all")
    )
    for r in ranked.collect():
        assert r["all"] == list(range(len(r["all"])))


def test_median_of_even_and_odd_counts(spark):
    for n in (9, 10):
        values = [float((i * 7) % 5) for i in range(n)]
        df = spark.createDataFrame([(v,) for v in values], "v double")
        assert order.median_exact(df, "v") == np.median(values)
    assert order.median_exact(spark.createDataFrame([], "v double"), "v") is None


def test_folds_are_even_over_all_and_in_each_stratum(spark):
    folds = sampling.stratified_kfold(rows(spark, 203), "g", 5, 3)
    sizes = [r["count"] for r in folds.groupBy("fold").count().collect()]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == 203
    for g in ("big", "g2"):
        inside = [r["count"] for r in folds.where(F.col("g") == g).groupBy("fold").count().collect()]
        assert max(inside) - min(inside) <= 1


def test_sample_has_the_asked_size_and_never_more_than_all(spark):
    assert sampling.sample_n(rows(spark, 50), 20, 5).count() == 20
    assert sampling.sample_n(rows(spark, 50), 80, 5).count() == 50


def test_top_k_per_group_with_few_slices(spark):
    got = order.top_k_per_group(rows(spark, 100), ["g"], [F.desc("v"), "id"], 4, "id", salts=3)
    for g in ("big", "g2"):
        want = sorted(((-r.v, r.id) for r in rows(spark, 100).where(F.col("g") == g).collect()))[:4]
        assert [(-r.v, r.id) for r in got.where(F.col("g") == g).orderBy("rank").collect()] == want


def test_dedup_keeps_the_first_row_and_one_null(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, None), (4, None), (5, "")], "id int, text string")
    once = relational.dedup_key_first(df, "text", "id")
    assert sorted(r.id for r in once.collect()) == [1, 2, 5]
    assert sorted(map(tuple, relational.dedup_key_first(once, "text", "id").collect()), key=str) == sorted(map(tuple, once.collect()), key=str)


def test_update_join_ignores_null_updates(spark):
    a = spark.createDataFrame([(1, 0.1, "x"), (2, 0.2, "y")], "id int, label double, keep string")
    b = spark.createDataFrame([(1, 0.9), (2, None), (3, 0.5)], "id int, label double")
    assert sorted(map(tuple, relational.update_join(a, b).collect())) == [(1, 0.9, "x"), (2, 0.2, "y")]


def test_scores_must_match_one_to_one(spark):
    a = spark.createDataFrame([(1,), (2,)], "id int")
    relational.assert_one_to_one(a, a)
    with pytest.raises(ValueError):
        relational.assert_one_to_one(a, spark.createDataFrame([(1,), (1,)], "id int"))


def test_area_is_null_with_one_class_and_half_for_ties(spark):
    one = spark.createDataFrame([(1, 0.5), (1, 0.7)], "label int, score double")
    assert metrics.roc_auc(one, "label", "score").first()[0] is None
    tied = spark.createDataFrame([(1, 0.5), (0, 0.5)], "label int, score double")
    assert metrics.roc_auc(tied, "label", "score").first()[0] == 0.5


def test_overlapping_top_and_bottom_keep_both_copies(spark):
    labelled = pseudo.top_bottom(rows(spark, 10), "v", 7, 7)
    assert labelled.count() == 14


def test_small_tables_are_labelled_whole(spark):
    assert pseudo.per_class_top_bottom(rows(spark, 10), "g", "v", 2, 2, whole_up_to=10).where("label = 1").count() == 10


def test_rows_without_an_id_are_ranked_too(spark):
    table = spark.createDataFrame([(1,), (None,), (3,), (None,)], "id long")
    assert sorted(r["row_index"] for r in order.hash_rank(table, 1).collect()) == [0, 1, 2, 3]
