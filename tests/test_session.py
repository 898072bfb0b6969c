"""The scope that owns kept and written tables."""

import os

from pyspark.sql import functions as F

from inkwell.plans.scored_run import Stages
from inkwell.session import Scope, checkpoint_dir


def test_scope_computes_once_and_leaves_nothing(spark):
    folder = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            runs.add(len(batch))
            yield batch

    with Scope(spark) as scope:
        kept = scope.keep(spark.range(100).mapInPandas(count, "id bigint"))
        assert kept.count() == 100 and kept.agg(F.sum("id")).first()[0] == 4950
        assert runs.value == 100
        written = scope.write(kept, "numbers")
        assert written.count() == 100 and runs.value == 100
        assert set(os.listdir(folder)) - before
    assert set(os.listdir(folder)) == before and not kept.is_cached


def test_stages_go_on_where_a_run_stopped(spark, tmp_path):
    built = []

    def run(fail, rows=3, factor=2):
        stages = Stages(spark, str(tmp_path))
        source = stages.given("source", spark.range(rows))

        def first():
            built.append("first")
            return source.withColumn("a", F.col("id") * factor)

        def second():
            built.append("second")
            if fail:
                raise RuntimeError("lost")
            return kept.withColumn("b", F.col("a") + 1)

        kept = stages.keep("first", ["source"], {"factor": factor}, first)
        return stages.keep("second", ["first"], {}, second)

    try:
        run(True)
    except RuntimeError:
        pass
    assert sorted(r["b"] for r in run(False).collect()) == [1, 3, 5] and built == ["first", "second", "second"]
    run(False)
    assert built == ["first", "second", "second"]  # all is there
    run(False, factor=3)
    assert built[3:] == ["first", "second"]  # other settings
    run(False, rows=4)
    assert built[5:] == ["first", "second"]  # other input
