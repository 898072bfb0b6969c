"""Where the rows of word weights lie: texts move once, and folds find their rows in place."""

from pyspark.sql import functions as F

from inkwell.functions.text import lower_words
from inkwell.operators import features as fx
from inkwell.operators import learners as ln


def texts(spark):
    rows = [(i, f"word{i % 5} other{i % 3} word{i % 5} same", i % 2, i % 3) for i in range(30)]
    return spark.createDataFrame([*rows, (0, "word0 same again", 0, 0)], "id bigint, text string, label int, fold int")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("\n")


def test_word_counts_move_texts_and_no_tokens(spark, monkeypatch):
    plans, cut = [], fx.cut
    monkeypatch.setattr(fx, "cut", lambda df: plans.append(plan(df)) or cut(df))
    weights, _ = fx.tfidf_words(texts(spark), lower_words(F.col("text")))
    moved = [i for i, line in enumerate(plans[0]) if "Exchange" in line]
    made = next(i for i, line in enumerate(plans[0]) if "Generate" in line)
    assert len(moved) == 1 and moved[0] > made
    # a repeated id counts as one text
    assert weights.where("id = 0").count() == 4
    norms = weights.groupBy("id").agg(F.sum(F.col("weight") * F.col("weight")).alias("n")).collect()
    assert len(norms) == 30 and all(abs(r["n"] - 1) < 1e-12 for r in norms)


def test_folds_find_their_rows_where_they_lie(spark):
    table = texts(spark).dropDuplicates(["id"])
    counts = fx.term_counts(table.select("id", F.explode(lower_words(F.col("text"))).alias("term")))
    plans = []

    def weigh(near, n, held):
        idf = fx.cut(fx.idf_table(near, n))
        sides = fx.weigh(near, idf, False), fx.weigh(held, idf, False)
        plans.extend(plan(side) for side in sides)
        return sides

    found = ln.cv_fit_by_fold(table.select("id", "label", "fold"), counts, weigh, ln.naive_bayes_score, range(3))
    assert found.count() == 30 and found.where("score IS NULL").count() == 0
    for lines in plans:
        window = next(i for i, line in enumerate(lines) if "Window" in line)
        scan = next(i for i, line in enumerate(lines) if "Scan" in line and i > window)
        assert not [line for line in lines[window:scan] if "Exchange" in line]
    assert not spark.sparkContext._jsc.getPersistentRDDs()
