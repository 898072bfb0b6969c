"""Registered queries run the learners at their whole settings."""

import inspect

from inkwell.checks import learners as checks
from inkwell.operators import learners as ln
from inkwell.plans.rank_ensemble import vote
from inkwell.plans.self_training import self_training


def test_trees_run_whole(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(checks, "scored_targets", lambda spark, folder, score, **settings: asked.append((score, settings["settings"])))
    checks.gbt_a(spark, "")
    checks.gbt_b(spark, "")
    assert asked == [(ln.gbt_score, ln.TREES_A), (ln.gbt_score, ln.TREES_B)]
    assert (ln.TREES_A.rounds, ln.TREES_A.depth, ln.TREES_A.leaves, ln.TREES_A.bins, ln.TREES_A.least) == (2500, 23, 31, 898, 115)
    assert (ln.TREES_B.rounds, ln.TREES_B.depth, ln.TREES_B.symmetric) == (2000, 6, True)


def test_self_training_runs_whole(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(checks, "corpora", lambda spark, folder: None)
    monkeypatch.setattr(checks, "encoder_scores", lambda spark, folder: None)
    monkeypatch.setattr(checks, "self_training", lambda *tables, **settings: asked.append(settings) or (spark.createDataFrame([(1, 0.5)], "id int, score double"), None))
    checks.self_training_loop(spark, "")
    defaults = inspect.signature(self_training).parameters
    assert asked == [{}] and [defaults[k].default for k in ("rounds", "top", "bottom", "growth", "vocab_size", "tol")] == [4, 1000, 1500, 250, 5000, 1e-4]


def test_the_ensemble_runs_whole(spark, monkeypatch):
    asked = []
    goal = spark.createDataFrame([(1, "a")], "id int, text string")
    monkeypatch.setattr(checks, "targets", lambda spark, folder: goal)
    monkeypatch.setattr(checks, "training_rows", lambda spark, folder: goal)
    monkeypatch.setattr(checks, "ranked", lambda *tables, **settings: asked.append(settings) or goal.selectExpr("id", "0.5 AS generated"))
    checks.rank_ensemble(spark, "")
    defaults = inspect.signature(vote).parameters
    assert asked == [{}] and [defaults[k].default for k in ("vocab_size", "gbt_a", "gbt_b")] == [30_522, ln.TREES_A, ln.TREES_B]
