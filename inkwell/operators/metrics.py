"""Classification metrics and training reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.functions.numeric import bce
from inkwell.operators.order import range_index, running_totals
from inkwell.operators.relational import map_values
from inkwell.operators.sampling import fixed_batches


def confusion_matrix(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """One row ``tn, fp, fn, tp``."""

    def cell(y: int, p: int) -> Column:
        return F.count_if((F.col(label) == y) & (F.col(predicted) == p))

    return df.agg(cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp"))


def f1_score(df: DataFrame, label: str, predicted: str) -> DataFrame:
    wrong = (F.col("fn") + F.col("fp")) / 2
    return confusion_matrix(df, label, predicted).select((F.col("tp") / (F.col("tp") + wrong)).alias("f1"))


def accuracy(df: DataFrame, label: str, predicted: str) -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(predicted)).cast("double")).alias("accuracy"))


def roc_auc(df: DataFrame, label: str, score: str, group: tuple[str, ...] = ()) -> DataFrame:
    """Exact area under the ROC curve, ties counted half; null unless both classes occur.

    Rows are counted per distinct score; each positive then wins against the negatives with
    a lower score and half of those with an equal one.
    """
    per_score = df.groupBy(*group, score).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg")
    )
    ranked = running_totals(per_score, [score], {"_neg_up_to": "_neg"}, group)
    wins = F.sum(F.col("_pos") * (F.col("_neg_up_to") - F.col("_neg") / 2))
    pairs = F.sum("_pos").cast("double") * F.sum("_neg")
    area = F.when(pairs > 0, wins / pairs).alias("auc")
    return ranked.groupBy(*group).agg(area) if group else ranked.agg(area)


def auc_thresholded(df: DataFrame, label: str, score: str, thresholds: int = 200) -> DataFrame:
    """Area under the ROC curve drawn through evenly spaced thresholds.

    The thresholds are one just below 0, ``i / (thresholds - 1)`` in between, and one just
    above 1; a row is positive above a threshold. The curve has one point per threshold, so
    the window runs over that many rows.
    """
    steps = thresholds - 1
    # a score counts as above threshold i for all i below its bucket
    bucket = F.ceil(F.col(score) * steps)
    bucket = F.greatest(F.lit(1), F.least(bucket, F.lit(steps)))
    per_bucket = df.groupBy(bucket.alias("_bucket")).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg")
    )
    falling = Window.orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, 0)
    curve = per_bucket.select(
        "_pos", "_neg", F.sum("_pos").over(falling).alias("_tp"), F.sum("_neg").over(falling).alias("_fp")
    )
    # trapezoid under each step from the previous point (fp - neg, tp - pos) to (fp, tp)
    area = F.sum(F.col("_neg") * (F.col("_tp") - F.col("_pos") / 2))
    pairs = F.sum("_pos").cast("double") * F.sum("_neg")
    return curve.agg(F.when(pairs > 0, area / pairs).alias("auc"))


def mean_bce(df: DataFrame, label: str, prob: str, smoothing: float = 0.0) -> DataFrame:
    return df.agg(F.avg(bce(F.col(label), F.col(prob), smoothing)).alias("loss"))


def validation_report(df: DataFrame, label: str, prob: str, batch_size: int, key: str = "id") -> DataFrame:
    """``n, loss, auc`` of one fold; loss and area leave out an incomplete last batch."""
    full = fixed_batches(df, [key], batch_size, drop_remainder=True)
    total = df.agg(F.count("*").alias("n"))
    return total.select(
        "n", mean_bce(full, label, prob).scalar().alias("loss"), roc_auc(full, label, prob).scalar().alias("auc")
    )


def best_epoch(df: DataFrame, group: str, epoch: str, metric: str, *carry: str) -> DataFrame:
    """The row of each group with the highest metric, the earliest epoch on a tie."""
    best = F.max_by(F.struct(epoch, metric, *carry), F.struct(F.col(metric), -F.col(epoch)))
    return df.groupBy(group).agg(best.alias("_best")).select(group, "_best.*")


def ensemble_mean(df: DataFrame, key: str = "id", score: str = "score") -> DataFrame:
    """Mean score per id over rows ``(id, model, score)``."""
    return df.groupBy(key).agg(F.avg(score).alias("score"))


def soft_vote(df: DataFrame, weights: dict[str, float], key: str = "id") -> DataFrame:
    """Weighted mean of model probabilities over rows ``(id, model, score)``."""
    weight = map_values("model", weights)
    return df.groupBy(key).agg((F.sum(weight * F.col("score")) / F.sum(weight)).alias("score"))


def running_metrics(df: DataFrame, epoch: str, step: str, loss: str) -> DataFrame:
    """Per step: its loss and the mean loss of the epoch so far."""
    ones = df.withColumn("_one", F.lit(1))
    ran = running_totals(ones, [step], {"_loss_sum": loss, "_steps": "_one"}, (epoch,))
    return ran.select(
        epoch, step, F.col(loss).alias("step_loss"), (F.col("_loss_sum") / F.col("_steps")).alias("mean_loss")
    )


def running_auc(df: DataFrame, epoch: str, step: str, label: str, score: str) -> DataFrame:
    """Per step: the exact area under the ROC curve of all rows of the epoch so far.

    Step ``i`` adds the pairs its row forms with earlier rows of the other class. Counting
    earlier rows with a lower or equal score is done level by level: at level ``l`` the rows
    are cut into blocks of ``2**l`` places, and rows in the right half of a pair of blocks
    count those in the left half. Every two rows meet in exactly one pair of blocks, so the
    work is rows times levels, and running totals spread large blocks over partitions.
    """
    ones = df.select(epoch, step, label, score).withColumn("_one", F.lit(1))
    placed = running_totals(
        ones.withColumn("_is_pos", (F.col(label) == 1).cast("int")), [step], {"_nth": "_one", "_pos_up_to": "_is_pos"}, (epoch,)
    ).withColumn("_place", F.col("_nth") - 1)
    ranked = range_index(placed, [epoch, score, step], "_score_place")
    longest = ranked.agg(F.max("_place")).first()[0] or 0
    levels = max(1, int(longest).bit_length())
    spread = ranked.withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(levels - 1))))
    spread = spread.withColumn("_half", F.expr("shiftright(_place, _level) % 2")).withColumn("_pair", F.expr("shiftright(_place, _level + 1)"))
    left = F.col("_half") == 0
    tied = [epoch, "_level", "_pair", score]
    # rows of the left half with a score at or below, and exactly at, the score of the row
    per_score = spread.groupBy(*tied).agg(
        F.count_if(left & (F.col(label) == 1)).alias("_left_pos"), F.count_if(left & (F.col(label) == 0)).alias("_left_neg")
    )
    run = running_totals(
        per_score, [score], {"_pos_to": "_left_pos", "_neg_to": "_left_neg"}, (epoch, "_level", "_pair")
    )
    right = spread.where(~left).join(run, tied)
    below_neg = F.col("_neg_to") - F.col("_left_neg") / 2
    below_pos = F.col("_pos_to") - F.col("_left_pos") / 2
    per_row = right.groupBy(epoch, step).agg(
        F.sum(F.when(F.col(label) == 1, below_neg)).alias("_beats"), F.sum(F.when(F.col(label) == 0, below_pos)).alias("_loses")
    )
    joined = placed.join(per_row, [epoch, step], "left")
    pos_before = F.col("_pos_up_to") - F.col("_is_pos")
    gained = F.when(F.col(label) == 1, F.coalesce("_beats", F.lit(0.0))).otherwise(
        pos_before - F.coalesce("_loses", F.lit(0.0))
    )
    summed = running_totals(joined.withColumn("_gained", gained), [step], {"_wins": "_gained"}, (epoch,))
    pairs = F.col("_pos_up_to") * (F.col("_nth") - F.col("_pos_up_to"))
    return summed.select(epoch, step, F.when(pairs > 0, F.col("_wins") / pairs).alias("auc_so_far"))
