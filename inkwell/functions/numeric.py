"""Score arithmetic and per-row losses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkwell.functions.arrays import log_sum_exp


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def threshold_label(score: Column, limit: float = 0.5) -> Column:
    return (score > limit).cast("int")


def affine_blend(*weighted: tuple[float, Column]) -> Column:
    """Sum of weight times score."""
    total = None
    for weight, score in weighted:
        term = F.lit(float(weight)) * score
        total = term if total is None else total + term
    return total


def bce(label: Column, prob: Column, smoothing: float = 0.0, eps: float = 1e-7) -> Column:
    """Binary cross entropy of one row; ``prob`` is kept within ``eps`` of 0 and 1."""
    y = label * (1 - smoothing) + smoothing / 2
    p = F.greatest(F.least(prob, F.lit(1 - eps)), F.lit(eps))
    return -(y * F.log(p) + (1 - y) * F.log(1 - p))


def bce_with_logits(label: Column, logit: Column) -> Column:
    """Binary cross entropy from a logit, stable for large values."""
    return F.greatest(logit, F.lit(0.0)) - logit * label + F.log1p(F.exp(-F.abs(logit)))


def cross_entropy(logits: Column, label: Column, smoothing: float = 0.0) -> Column:
    """Cross entropy of one row of class logits, with label smoothing over all classes."""
    base = log_sum_exp(logits)
    hit = base - F.element_at(logits, label + 1)
    spread = base - F.aggregate(logits, F.lit(0.0), lambda acc, x: acc + x) / F.size(logits)
    return (1 - smoothing) * hit + smoothing * spread


def multitask_loss(main: Column, aux: Column, aux_weight: float = 0.4) -> Column:
    return main * (1 - aux_weight) + aux * aux_weight
