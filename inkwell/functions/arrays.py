"""Token lists, fixed-length id lists and dense vectors: column in, column out."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once.

    A lambda would otherwise work out the expression anew for each element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def token_ngrams(tokens: Column, low: int, high: int) -> Column:
    """All contiguous n-grams for n from ``low`` to ``high``, tokens joined by a blank."""

    def of_list(words: Column) -> Column:
        sizes = F.filter(F.sequence(F.lit(low), F.lit(high)), lambda n: n <= F.size(words))
        starts = lambda n: F.sequence(F.lit(1), F.size(words) - n + 1)
        gram = lambda p, n: F.array_join(F.slice(words, p, n), " ")
        return F.flatten(F.transform(sizes, lambda n: F.transform(starts(n), lambda p: gram(p, n))))

    return bind(tokens, of_list)


def pad_ids(ids: Column, length: int, pad: int) -> Column:
    """The first ``length`` ids, padded at the end."""
    return F.slice(F.concat(ids, F.array_repeat(F.lit(pad), length)), 1, length)


def pad_to_longest(ids: Column, batch: Column, pad: int) -> Column:
    """Ids padded at the end to the longest list of their batch; a batch is a bounded number of rows."""
    longest = F.max(F.size(ids)).over(Window.partitionBy(batch))
    return F.concat(ids, F.array_repeat(F.lit(pad), longest - F.size(ids)))


def attention_mask(ids: Column, length: int) -> Column:
    """1 for each kept id and 0 for each pad position."""
    kept = F.least(F.size(ids), F.lit(length))
    return F.concat(F.array_repeat(F.lit(1), kept), F.array_repeat(F.lit(0), length - kept))


def frame_ids(ids: Column, first: int, last: int, length: int) -> Column:
    """Put an opening and a closing id around the ids so that all fit in ``length``."""
    return F.concat(F.array(F.lit(first)), F.slice(ids, 1, length - 2), F.array(F.lit(last)))


def last_token_index(ids: Column, pad: int) -> Column:
    """0-based place of the last id before the first pad.

    Without a pad it is the last place. A list that opens with a pad gives the last place
    too, as an index of -1 counts from the end.
    """
    first_pad = F.array_position(ids, F.lit(pad)).cast("int")
    return F.when(first_pad <= 1, F.size(ids) - 1).otherwise(first_pad - 2)


def last_token_pool(vectors: Column, ids: Column, pad: int) -> Column:
    return F.element_at(vectors, last_token_index(ids, pad) + 1)


def masked_mean_pool(vectors: Column, mask: Column) -> Column:
    """Mean of the token vectors where ``mask`` is 1; the divisor is at least 1e-9."""
    kept = F.filter(F.arrays_zip(vectors.alias("v"), mask.alias("m")), lambda x: x["m"] == 1)
    kept = F.transform(kept, lambda x: F.transform(x["v"], lambda y: y.cast("double")))
    width = F.size(F.element_at(vectors, 1))
    total = F.aggregate(
        kept, F.array_repeat(F.lit(0.0), width), lambda acc, v: F.zip_with(acc, v, lambda x, y: x + y)
    )
    weight = F.greatest(F.aggregate(mask, F.lit(0.0), lambda acc, m: acc + m), F.lit(1e-9))
    return bind(weight, lambda w: F.transform(total, lambda x: x / w))


def dot(left: Column, right: Column) -> Column:
    return F.aggregate(
        F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x
    )


def linear_head(vector: Column, weights: Column, bias: float = 0.0) -> Column:
    return dot(vector, weights) + F.lit(float(bias))


def argmax_class(scores: Column) -> Column:
    """0-based place of the highest score, the first one on a tie."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def log_sum_exp(logits: Column) -> Column:
    total = lambda top: F.aggregate(logits, F.lit(0.0), lambda acc, x: acc + F.exp(x - top))
    return bind(F.array_max(logits), lambda top: top + F.log(total(top)))


def softmax(logits: Column) -> Column:
    return bind(log_sum_exp(logits), lambda base: F.transform(logits, lambda x: F.exp(x - base)))


def softmax_prob(logits: Column, class_index: int = 1) -> Column:
    return F.exp(F.element_at(logits, class_index + 1) - log_sum_exp(logits))


def subword_decode(tokens: Column) -> Column:
    """Join word pieces to text: a piece that opens with ``##`` continues the word."""
    return F.replace(F.array_join(tokens, " "), F.lit(" ##"), F.lit(""))
