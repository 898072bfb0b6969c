"""Learners over long-form weights ``(id, term, weight)`` and labels ``(id, label)``.

Ridge, naive Bayes, the margin learner and the topic model keep coefficients as tables of terms,
never as a vector on the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkwell.functions.numeric import sigmoid
from inkwell.functions.text import lower_words
from inkwell.operators.blocks import TextTermBlocks, build_blocks, unpack_columns, unpack_terms
from inkwell.operators.features import idf_table, term_counts, weigh
from inkwell.operators.linear import minimize, modified_huber, ridge_solve, softmax
from inkwell.operators.trees import TreeSettings, fit_trees, score_trees
from inkwell.session import Scope, broadcast_if_small, cut, hold

# Settings of the two boosted-tree learners, under Spark ML's names.
GBT_A = {"maxIter": 2500, "stepSize": 0.00581909898961407, "maxDepth": 23, "minInstancesPerNode": 115,
         "featureSubsetStrategy": "0.78", "maxBins": 898}
GBT_B = {"maxIter": 2000, "stepSize": 0.005599066836106983, "subsamplingRate": 0.4, "maxDepth": 6}
# The same settings whole, for trees by histograms.
TREES_A = TreeSettings(rounds=2500, rate=0.00581909898961407, depth=23, leaves=31, bins=898, least=115, l1=4.562963348932286, l2=2.97485,
                     tree_columns=0.78, node_columns=0.8)
TREES_B = TreeSettings(rounds=2000, rate=0.005599066836106983, depth=6, bins=254, l2=6.6591278779517808, rows=0.4, symmetric=True)
# Weights of the four learners in the vote.
VOTE_WEIGHTS = {"mnb": 0.068, "sgd": 0.31, "gbt_a": 0.31, "gbt_b": 0.312}
FEATURE_ROWS = 1_024


@dataclass(frozen=True)
class TermModel:
    """A linear model: ``term, coef`` and an intercept."""

    coefficients: DataFrame
    intercept: float

    def save(self, path: str) -> None:
        """Write the coefficients, and the intercept under the null term, as Parquet."""
        spark = self.coefficients.sparkSession
        intercept = spark.createDataFrame([(None, self.intercept)], "term string, coef double")
        self.coefficients.select("term", "coef").union(intercept).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TermModel:
        rows = spark.read.parquet(path)
        return cls(rows.where("term IS NOT NULL"), rows.where("term IS NULL").select("coef").scalar())

    def decision(self, weights: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
        """``id, decision`` for every id; a text without known terms gets the intercept."""
        coefficients = broadcast_if_small(self.coefficients)
        summed = weights.join(coefficients, "term").groupBy(key).agg(F.sum(F.col("weight") * F.col("coef")).alias("_sum"))
        total = F.coalesce("_sum", F.lit(0.0)) + F.lit(self.intercept)
        return ids.select(key).join(summed, key, "left").select(key, total.alias("decision"))


def _linear_inputs(weights: DataFrame, labels: DataFrame, key: str, blocks: TextTermBlocks | None) -> tuple[DataFrame, TextTermBlocks]:
    known = cut(labels.select(key, F.col("label").cast("double").alias("label")))
    return known, blocks or build_blocks(cut(weights.select(key, "term", "weight")), known.select(key), key)


def ridge_fit(
    weights: DataFrame, labels: DataFrame, alpha: float = 1.0, tol: float = 1e-4, max_iter: int = 10_000, key: str = "id",
    start: TermModel | None = None, blocks: TextTermBlocks | None = None, one_task: bool = False,
) -> TermModel:
    """Ridge regression with a free intercept, by conjugate gradients over blocks of texts and terms.

    The weights are dealt to blocks once; a pass moves vectors only. ``start`` is a model of similar
    data, whose coefficients the passes begin from. ``blocks`` are those of the labelled texts, if at hand.
    With ``one_task`` blocks proved small are solved in one task.
    """
    known, held = _linear_inputs(weights, labels, key, blocks)
    try:
        state, intercept, names = ridge_solve(held, known, alpha, tol, max_iter, None if start is None else start.coefficients, one_task)
        coefficients = cut(unpack_terms(state, held.terms, names, ["w"]).withColumnRenamed("w", "coef"))
    finally:
        if blocks is None:
            held.release()
    return TermModel(coefficients, intercept)


def ridge_score(
    train: DataFrame, labels: DataFrame, target: DataFrame, ids: DataFrame, alpha: float = 1.0, tol: float = 1e-4, key: str = "id",
    one_task: bool = True,
) -> DataFrame:
    """``id, score``: the sigmoid of the ridge prediction."""
    model = ridge_fit(train, labels, alpha, tol, key=key, one_task=one_task)
    return model.decision(target, ids, key).select(key, sigmoid(F.col("decision")).alias("score"))


def naive_bayes_fit(
    train: DataFrame, labels: DataFrame, vocab: DataFrame | None = None, alpha: float = 0.02, key: str = "id"
) -> TermModel:
    """Log-odds of label 1 under multinomial naive Bayes.

    A vocabulary term that no training text holds counts 0, plus ``alpha`` like all others.
    """
    labelled = train.join(labels.select(key, "label"), key)
    sums = labelled.groupBy("term").agg(
        F.sum(F.when(F.col("label") == 0, F.col("weight")).otherwise(0.0)).alias("c0"),
        F.sum(F.when(F.col("label") == 1, F.col("weight")).otherwise(0.0)).alias("c1"),
    )
    if vocab is not None:
        sums = vocab.join(sums, "term", "left").na.fill(0.0, ["c0", "c1"])
    sums = cut(sums)
    size, t0, t1 = sums.agg(F.count("*"), F.sum("c0"), F.sum("c1")).first()
    n0, n1 = labels.agg(F.count_if(F.col("label") == 0), F.count_if(F.col("label") == 1)).first()
    log_odds = F.log((F.col("c1") + alpha) / (t1 + alpha * size)) - F.log((F.col("c0") + alpha) / (t0 + alpha * size))
    return TermModel(sums.select("term", log_odds.alias("coef")), float(np.log(n1) - np.log(n0)))


def naive_bayes_score(
    train: DataFrame, labels: DataFrame, target: DataFrame, ids: DataFrame, vocab: DataFrame | None = None,
    alpha: float = 0.02, key: str = "id",
) -> DataFrame:
    """``id, score``: probability of label 1 under multinomial naive Bayes."""
    model = naive_bayes_fit(train, labels, vocab, alpha, key)
    return model.decision(target, ids, key).select(key, sigmoid(F.col("decision")).alias("score"))


def modified_huber_fit(
    weights: DataFrame, labels: DataFrame, l2: float = 1e-4, max_iter: int = 8_000, tol: float = 1e-4, key: str = "id",
    start: TermModel | None = None, blocks: TextTermBlocks | None = None, one_task: bool = False,
) -> TermModel:
    """A linear margin model under the modified Huber loss, by quasi-Newton steps over blocks of texts and terms.

    Ends when the gradient of the mean loss is no longer than ``tol``, or when three passes in a row lower the
    loss by less than ``tol``; fails if that takes more than ``max_iter`` passes. Texts without any
    term pull at the intercept alone.
    """
    known, held = _linear_inputs(weights, labels, key, blocks)
    begin = None if start is None else (start.coefficients.withColumnRenamed("coef", "c0"), [start.intercept])
    try:
        state, bias, names = minimize(held, known, modified_huber, l2, tol, max_iter, start=begin, fall=tol, one_task=one_task)
        coefficients = cut(unpack_terms(state, held.terms, names, ["w"]).withColumnRenamed("w", "coef"))
    finally:
        if blocks is None:
            held.release()
    return TermModel(coefficients, float(bias[0]))


def modified_huber_score(
    train: DataFrame, labels: DataFrame, target: DataFrame, ids: DataFrame, key: str = "id", **settings
) -> DataFrame:
    """``id, score`` with score ``(clip(decision, -1, 1) + 1) / 2``."""
    decision = modified_huber_fit(train, labels, key=key, **{"one_task": True, **settings}).decision(target, ids, key)
    clipped = F.greatest(F.least(F.col("decision"), F.lit(1.0)), F.lit(-1.0))
    return decision.select(key, ((clipped + 1) / 2).alias("score"))


def hashed_features(weights: DataFrame, ids: DataFrame, size: int, key: str = "id") -> DataFrame:
    """``id, features``: a vector of ``size`` buckets per text, for tree learners.

    Every term counts: terms that share a bucket of the hash are added up. Rows are filled from flat arrays,
    ``FEATURE_ROWS`` at a time.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, FEATURE_ROWS):
                part = batch.slice(first, FEATURE_ROWS)
                slots, values = part.column("_slots"), part.column("_values")
                lengths = pc.fill_null(pc.list_value_length(slots), 0).to_numpy(zero_copy_only=False)
                rows = np.zeros((part.num_rows, size))
                rows[np.repeat(np.arange(part.num_rows), lengths), slots.flatten().to_numpy()] = values.flatten().to_numpy(zero_copy_only=False)
                offsets = pa.array(np.arange(0, rows.size + 1, size), pa.int32())
                yield pa.RecordBatch.from_arrays([part.column(key), pa.ListArray.from_arrays(offsets, pa.array(rows.ravel()))], [key, "_row"])

    bucket = F.pmod(F.xxhash64("term"), F.lit(size)).cast("int").alias("slot")
    summed = weights.groupBy(key, bucket).agg(F.sum("weight").alias("weight"))
    picked = summed.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("slot", "weight"))).alias("_w"))
    joined = ids.select(key).join(picked, key, "left").select(key, F.col("_w.slot").alias("_slots"), F.col("_w.weight").alias("_values"))
    schema = T.StructType([joined.schema[key], T.StructField("_row", T.ArrayType(T.DoubleType()))])
    return joined.mapInArrow(spread, schema).select(key, array_to_vector("_row").alias("features"))


def gbt_score(
    train: DataFrame, labels: DataFrame, target: DataFrame, ids: DataFrame, settings: TreeSettings | dict, size: int = 256, seed: int = 42,
    key: str = "id",
) -> DataFrame:
    """``id, score``: boosted trees over all terms.

    ``TreeSettings`` give ``histogram_score``, which bins every term's own weights. Settings under Spark ML's names give
    Spark's trees over terms hashed into ``size`` buckets, without l1, l2 and per-tree column share.
    """
    if isinstance(settings, TreeSettings):
        return histogram_score(train, labels, target, ids, settings, key)
    fitting = hashed_features(train, labels, size, key).join(labels.select(key, F.col("label").cast("double")), key)
    model = GBTClassifier(seed=seed, labelCol="label", **settings).fit(fitting)
    scored = model.transform(hashed_features(target, ids, size, key))
    return scored.select(key, vector_to_array("probability")[1].alias("score"))


def histogram_score(train: DataFrame, labels: DataFrame, target: DataFrame, ids: DataFrame, settings: TreeSettings, key: str = "id") -> DataFrame:
    """``id, score``: boosted trees over all terms."""
    return score_trees(fit_trees(cut(train), labels, settings, key), cut(target), ids, key)


@dataclass(frozen=True)
class TopicModel:
    """Word weights and one linear score per category: ``term, idf, c0, c1..``, with intercepts and names in their order."""

    terms: DataFrame
    intercepts: list[float]
    names: list[str]

    def save(self, path: str) -> None:
        """Write the terms as Parquet, and under null terms one row per category."""
        spark, width = self.terms.sparkSession, len(self.names)
        rows = [(None, name, [b], i) for i, (name, b) in enumerate(zip(self.names, self.intercepts))]
        heads = spark.createDataFrame(rows, "term string, name string, values array<double>, place int")
        values = F.array("idf", *[f"c{k}" for k in range(width)]).alias("values")
        terms = self.terms.select("term", F.lit(None).cast("string").alias("name"), values, F.lit(None).cast("int").alias("place"))
        terms.unionByName(heads).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TopicModel:
        rows = spark.read.parquet(path)
        heads = rows.where("term IS NULL").orderBy("place").collect()  # one per category
        columns = [F.col("values")[k + 1].alias(f"c{k}") for k in range(len(heads))]
        terms = rows.where("term IS NOT NULL").select("term", F.col("values")[0].alias("idf"), *columns)
        return cls(terms, [r["values"][0] for r in heads], [r["name"] for r in heads])


def topic_words(texts: DataFrame, key: str, text: str) -> DataFrame:
    return term_counts(texts.select(key, F.explode(lower_words(F.col(text))).alias("term")), key)


def topic_fit(
    texts: DataFrame, category: str, text: str = "text", c: float = 1.0, max_iter: int = 1000, tol: float = 1e-4, key: str = "id",
    vocab_from: DataFrame | None = None,
) -> TopicModel:
    """Word TF-IDF and multinomial logistic regression, text to category name.

    Vocabulary and idf come from ``vocab_from`` (by default the texts themselves), so a model may be fitted on a part
    whose weights the whole has set. Coefficients are a table with a column per category; categories must
    be few enough to name. Stops as the margin learner does, or raises. Texts of a null category only count for the idf.
    Counts and weights are written as Parquet and leave the disk once the blocks, which are written too, hold them.
    """
    source = texts if vocab_from is None else vocab_from
    with Scope(texts.sparkSession) as scope:
        counts = scope.write(topic_words(source, key, text), "topic-counts")
        idf = cut(idf_table(counts, source.agg(F.count("*")).scalar()))
        known = texts.where(F.col(category).isNotNull())
        names = [r[0] for r in known.select(category).distinct().orderBy(category).collect()]
        place = F.array_position(F.array(*map(F.lit, names)), F.col(category)) - 1
        labels = cut(known.select(key, place.cast("double").alias("label")))
        own = counts if vocab_from is None else topic_words(known, key, text)
        weights = scope.write(weigh(own.join(labels.select(key), key, "left_semi"), idf, False, key), "topic-weights")
        blocks = build_blocks(weights, labels.select(key), key)
    try:
        l2 = 1 / (c * max(1, labels.count()))
        state, bias, parts = minimize(blocks, labels, softmax, l2, tol, max_iter, width=len(names), memory=4, fall=tol, one_task=True)
        wide = unpack_columns(state, blocks.terms, parts, len(names))
        terms = cut(idf.drop("df").join(wide, "term", "left").na.fill(0.0))
    finally:
        blocks.release()
    return TopicModel(terms, bias.tolist(), names)


def topic_predict(model: TopicModel, texts: DataFrame, key: str = "id", text: str = "text", name: str = "prompt_name") -> DataFrame:
    """``id`` and the category of the largest score, the first name on a tie."""
    width = len(model.names)
    weights = weigh(topic_words(texts, key, text), model.terms.select("term", "idf"), False, key)
    scores = [F.sum(F.col("weight") * F.col(f"c{k}")).alias(f"s{k}") for k in range(width)]
    summed = weights.join(broadcast_if_small(model.terms.drop("idf")), "term").groupBy(key).agg(*scores)
    joined = texts.select(key).join(summed, key, "left")
    final = [F.round(F.coalesce(f"s{k}", F.lit(0.0)) + F.lit(b), 9) for k, b in enumerate(model.intercepts)]
    best = F.array_position(F.array(*final), F.greatest(*final) if width > 1 else final[0])
    return joined.select(key, F.element_at(F.array(*map(F.lit, model.names)), best.cast("int")).alias(name))


def batch_score(
    df: DataFrame, features: str, width: int, make_predict: Callable, class_index: int | None, batch_size: int = 64,
    name: str = "score",
) -> DataFrame:
    """Score rows in batches with a model function that each worker loads once.

    ``make_predict()`` returns a function from rows of ``width`` features to logits. With
    ``class_index`` the logits are rows of class scores and that class is taken.
    """
    predict = predict_batch_udf(make_predict, return_type=T.ArrayType(T.DoubleType()), batch_size=batch_size, input_tensor_shapes=[[width]])
    logits = predict(F.col(features))
    return df.withColumn(name, sigmoid(F.element_at(logits, 1 + (class_index or 0))))


def cv_fit_by_fold(folds: DataFrame, counts: DataFrame, weigh: Callable, score: Callable, chosen: Sequence[int], key: str = "id") -> DataFrame:
    """``id, label, fold, score``: every chosen fold scored by a model of the other folds.

    ``weigh(train_counts, n_train, target_counts)`` returns the weights of both sides with what the
    training side alone shows. ``score(train_weights, labels, target_weights, ids)`` returns
    ``id, score``. The counts are dealt by key once and kept for all folds, so that a fold's rows and norms are found
    where they lie; only its scores are written.
    """
    counts = hold(counts, int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)
    parts = []
    for fold in chosen:
        train, valid = folds.where(F.col("fold") != fold), folds.where(F.col("fold") == fold)
        near = counts.join(train.select(key), key, "left_semi")
        held = counts.join(valid.select(key), key, "left_semi")
        near, held = weigh(near, train.count(), held)
        parts.append(cut(valid.join(score(near, train.select(key, "label"), held, valid.select(key)), key)))
    counts.unpersist()
    return reduce(DataFrame.unionByName, parts).select(key, "label", "fold", "score")
