"""Learners, user functions, model files, self-training and ensemble plans."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from inkwell.checks import ESSAYS, SCORED, query
from inkwell.checks.metrics import AUC, WEIGHTS
from inkwell.functions.numeric import sigmoid
from inkwell.functions.text import hash_int, lower_ascii, lower_words
from inkwell.operators import batches
from inkwell.operators import features as fx
from inkwell.operators import learners as ln
from inkwell.operators import metrics as met
from inkwell.operators.aggregates import top_n_categories
from inkwell.operators.relational import union_all
from inkwell.operators.sampling import stratified_kfold, train_test_split
from inkwell.plans.rank_ensemble import rank_ensemble as ranked
from inkwell.plans.self_training import Corpora, self_training, weak_refine
from inkwell.session import cut, scratch_path, spread
from inkwell.sources.tables import documents, essays, labelled_scores, table, targets

SEED = 42
#: The local refit learns fewer subwords and stops earlier, as the topic model does; row counts are the full ones.
SUBWORDS, LOOSE = 320, 1e-2


def training_rows(spark, folder):
    """Labelled documents: ``id, text, label, source``."""
    rows = essays(spark, folder).where("generated IS NOT NULL")
    return rows.select("id", "text", F.col("generated").alias("label"), "source")


def word_weights(spark, folder):
    """Word TF-IDF of the labelled documents and the targets, with their tables."""
    train, goal = spread(cut(training_rows(spark, folder))), targets(spark, folder)
    train_weights, goal_weights = map(cut, fx.tfidf_words(train, lower_words(F.col("text")), goal, dealt=False))
    return train, goal, train_weights, goal_weights


def scored_targets(spark, folder, score, **settings):
    train, goal, train_weights, goal_weights = word_weights(spark, folder)
    out = score(train_weights, train.select("id", "label"), goal_weights, goal.select("id"), **settings)
    return out.select("id", F.round("score", 6).alias("score"))


def gradient_terms(train, train_weights, model, slope, l2, scale=1.0):
    """Each term's slope of the objective at a model's coefficients, summed by plain joins, as a share of ``scale``."""
    decided = model.decision(train_weights, train.select("id"))
    slopes = decided.join(train.select("id", "label"), "id").select("id", slope(F.col("decision"), F.col("label")).alias("slope"))
    sums = train_weights.join(slopes, "id").groupBy("term").agg(F.sum(F.col("weight") * F.col("slope")).alias("pull"))
    total = (F.col("pull") + l2 * F.col("coef")) / scale
    return sums.join(model.coefficients, "term").select("term", (F.round(total, 3) + F.lit(0.0)).alias("gradient"))


LABELLED_TERMS = r"""SELECT DISTINCT term, 0.0 AS gradient FROM (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS term
  FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL)"""


@query("ridge_gradient", LABELLED_TERMS)
def ridge_gradient(spark, folder):
    """No term pulls at the ridge solution: its gradient, against the length of the gradient at zero, rounds to nothing."""
    train, _, train_weights, _ = word_weights(spark, folder)
    model = ln.ridge_fit(train_weights, train.select("id", "label"), one_task=True)
    centred = train.select("id", (F.col("label") - train.agg(F.avg("label")).scalar()).alias("y"))
    start = train_weights.join(centred, "id").groupBy("term").agg(F.sum(F.col("weight") * F.col("y")).alias("pull"))
    length = start.agg(F.sqrt(F.sum(F.col("pull") * F.col("pull")))).first()[0]
    return gradient_terms(train, train_weights, model, lambda d, y: d - y, 1.0, length)


@query("ridge_score")
def ridge_score(spark, folder):
    return scored_targets(spark, folder, ln.ridge_score)


LOWER_WORDS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"
NB = rf"""{ESSAYS}, train AS (SELECT id, text, generated AS label FROM essays WHERE generated IS NOT NULL),
  counts AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest({LOWER_WORDS}) AS term FROM train) GROUP BY ALL),
  idf AS (SELECT term, ln((1 + (SELECT count(*) FROM train)) / (1 + count(*))) + 1 AS idf FROM counts GROUP BY term),
  raw AS (SELECT id, term, tf * idf AS w FROM counts JOIN idf USING (term)),
  weights AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM raw),
  goal_counts AS (SELECT id, term, count(*) AS tf FROM (SELECT item_id AS id, unnest({LOWER_WORDS}) AS term FROM benchmark) GROUP BY ALL),
  goal_raw AS (SELECT id, term, tf * idf AS w FROM goal_counts JOIN idf USING (term)),
  goal AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM goal_raw),
  sums AS (SELECT term, sum(CASE WHEN label = 0 THEN w ELSE 0 END) AS c0, sum(CASE WHEN label = 1 THEN w ELSE 0 END) AS c1
    FROM weights JOIN train USING (id) GROUP BY term),
  totals AS (SELECT sum(c0) + 0.02 * count(*) AS t0, sum(c1) + 0.02 * count(*) AS t1 FROM sums),
  prior AS (SELECT ln(sum(label)) - ln(sum(1 - label)) AS odds FROM train),
  decided AS (SELECT b.item_id AS id, coalesce(sum(g.w * (ln((c1 + 0.02) / t1) - ln((c0 + 0.02) / t0))), 0) + any_value(odds) AS d
    FROM benchmark b CROSS JOIN totals CROSS JOIN prior LEFT JOIN (goal g JOIN sums USING (term)) ON g.id = b.item_id GROUP BY b.item_id)"""


@query("naive_bayes", f"WITH {NB} SELECT id, round(1 / (1 + exp(-d)), 6) AS score FROM decided")
def naive_bayes(spark, folder):
    return scored_targets(spark, folder, ln.naive_bayes_score)


@query("sgd_modified_huber")
def sgd_modified_huber(spark, folder):
    return scored_targets(spark, folder, ln.modified_huber_score)


@query("gbt_a")
def gbt_a(spark, folder):
    """The first setting whole: 2,500 trees of up to 31 leaves."""
    return scored_targets(spark, folder, ln.gbt_score, settings=ln.TREES_A)


@query("gbt_b")
def gbt_b(spark, folder):
    """The second setting whole: 2,000 symmetric trees of depth 6."""
    return scored_targets(spark, folder, ln.gbt_score, settings=ln.TREES_B)


def topic_model(spark, folder):
    """Vocabulary and idf of all documents, coefficients of the training part."""
    texts = spread(cut(documents(spark, folder).select("id", "text", "prompt_name")))
    known = train_test_split(texts, 0.05, SEED)
    return ln.topic_fit(known.where("is_test = 0"), "prompt_name", vocab_from=texts, tol=LOOSE)


@query("topic_classifier")
def topic_classifier(spark, folder):
    return ln.topic_predict(topic_model(spark, folder), targets(spark, folder))


@query("topic_top_prompts")
def topic_top_prompts(spark, folder):
    """The prompts predicted most often for the targets."""
    return top_n_categories(topic_classifier(spark, folder), "prompt_name", 2)


@query("model_save_load")
def model_save_load(spark, folder):
    """A model written, read back and applied."""
    path = scratch_path(spark, "topic-model")
    topic_model(spark, folder).save(path)
    return ln.topic_predict(ln.TopicModel.load(spark, path), targets(spark, folder))


def make_linear():
    """A linear model of two classes, as a worker would load it."""
    weights = np.array(WEIGHTS)

    def predict(batch: np.ndarray) -> np.ndarray:
        first = batch.astype(np.float64) @ weights
        return np.stack([first, -0.5 * first], axis=1)

    return predict


LOGIT = f"list_sum(list_transform(range(1, 65), lambda i: embedding[i]::DOUBLE * {WEIGHTS}[i]::DOUBLE))"


def vectors(spark, folder):
    return table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), "embedding")


@query("term_model_save_load", f"WITH {NB} SELECT id, round(1 / (1 + exp(-d)), 6) AS score FROM decided")
def term_model_save_load(spark, folder):
    """Naive Bayes coefficients written, read back and applied."""
    train, goal, train_weights, goal_weights = word_weights(spark, folder)
    path = scratch_path(spark, "term-model")
    ln.naive_bayes_fit(train_weights, train.select("id", "label")).save(path)
    decision = ln.TermModel.load(spark, path).decision(goal_weights, goal.select("id"))
    return decision.select("id", F.round(sigmoid(F.col("decision")), 6).alias("score"))


@query("batch_score", f"SELECT vec_id AS id, round(1 / (1 + exp(0.5 * {LOGIT})), 6) AS score FROM embeddings")
def batch_score(spark, folder):
    scored = ln.batch_score(vectors(spark, folder), "embedding", 64, make_linear, class_index=1)
    return scored.select("id", F.round("score", 6).alias("score"))


@query("udf_model", f"SELECT vec_id AS id, round(1 / (1 + exp(-{LOGIT})), 6) AS score FROM embeddings")
def udf_model(spark, folder):
    """The same model with class 0 taken."""
    scored = ln.batch_score(vectors(spark, folder), "embedding", 64, make_linear, class_index=0)
    return scored.select("id", F.round("score", 6).alias("score"))


@query("udf_scalar", r"SELECT doc_id AS id, len(regexp_extract_all(text, '\S+')) AS n FROM documents")
def udf_scalar(spark, folder):
    """A Python word count per text."""
    count = batches.apply_scalar(F.col("text"), lambda t: len(t.split()), "bigint")
    return documents(spark, folder).select("id", count.alias("n"))


@query(
    "udf_row",
    "SELECT doc_id AS id, CASE WHEN source = 'src0' AND n_chars > 1000 THEN 'long' WHEN source = 'src0' THEN 'short' END AS kind FROM documents",
)
def udf_row(spark, folder):
    """A rule over several columns of a row."""
    kind = F.when((F.col("source") == "src0") & (F.col("n_chars") > 1000), "long").when(F.col("source") == "src0", "short")
    return documents(spark, folder).select("id", kind.alias("kind"))


@query("udf_batched", "SELECT doc_id AS id, length(text) AS n FROM documents")
def udf_batched(spark, folder):
    """A function from batch to batch."""
    measure = lambda batch: batch.assign(n=batch["text"].str.len())[["id", "n"]]
    return batches.map_batches(documents(spark, folder).select("id", "text"), measure, "id bigint, n bigint")


@query(
    "udf_dataset_map",
    "SELECT doc_id AS id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text, lang AS label FROM documents",
)
def udf_dataset_map(spark, folder):
    return documents(spark, folder).select("id", lower_ascii(F.col("text")).alias("text"), F.col("prompt_name").alias("label"))


@query(
    "udaf_metric",
    f"""WITH {SCORED}, placed AS (SELECT *, row_number() OVER (ORDER BY score) AS n FROM scored),
        ranked AS (SELECT label, avg(n) OVER (PARTITION BY score) AS r FROM placed)
        SELECT auc, (SELECT round(avg((label = (score > 0.5)::INTEGER)::INTEGER), 6) FROM scored) AS accuracy FROM ({AUC.format(keys="")})""",
)
def udaf_metric(spark, folder):
    rows = labelled_scores(spark, folder).withColumn("predicted", (F.col("score") > 0.5).cast("int"))
    share = met.accuracy(rows, "label", "predicted").scalar()
    area = met.roc_auc(rows, "label", "score")
    return area.select(F.round("auc", 6).alias("auc"), F.round(share, 6).alias("accuracy"))


@query("chunk_iter", "SELECT count(*) AS rows, sum(length(text))::BIGINT AS total, true AS cut FROM documents")
def chunk_iter(spark, folder):
    """Chunks of 7 texts, summed up again; only the last chunk of a task may be smaller."""
    chunks = batches.chunk_sizes(documents(spark, folder), 7, "text")
    full = (F.max("rows") == 7) & (F.count_if(F.col("rows") < 7) <= F.count_if(F.col("chunk") == 0))
    return chunks.agg(F.sum("rows").alias("rows"), F.sum("total").alias("total"), full.alias("cut"))


@query("cv_fit_by_fold")
def cv_fit_by_fold(spark, folder):
    """Naive Bayes over word weights, each fold scored by the other folds."""
    train = spread(cut(training_rows(spark, folder)))
    counts = fx.text_counts(train.select("id", "text"), lower_words(F.col("text")))
    folds = cut(stratified_kfold(train.select("id", "label", "source"), "source", 5, SEED))

    def weigh(near, n, held):
        idf = cut(fx.idf_table(near, n))
        return fx.weigh(near, idf, False), fx.weigh(held, idf, False)

    scored = ln.cv_fit_by_fold(folds, counts, weigh, ln.naive_bayes_score, range(5))
    return met.roc_auc(scored, "label", "score", ("fold",)).select("fold", F.round("auc", 6).alias("auc"))


def corpora(spark, folder):
    """Labelled documents as training rows, chat turns as generated rows, one source as old rows."""
    train = spread(cut(training_rows(spark, folder)))
    turn = F.col("conv_id") * 1_000 + F.col("turn")
    generated = table(spark, folder, "conversations").select(turn.alias("id"), "text", F.lit(1).alias("label"))
    old = train.where("source = 'src0'").select("id", "text", "label")
    return Corpora(train.select("id", "text", "label"), generated, old, targets(spark, folder))


def encoder_scores(spark, folder):
    """Stand-in scores of an encoder: a hash of the target's id."""
    return targets(spark, folder).select("id", (hash_int(SEED, F.col("id"), "encoder") / float(2**32)).alias("score"))


@query("self_training_loop")
def self_training_loop(spark, folder):
    """Four rounds over 5,000 subwords."""
    scores, _ = self_training(corpora(spark, folder), encoder_scores(spark, folder))
    return scores.select("id", F.round("score", 6).alias("score"))


@query("weak_refine")
def weak(spark, folder):
    encoder = encoder_scores(spark, folder)
    start = encoder.select("id", F.round(1 - F.col("score"), 9).alias("score"))
    refined = weak_refine(corpora(spark, folder), start, encoder, vocab_size=SUBWORDS, tol=LOOSE)
    return refined.select("id", F.round("score", 6).alias("score"))


@query("rank_ensemble")
def rank_ensemble(spark, folder):
    """Two stand-in encoders and the vote of four learners, blended by rank."""
    goal = targets(spark, folder)
    encoders = [goal.select("id", F.lit(m).alias("model"), (hash_int(SEED, F.col("id"), m) / float(2**32)).alias("score")) for m in "ab"]
    blended = ranked(training_rows(spark, folder), goal, union_all(*encoders))
    return blended.select("id", F.round("generated", 6).alias("generated"))
