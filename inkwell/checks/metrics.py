"""Counts, distributions, classification metrics, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.checks import ESSAYS, GRADED, SCORED, query
from inkwell.functions import arrays, numeric
from inkwell.functions.text import word_count
from inkwell.operators import aggregates as agg
from inkwell.operators import metrics as met
from inkwell.operators.relational import union_all
from inkwell.session import spread
from inkwell.sources.tables import documents, essays, graded_scores, labelled_scores, table


@query("value_counts", "SELECT lang AS prompt_name, count(*) AS n FROM documents GROUP BY lang")
def value_counts(spark, folder):
    return agg.value_counts(documents(spark, folder), "prompt_name")


@query(
    "group_value_counts",
    f"WITH {ESSAYS} SELECT source, generated, count(*) AS n FROM essays WHERE generated IS NOT NULL GROUP BY ALL",
)
def group_value_counts(spark, folder):
    return agg.value_counts(essays(spark, folder), "source", "generated")


@query(
    "group_size",
    f"WITH {ESSAYS} SELECT source, prompt_name, generated, count(*) AS n FROM essays GROUP BY ALL",
)
def group_size(spark, folder):
    return essays(spark, folder).groupBy("source", "prompt_name", "generated").agg(F.count("*").alias("n"))


@query("row_count", "SELECT count(*) AS n FROM documents")
def row_count(spark, folder):
    return documents(spark, folder).agg(F.count("*").alias("n"))


@query("count_distinct", "SELECT count(DISTINCT source) AS sources, count(DISTINCT text) AS texts FROM documents")
def count_distinct(spark, folder):
    return documents(spark, folder).agg(
        F.count_distinct("source").alias("sources"), F.count_distinct(F.sha2("text", 256)).alias("texts")
    )


@query("distinct_values", "SELECT DISTINCT source FROM documents")
def distinct_values(spark, folder):
    return documents(spark, folder).select("source").distinct()


@query(
    "table_profile",
    f"""WITH {ESSAYS} SELECT unnest(['id', 'text', 'source', 'prompt_name', 'n_chars', 'generated']) AS column_name,
        unnest(['bigint', 'string', 'string', 'string', 'bigint', 'int']) AS data_type,
        unnest([count(id), count(text), count(source), count(prompt_name), count(n_chars), count(generated)]) AS non_null FROM essays""",
)
def table_profile(spark, folder):
    return agg.table_profile(essays(spark, folder))


COUNTED = r"counted AS (SELECT doc_id AS id, len(regexp_extract_all(text, '\S+')) AS n FROM documents)"


def counted(spark, folder):
    return spread(documents(spark, folder)).select("id", word_count(F.col("text")).alias("n"))


@query("length_mean_plus_std", f"WITH {COUNTED} SELECT round(avg(n) + stddev_samp(n), 6) AS mean_plus_std FROM counted")
def length_mean_plus_std(spark, folder):
    summed = agg.length_mean_plus_std(counted(spark, folder), F.col("n"))
    return summed.select(F.round("mean_plus_std", 6).alias("mean_plus_std"))


@query("median_exact", f"WITH {GRADED} SELECT round(median(score_a), 6) AS median FROM graded")
def median_exact(spark, folder):
    from inkwell.operators.order import median_exact as median

    scores = graded_scores(spark, folder)
    middle = median(scores, "score_a")
    return scores.limit(1).select(F.round(F.lit(middle), 6).alias("median"))


@query("token_frequency", "SELECT token, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS token FROM documents) GROUP BY token")
def token_frequency(spark, folder):
    tokens = spread(documents(spark, folder)).select(F.explode(F.split("text", " ")).alias("token"))
    return tokens.groupBy("token").agg(F.count("*").alias("n"))


@query(
    "histogram_fixed_bins",
    f"""WITH {COUNTED}, span AS (SELECT min(n)::DOUBLE AS lo, (max(n) - min(n)) / 30.0::DOUBLE AS w FROM counted),
        binned AS (SELECT least(floor((n - lo) / w), 29)::INTEGER AS bin, count(*) AS n FROM counted, span GROUP BY 1)
        SELECT b::INTEGER AS bin, round(lo + b * w, 6) AS lo, round(lo + (b + 1) * w, 6) AS hi, coalesce(n, 0) AS n
        FROM range(30) t(b) CROSS JOIN span LEFT JOIN binned ON binned.bin = b""",
)
def histogram_fixed_bins(spark, folder):
    bins = agg.histogram_fixed_bins(counted(spark, folder), "n", 30)
    return bins.select("bin", F.round("lo", 6).alias("lo"), F.round("hi", 6).alias("hi"), "n")


@query(
    "kernel_density",
    f"""WITH {COUNTED}, s AS (SELECT count(n) AS c, stddev_samp(n) * count(n) ** (-0.2) AS w, min(n)::DOUBLE AS lo,
          (max(n) - min(n)) / 49.0::DOUBLE AS step FROM counted)
        SELECT round(lo + p * step, 6) AS x, round(sum(exp(-0.5 * pow((lo + p * step - n) / w, 2))) / any_value(c * w * sqrt(2 * pi())), 9) AS density
        FROM counted, s, range(50) t(p) GROUP BY 1""",
)
def kernel_density(spark, folder):
    density = agg.kernel_density(counted(spark, folder), "n", 50)
    return density.select(F.round("x", 6).alias("x"), F.round("density", 9).alias("density"))


PREDICTED = SCORED + ", predicted AS (SELECT id, label, (score > 0.5)::INTEGER AS predicted, score FROM scored)"


def predicted(spark, folder):
    return labelled_scores(spark, folder).withColumn("predicted", numeric.threshold_label(F.col("score")))


@query(
    "confusion_matrix",
    f"""WITH {PREDICTED} SELECT count(*) FILTER (label = 0 AND predicted = 0) AS tn, count(*) FILTER (label = 0 AND predicted = 1) AS fp,
        count(*) FILTER (label = 1 AND predicted = 0) AS fn, count(*) FILTER (label = 1 AND predicted = 1) AS tp FROM predicted""",
)
def confusion_matrix(spark, folder):
    return met.confusion_matrix(predicted(spark, folder), "label", "predicted")


@query(
    "f1_score",
    f"""WITH {PREDICTED}, c AS (SELECT count(*) FILTER (label = 1 AND predicted = 1) AS tp, count(*) FILTER (label <> predicted) AS bad FROM predicted)
        SELECT round(tp / (tp + bad / 2), 6) AS f1 FROM c""",
)
def f1_score(spark, folder):
    return met.f1_score(predicted(spark, folder), "label", "predicted").select(F.round("f1", 6).alias("f1"))


@query("accuracy", f"WITH {PREDICTED} SELECT round(avg((label = predicted)::INTEGER), 6) AS accuracy FROM predicted")
def accuracy(spark, folder):
    share = met.accuracy(predicted(spark, folder), "label", "predicted")
    return share.select(F.round("accuracy", 6).alias("accuracy"))


AUC = """SELECT {keys} CASE WHEN sum(label) * sum(1 - label) > 0 THEN round((sum(CASE WHEN label = 1 THEN r END) - sum(label) * (sum(label) + 1) / 2)
  / (sum(label) * sum(1 - label)), 6) END AS auc FROM ranked"""


@query(
    "roc_auc",
    f"""WITH {SCORED}, placed AS (SELECT *, row_number() OVER (ORDER BY score) AS n FROM scored),
        ranked AS (SELECT label, avg(n) OVER (PARTITION BY score) AS r FROM placed) {AUC.format(keys="")}""",
)
def roc_auc(spark, folder):
    return met.roc_auc(labelled_scores(spark, folder), "label", "score").select(F.round("auc", 6).alias("auc"))


@query(
    "roc_auc_by_source",
    f"""WITH {SCORED}, placed AS (SELECT s.*, d.source, row_number() OVER (PARTITION BY d.source ORDER BY score) AS n FROM scored s
          JOIN documents d ON d.doc_id = s.id),
        ranked AS (SELECT source, label, avg(n) OVER (PARTITION BY source, score) AS r FROM placed) {AUC.format(keys="source,")} GROUP BY source""",
)
def roc_auc_by_source(spark, folder):
    rows = labelled_scores(spark, folder).join(documents(spark, folder).select("id", "source"), "id")
    return met.roc_auc(rows, "label", "score", ("source",)).select("source", F.round("auc", 6).alias("auc"))


@query(
    "auc_thresholded",
    f"""WITH {SCORED}, t AS (SELECT i, CASE i WHEN 0 THEN -1e-7 WHEN 199 THEN 1 + 1e-7 ELSE i / 199.0::DOUBLE END AS cut FROM range(200) r(i)),
        points AS (SELECT i, sum((label = 1 AND score > cut)::INTEGER) AS tp, sum((label = 0 AND score > cut)::INTEGER) AS fp FROM scored, t GROUP BY i),
        steps AS (SELECT tp, fp, lead(tp) OVER (ORDER BY i) AS tp2, lead(fp) OVER (ORDER BY i) AS fp2 FROM points)
        SELECT round(sum((fp - fp2) * (tp + tp2) / 2) / (max(tp) * max(fp)), 6) AS auc FROM steps""",
)
def auc_thresholded(spark, folder):
    area = met.auc_thresholded(labelled_scores(spark, folder), "label", "score", 200)
    return area.select(F.round("auc", 6).alias("auc"))


def bce_sql(smoothing: float) -> str:
    y, p = f"(label * {1 - smoothing} + {smoothing / 2})", "greatest(least(score, 1 - 1e-7), 1e-7)"
    return f"-({y} * ln({p}) + (1 - {y}) * ln(1 - {p}))"


@query("bce_loss", f"WITH {SCORED} SELECT round(avg({bce_sql(0.0)}), 6) AS plain, round(avg({bce_sql(0.02)}), 6) AS smoothed FROM scored")
def bce_loss(spark, folder):
    y, p = F.col("label"), F.col("score")
    return labelled_scores(spark, folder).agg(
        F.round(F.avg(numeric.bce(y, p)), 6).alias("plain"), F.round(F.avg(numeric.bce(y, p, 0.02)), 6).alias("smoothed")
    )


CE = """vectors AS (SELECT vec_id AS id, list_transform(embedding[1:10], lambda x: x::DOUBLE) AS z, label FROM embeddings),
  summed AS (SELECT *, ln(list_sum(list_transform(z, lambda x: exp(x)))) AS lse FROM vectors),
  losses AS (SELECT id, 0.9 * (lse - z[label + 1]) + 0.1 * (lse - list_sum(z) / 10) AS loss FROM summed)"""


def class_logits(spark, folder):
    """Ten class logits per row and the true class."""
    logits = F.transform(F.slice("embedding", 1, 10), lambda x: x.cast("double"))
    return table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), logits.alias("logits"), "label")


@query("ce_loss", f"WITH {CE} SELECT id, round(loss, 6) AS loss FROM losses")
def ce_loss(spark, folder):
    loss = numeric.cross_entropy(F.col("logits"), F.col("label"), 0.1)
    return class_logits(spark, folder).select("id", F.round(loss, 6).alias("loss"))


@query(
    "weighted_multitask_loss",
    f"""WITH {CE} SELECT l.id, round(0.6 * (ln(1 + exp(z[1])) - z[1] * (label % 2)) + 0.4 * l.loss, 6) AS loss
        FROM losses l JOIN vectors v USING (id)""",
)
def weighted_multitask_loss(spark, folder):
    main = numeric.bce_with_logits(F.col("label") % 2, F.element_at("logits", 1))
    aux = numeric.cross_entropy(F.col("logits"), F.col("label"), 0.1)
    return class_logits(spark, folder).select("id", F.round(numeric.multitask_loss(main, aux, 0.4), 6).alias("loss"))


@query("sigmoid", "SELECT vec_id AS id, round(1 / (1 + exp(-embedding[1]::DOUBLE)), 6) AS p FROM embeddings")
def sigmoid(spark, folder):
    logit = F.element_at("embedding", 1).cast("double")
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.round(numeric.sigmoid(logit), 6).alias("p")
    )


@query(
    "softmax_prob",
    """SELECT vec_id AS id, round(exp(embedding[2]::DOUBLE) / list_sum(list_transform(embedding, lambda x: exp(x::DOUBLE))), 6) AS p
       FROM embeddings""",
)
def softmax_prob(spark, folder):
    logits = F.transform("embedding", lambda x: x.cast("double"))
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.round(arrays.softmax_prob(logits, 1), 6).alias("p")
    )


@query(
    "argmax_class",
    "SELECT vec_id AS id, (list_position(embedding, list_max(embedding)) - 1)::INTEGER AS class FROM embeddings",
)
def argmax_class(spark, folder):
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), arrays.argmax_class(F.col("embedding")).alias("class")
    )


WEIGHTS = [round(((i * 37) % 64) / 64 - 0.5, 6) for i in range(64)]


@query(
    "linear_head",
    f"""SELECT vec_id AS id, round(list_sum(list_transform(range(1, 65), lambda i: embedding[i]::DOUBLE * {WEIGHTS}[i]::DOUBLE)) + 0.25, 6) AS score
        FROM embeddings""",
)
def linear_head(spark, folder):
    weights = F.array(*map(F.lit, WEIGHTS))
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.round(arrays.linear_head(F.col("embedding"), weights, 0.25), 6).alias("score")
    )


POOL = """hidden AS (SELECT vec_id AS id, list_transform(range(8), lambda t: embedding[t * 8 + 1:t * 8 + 8]) AS v,
  list_transform(range(8), lambda t: ((vec_id + t) % 3 > 0)::INTEGER) AS m,
  list_transform(range(8), lambda t: CASE WHEN t > vec_id % 9 THEN 0 ELSE t + 5 END::INTEGER) AS ids FROM embeddings)"""


def hidden(spark, folder):
    """Eight token vectors of width eight per row, a mask, and padded token ids."""
    steps = F.sequence(F.lit(0), F.lit(7))
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.transform(steps, lambda t: F.slice("embedding", t * 8 + 1, F.lit(8))).alias("vectors"),
        F.transform(steps, lambda t: ((F.col("vec_id") + t) % 3 > 0).cast("int")).alias("mask"),
        F.transform(steps, lambda t: F.when(t > F.col("vec_id") % 9, 0).otherwise(t + 5)).alias("ids"),
    )


@query(
    "masked_mean_pool",
    f"""WITH {POOL} SELECT id, d::INTEGER AS dim, round(sum(v[t][d]::DOUBLE * m[t]) / greatest(sum(m[t]), 1e-9), 6) AS value
        FROM hidden, range(1, 9) a(t), range(1, 9) b(d) GROUP BY id, d""",
)
def masked_mean_pool(spark, folder):
    pooled = arrays.masked_mean_pool(F.col("vectors"), F.col("mask"))
    exploded = hidden(spark, folder).select("id", F.posexplode(pooled).alias("place", "value"))
    return exploded.select("id", (F.col("place") + 1).alias("dim"), F.round("value", 6).alias("value"))


@query(
    "last_token_pool",
    f"""WITH {POOL}, p AS (SELECT *, coalesce(list_position(ids, 0), 0) AS pad FROM hidden)
        SELECT id, d::INTEGER AS dim, round(v[CASE WHEN pad <= 1 THEN 8 ELSE pad - 1 END][d]::DOUBLE, 6) AS value FROM p, range(1, 9) b(d)""",
)
def last_token_pool(spark, folder):
    pooled = arrays.last_token_pool(F.col("vectors"), F.col("ids"), 0)
    exploded = hidden(spark, folder).select("id", F.posexplode(pooled).alias("place", "value"))
    return exploded.select(
        "id", (F.col("place") + 1).alias("dim"), F.round(F.col("value").cast("double"), 6).alias("value")
    )


@query(
    "validation_report",
    f"""WITH {SCORED}, n AS (SELECT count(*) AS n FROM scored), kept AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY id) AS i FROM scored)
          WHERE i <= (SELECT n - n % 16 FROM n)), placed AS (SELECT *, row_number() OVER (ORDER BY score) AS p FROM kept),
        ranked AS (SELECT label, avg(p) OVER (PARTITION BY score) AS r FROM placed)
        SELECT n, (SELECT round(avg({bce_sql(0.0)}), 6) FROM kept) AS loss, ({AUC.format(keys="")}) AS auc FROM n""",
)
def validation_report(spark, folder):
    report = met.validation_report(labelled_scores(spark, folder), "label", "score", 16)
    return report.select("n", F.round("loss", 6).alias("loss"), F.round("auc", 6).alias("auc"))


EPOCHS = """epochs AS (SELECT event_type AS fold, (user_id % 10)::INTEGER AS epoch, round(avg(value), 6) AS val_auc, round(stddev_pop(value), 6) AS val_loss
  FROM events GROUP BY ALL)"""


def epochs(spark, folder):
    """A made-up training history: one row per fold and epoch with two metrics."""
    return (
        table(spark, folder, "events")
        .groupBy(F.col("event_type").alias("fold"), (F.col("user_id") % 10).cast("int").alias("epoch"))
        .agg(F.round(F.avg("value"), 6).alias("val_auc"), F.round(F.stddev_pop("value"), 6).alias("val_loss"))
    )


BEST = f"WITH {EPOCHS} SELECT fold, epoch, val_auc, val_loss FROM epochs QUALIFY row_number() OVER (PARTITION BY fold ORDER BY val_auc DESC, epoch) = 1"


@query("best_epoch", BEST)
def best_epoch(spark, folder):
    return met.best_epoch(epochs(spark, folder), "fold", "epoch", "val_auc", "val_loss")


@query(
    "per_fold_report",
    f"WITH best AS ({BEST}) SELECT b.*, c.n FROM best b JOIN (SELECT event_type AS fold, count(*) AS n FROM events GROUP BY 1) c USING (fold)",
)
def per_fold_report(spark, folder):
    sizes = table(spark, folder, "events").groupBy(F.col("event_type").alias("fold")).agg(F.count("*").alias("n"))
    return best_epoch(spark, folder).join(sizes, "fold")


STEPS = "steps AS (SELECT event_type AS epoch, event_id AS step, round(value * 100) AS loss, (user_id % 2)::INTEGER AS y, (event_id * 37) % 101 AS s FROM events)"


def steps(spark, folder):
    """Training steps: loss, label and score of each event, one epoch per event type."""
    return table(spark, folder, "events").select(
        F.col("event_type").alias("epoch"), F.col("event_id").alias("step"), F.round(F.col("value") * 100).alias("loss"),
        (F.col("user_id") % 2).cast("int").alias("y"), ((F.col("event_id") * 37) % 101).alias("s"),
    )


@query(
    "running_metrics",
    f"""WITH {STEPS} SELECT epoch, step, loss AS step_loss,
        round(avg(loss) OVER (PARTITION BY epoch ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS mean_loss FROM steps""",
)
def running_metrics(spark, folder):
    ran = met.running_metrics(steps(spark, folder), "epoch", "step", "loss")
    return ran.select("epoch", "step", "step_loss", F.round("mean_loss", 6).alias("mean_loss"))


@query(
    "running_auc",
    f"""WITH {STEPS}, gains AS (SELECT a.epoch, a.step, a.y, sum(CASE WHEN a.y <> b.y THEN CASE WHEN a.s = b.s THEN 0.5
            WHEN (a.s > b.s) = (a.y = 1) THEN 1.0 ELSE 0.0 END ELSE 0.0 END) AS gain
          FROM steps a LEFT JOIN steps b ON b.epoch = a.epoch AND b.step < a.step GROUP BY ALL),
        sums AS (SELECT epoch, step, sum(gain) OVER w AS wins, sum(y) OVER w AS pos, sum(1 - y) OVER w AS neg FROM gains
          WINDOW w AS (PARTITION BY epoch ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
        SELECT epoch, step, CASE WHEN pos * neg > 0 THEN round(wins::DOUBLE / (pos * neg)::DOUBLE, 6) END AS auc_so_far FROM sums""",
)
def running_auc(spark, folder):
    ran = met.running_auc(steps(spark, folder), "epoch", "step", "y", "s")
    return ran.select("epoch", "step", F.round("auc_so_far", 6).alias("auc_so_far"))


def model_scores(spark, folder):
    """Rows ``(id, model, score)`` of two models."""
    scores = graded_scores(spark, folder)
    return union_all(
        *[scores.select("id", F.lit(m).alias("model"), F.col(m).alias("score")) for m in ("score_a", "score_b")]
    )


@query("ensemble_mean", f"WITH {GRADED} SELECT id, round((score_a + score_b) / 2, 6) AS score FROM graded")
def ensemble_mean(spark, folder):
    return met.ensemble_mean(model_scores(spark, folder)).select("id", F.round("score", 6).alias("score"))


@query("soft_vote", f"WITH {GRADED} SELECT id, round((0.068 * score_a + 0.31 * score_b) / (0.068 + 0.31), 6) AS score FROM graded")
def soft_vote(spark, folder):
    voted = met.soft_vote(model_scores(spark, folder), {"score_a": 0.068, "score_b": 0.31})
    return voted.select("id", F.round("score", 6).alias("score"))
