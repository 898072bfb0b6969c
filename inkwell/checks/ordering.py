"""Ranks, folds, samples, splits, batches, top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.checks import ESSAYS, GRADED, query
from inkwell.operators import order, pseudo, sampling
from inkwell.operators.aggregates import top_n_categories
from inkwell.operators.relational import composite_key, encode_first_seen
from inkwell.sources.tables import documents, essays, graded_scores, table

SEED = 42
NUMBERED = f"numbered AS (SELECT doc_id AS id, source, row_number() OVER (ORDER BY md5('{SEED}:' || doc_id), doc_id) - 1 AS n FROM documents)"


def score_of(spark, folder, name):
    return graded_scores(spark, folder).select("id", F.col(name).alias("score"))


@query("ordinal_rank", f"WITH {GRADED} SELECT id, score_a AS score, row_number() OVER (ORDER BY score_a, id) - 1 AS rank FROM graded")
def ordinal_rank(spark, folder):
    return order.ordinal_rank(score_of(spark, folder, "score_a"), "score").select("id", "score", "rank")


@query(
    "rank_blend",
    f"""WITH {GRADED} SELECT id, round(0.625 * (row_number() OVER (ORDER BY score_a, id) - 1)
        + 0.375 * (row_number() OVER (ORDER BY score_b, id) - 1), 6)::DOUBLE AS generated FROM graded""",
)
def rank_blend(spark, folder):
    blended = order.rank_blend(score_of(spark, folder, "score_a"), score_of(spark, folder, "score_b"))
    return blended.select("id", F.round("generated", 6).alias("generated"))


def kfold_sql(stratum: str, k: int) -> str:
    return f"""WITH {ESSAYS}, keyed AS (SELECT id, {stratum} AS stratum FROM essays),
      sizes AS (SELECT stratum, count(*) AS n FROM keyed GROUP BY stratum),
      firsts AS (SELECT stratum, coalesce(sum(n) OVER (ORDER BY md5(stratum), stratum
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first FROM sizes),
      ranked AS (SELECT id, stratum, row_number() OVER (PARTITION BY stratum ORDER BY md5('{SEED}:' || id), id) - 1 AS r FROM keyed)
      SELECT r.id, r.stratum, ((f.first + r.r) % {k})::INTEGER AS fold FROM ranked r JOIN firsts f USING (stratum)"""


@query("stratified_kfold", kfold_sql("coalesce(generated::VARCHAR, 'nan') || source", 5))
def stratified_kfold(spark, folder):
    keyed = essays(spark, folder).select("id", composite_key("generated", "source").alias("stratum"))
    return sampling.stratified_kfold(keyed, "stratum", 5, SEED)


@query("stratified_kfold_by_source", kfold_sql("source", 5))
def stratified_kfold_by_source(spark, folder):
    keyed = documents(spark, folder).select("id", F.col("source").alias("stratum"))
    return sampling.stratified_kfold(keyed, "stratum", 5, SEED)


@query(
    "fold_split_join",
    f"""WITH folds AS ({kfold_sql("source", 5)}) SELECT id, stratum, CASE WHEN fold = 0 THEN 'valid' ELSE 'train' END AS part FROM folds""",
)
def fold_split_join(spark, folder):
    train, valid = sampling.fold_split(stratified_kfold_by_source(spark, folder), 0)
    return train.select("id", "stratum", F.lit("train").alias("part")).unionByName(
        valid.select("id", "stratum", F.lit("valid").alias("part"))
    )


@query("sample_n", f"WITH {NUMBERED} SELECT id, source FROM numbered WHERE n < 100")
def sample_n(spark, folder):
    return sampling.sample_n(documents(spark, folder).select("id", "source"), 100, SEED)


@query(
    "source_balanced_sample",
    f"""SELECT doc_id AS id, source FROM documents WHERE source <> 'src3' UNION ALL
        SELECT * FROM (SELECT doc_id, source FROM documents WHERE source = 'src3' ORDER BY md5('{SEED}:' || doc_id), doc_id LIMIT 10)""",
)
def source_balanced_sample(spark, folder):
    docs = documents(spark, folder).select("id", "source")
    return sampling.source_balanced_sample(docs, "source", "src3", 10, SEED)


@query(
    "sample_frac",
    f"""SELECT doc_id AS id FROM documents WHERE ('0x' || substr(md5('{SEED}:' || doc_id), 1, 8))::BIGINT < {int(0.1 * 2**32)}""",
)
def sample_frac(spark, folder):
    return sampling.sample_frac(documents(spark, folder).select("id"), 0.1, SEED)


@query("shuffle_rows", f"WITH {NUMBERED} SELECT id, n AS place FROM numbered")
def shuffle_rows(spark, folder):
    """Hash order, shown by the place of each row in it."""
    return order.hash_rank(documents(spark, folder).select("id"), SEED, name="place")


@query(
    "train_test_split",
    f"WITH {NUMBERED} SELECT id, source, (n < (SELECT ceil(count(*) * 0.33) FROM documents))::INTEGER AS is_test FROM numbered",
)
def train_test_split(spark, folder):
    return sampling.train_test_split(documents(spark, folder).select("id", "source"), 0.33, SEED)


@query(
    "fixed_batches",
    """SELECT id, batch FROM (SELECT doc_id AS id, (row_number() OVER (ORDER BY doc_id) - 1) // 64 AS batch FROM documents)
       WHERE batch < (SELECT count(*) // 64 FROM documents)""",
)
def fixed_batches(spark, folder):
    return sampling.fixed_batches(documents(spark, folder).select("id"), ["id"], 64, drop_remainder=True)


@query(
    "repeat_epochs",
    f"SELECT doc_id AS id, e AS epoch, md5('{SEED}:' || e || ':' || doc_id) AS shuffle_key FROM documents, unnest([0, 1, 2]) t(e)",
)
def repeat_epochs(spark, folder):
    return sampling.repeat_epochs(documents(spark, folder).select("id"), 3, SEED)


@query("sort_by", f"WITH {GRADED} SELECT id, score_a, row_number() OVER (ORDER BY score_a DESC, id) - 1 AS place FROM graded")
def sort_by(spark, folder):
    """Scores from high to low, shown by the place of each row."""
    scores = graded_scores(spark, folder).select("id", "score_a")
    return order.range_index(scores, [F.desc("score_a"), F.col("id")], "place")


@query("head_n", f"WITH {GRADED} SELECT id, score_a FROM graded ORDER BY score_a DESC, id LIMIT 25")
def head_n(spark, folder):
    return order.head_n(graded_scores(spark, folder).select("id", "score_a"), [F.desc("score_a"), "id"], 25)


@query("tail_n", f"WITH {GRADED} SELECT id, score_a FROM graded ORDER BY score_a, id DESC LIMIT 25")
def tail_n(spark, folder):
    return order.head_n(graded_scores(spark, folder).select("id", "score_a"), ["score_a", F.desc("id")], 25)


@query("preview_rows", "SELECT doc_id AS id, text FROM documents ORDER BY doc_id LIMIT 5")
def preview_rows(spark, folder):
    return order.head_n(documents(spark, folder).select("id", "text"), ["id"], 5)


VOCAB = "vocab AS (SELECT DISTINCT unnest(string_split(text, ' ')) AS token FROM documents)"


def vocab(spark, folder):
    return documents(spark, folder).select(F.explode(F.split("text", " ")).alias("token")).distinct()


@query("slice_offset", f"WITH {VOCAB} SELECT token FROM vocab ORDER BY length(token) DESC, token OFFSET 100 LIMIT 10")
def slice_offset(spark, folder):
    return order.slice_rows(vocab(spark, folder), [F.desc(F.length("token")), "token"], 100, 10)


@query("longest_tokens", f"WITH {VOCAB} SELECT token, length(token)::INTEGER AS n FROM vocab ORDER BY length(token) DESC, token LIMIT 10")
def longest_tokens(spark, folder):
    sized = vocab(spark, folder).withColumn("n", F.length("token"))
    return order.head_n(sized, [F.desc("n"), "token"], 10)


@query("token_length", f"WITH {VOCAB} SELECT token, length(token)::INTEGER AS n FROM vocab")
def token_length(spark, folder):
    return vocab(spark, folder).withColumn("n", F.length("token"))


@query("vocab_table", f"WITH {VOCAB} SELECT token, row_number() OVER (ORDER BY token) - 1 AS token_id FROM vocab")
def vocab_table(spark, folder):
    return order.range_index(vocab(spark, folder), ["token"], "token_id")


@query(
    "top_n_categories",
    """SELECT lang AS prompt_name, count(*) AS n FROM documents GROUP BY lang ORDER BY n DESC, prompt_name
       LIMIT (SELECT count(DISTINCT label) // 3 FROM embeddings)""",
)
def top_n(spark, folder):
    wanted = table(spark, folder, "embeddings").agg(F.count_distinct("label")).first()[0] // 3
    return top_n_categories(documents(spark, folder), "prompt_name", wanted)


@query(
    "nearest_to_median",
    f"WITH {GRADED} SELECT id, score_a AS score FROM graded ORDER BY abs(score_a - (SELECT median(score_a) FROM graded)), id LIMIT 50",
)
def nearest_to_median(spark, folder):
    return order.nearest_to_median(score_of(spark, folder, "score_a"), "score", 50)


CLASSED = "classed AS (SELECT g.id, g.score_a AS score, d.source AS prompt_id FROM graded g JOIN documents d ON d.doc_id = g.id)"


@query(
    "per_class_top_bottom",
    f"""WITH {GRADED}, {CLASSED}, ranked AS (SELECT *, count(*) OVER (PARTITION BY prompt_id) AS n,
          row_number() OVER (PARTITION BY prompt_id ORDER BY score DESC, id) AS top,
          row_number() OVER (PARTITION BY prompt_id ORDER BY score, id DESC) AS bottom FROM classed)
        SELECT id, prompt_id, score, 1 AS label FROM ranked WHERE n >= 15 AND top <= 5
        UNION ALL SELECT id, prompt_id, score, 0 FROM ranked WHERE n >= 15 AND bottom <= 10""",
)
def per_class_top_bottom(spark, folder):
    classes = documents(spark, folder).select("id", F.col("source").alias("prompt_id"))
    return pseudo.per_class_top_bottom(classes.join(score_of(spark, folder, "score_a"), "id"), "prompt_id", "score", 5, 10)


@query("per_class_whole_table", f"WITH {GRADED}, {CLASSED} SELECT id, prompt_id, score, 1 AS label FROM classed")
def per_class_whole_table(spark, folder):
    """The same with a bound that the table does not reach: every row comes back with label 1."""
    classes = documents(spark, folder).select("id", F.col("source").alias("prompt_id"))
    rows = classes.join(score_of(spark, folder, "score_a"), "id")
    return pseudo.per_class_top_bottom(rows, "prompt_id", "score", 5, 10, whole_up_to=1_000_000_000)


@query(
    "pseudo_label_top_bottom",
    f"""WITH {GRADED} (SELECT id, score_a AS score, 1 AS label FROM graded ORDER BY score_a DESC, id LIMIT 100)
        UNION ALL (SELECT id, score_a, 0 FROM graded ORDER BY score_a, id DESC LIMIT 150)""",
)
def pseudo_label_top_bottom(spark, folder):
    return pseudo.top_bottom(score_of(spark, folder, "score_a"), "score", 100, 150)


@query(
    "pseudo_label_median",
    f"WITH {GRADED} SELECT id, score_a AS score, (score_a >= (SELECT median(score_a) FROM graded))::INTEGER AS label FROM graded",
)
def pseudo_label_median(spark, folder):
    return pseudo.by_median(score_of(spark, folder, "score_a"), "score")


@query(
    "per_query_topk",
    f"""WITH {GRADED}, {CLASSED} SELECT prompt_id, id, score, row_number() OVER (PARTITION BY prompt_id ORDER BY score DESC, id) AS rank
        FROM classed QUALIFY rank <= 3""",
)
def per_query_topk(spark, folder):
    classes = documents(spark, folder).select("id", F.col("source").alias("prompt_id"))
    scored = classes.join(score_of(spark, folder, "score_a"), "id")
    best = order.top_k_per_group(scored, ["prompt_id"], [F.desc("score"), "id"], 3, "id")
    return best.select("prompt_id", "id", "score", F.col("rank").cast("bigint").alias("rank"))


@query(
    "dataset_from_table",
    f"WITH {ESSAYS} SELECT id, text, generated FROM essays WHERE generated IS NOT NULL",
)
def dataset_from_table(spark, folder):
    return essays(spark, folder).where("generated IS NOT NULL").select("id", "text", "generated")


@query("aux_label_counts", "SELECT row_number() OVER (ORDER BY min(doc_id), source) - 1 AS aux_label, count(*) AS n FROM documents GROUP BY source")
def aux_label_counts(spark, folder):
    encoded = encode_first_seen(documents(spark, folder).select("id", "source"), "source", "id", "aux_label")
    return encoded.groupBy(F.col("aux_label").cast("bigint").alias("aux_label")).agg(F.count("*").alias("n"))
