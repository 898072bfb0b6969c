"""N-gram weights, scaling, similarity."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.checks import query
from inkwell.functions.text import lower_words, words
from inkwell.operators import aggregates as agg
from inkwell.operators import features as fx
from inkwell.operators.relational import dedup_key_first, first_orders
from inkwell.plans.nearest import nearest_documents as nearest
from inkwell.session import broadcast_if_small, cut, spread
from inkwell.sources import tables

LOW, HIGH = 3, 4


def documents(spark, folder):
    return spread(tables.documents(spark, folder))


def targets(spark, folder):
    return spread(tables.targets(spark, folder))



def gram_sql(name: str, table: str, key: str) -> str:
    """All word 3- and 4-grams of a table as ``(id, term)``."""
    return rf"""{name}_words AS (SELECT {key} AS id, unnest(k) AS w, generate_subscripts(k, 1) AS p
          FROM (SELECT {key}, regexp_extract_all(text, '\S+') AS k FROM {table})),
        {name}_wide AS (SELECT w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o AS g3, g3 || ' ' || lead(w, 3) OVER o AS g4, id
          FROM {name}_words WINDOW o AS (PARTITION BY id ORDER BY p)),
        {name}_grams AS (SELECT id, term FROM (SELECT id, unnest([g3, g4]) AS term FROM {name}_wide) WHERE term IS NOT NULL)"""


TFIDF = f"""docs AS (SELECT doc_id AS id, text FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1),
  {gram_sql("train", "docs", "id")}, {gram_sql("goal", "benchmark", "item_id")},
  vocab AS (SELECT DISTINCT term FROM goal_grams),
  train_tf AS (SELECT id, term, count(*) AS tf FROM train_grams SEMI JOIN vocab USING (term) GROUP BY ALL),
  goal_tf AS (SELECT id, term, count(*) AS tf FROM goal_grams GROUP BY ALL),
  idf AS (SELECT v.term, ln((1 + (SELECT count(*) FROM docs)) / (1 + count(t.id))) + 1 AS idf
    FROM vocab v LEFT JOIN train_tf t USING (term) GROUP BY v.term),
  train_raw AS (SELECT id, term, (1 + ln(tf)) * idf AS w FROM train_tf JOIN idf USING (term)),
  goal_raw AS (SELECT id, term, (1 + ln(tf)) * idf AS w FROM goal_tf JOIN idf USING (term)),
  train AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS weight FROM train_raw),
  goal AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS weight FROM goal_raw)"""
SIMS = TFIDF + """, sims AS (SELECT q.id AS query_id, d.id, round(sum(q.weight * d.weight), 9) AS sim
    FROM goal q JOIN train d USING (term) GROUP BY ALL)"""


def weights(spark, folder):
    texts = documents(spark, folder).select("id", "text")
    docs = dedup_key_first(texts, "text", "id")
    goal = targets(spark, folder)
    return first_orders(texts, "text", "id"), goal, *fx.tfidf_pair(docs, goal, words(F.col("text")), LOW, HIGH, split=str.split)


@query(
    "document_frequency",
    r"""SELECT term, count(DISTINCT id) AS df FROM (SELECT doc_id AS id, unnest(regexp_extract_all(text, '\S+')) AS term FROM documents)
        GROUP BY term HAVING count(DISTINCT id) >= 2""",
)
def document_frequency(spark, folder):
    terms = documents(spark, folder).select("id", F.explode(words(F.col("text"))).alias("term"))
    return agg.document_frequency(terms, "id", "term", 2)


@query(
    "vocab_restrict",
    f"""WITH {gram_sql("train", "documents", "doc_id")}, {gram_sql("goal", "benchmark", "item_id")}
        SELECT id, term, count(*) AS tf FROM train_grams WHERE term IN (SELECT term FROM goal_grams) GROUP BY ALL""",
)
def vocab_restrict(spark, folder):
    tokens = words(F.col("text"))
    vocab = cut(fx.vocab_table(fx.grams(targets(spark, folder), tokens, LOW, HIGH)))
    kept = fx.vocab_restrict(fx.grams(documents(spark, folder), tokens, LOW, HIGH), vocab)
    return kept.groupBy("id", "term").agg(F.count("*").alias("tf"))


@query(
    "tfidf_ngrams",
    f"""WITH {TFIDF} SELECT 'train' AS part, id, term, round(weight, 6) AS weight FROM train
        UNION ALL SELECT 'target', id, term, round(weight, 6) FROM goal""",
)
def tfidf_ngrams(spark, folder):
    _, _, train, goal = weights(spark, folder)
    both = train.withColumn("part", F.lit("train")).unionByName(goal.withColumn("part", F.lit("target")))
    return both.select("part", "id", "term", F.round("weight", 6).alias("weight"))


@query(
    "tfidf_words",
    r"""WITH counts AS (SELECT id, term, count(*) AS tf FROM (SELECT doc_id AS id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS term
          FROM documents) GROUP BY ALL),
        idf AS (SELECT term, ln((1 + (SELECT count(*) FROM documents)) / (1 + count(*))) + 1 AS idf FROM counts GROUP BY term),
        raw AS (SELECT id, term, tf * idf AS w FROM counts JOIN idf USING (term))
        SELECT id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY id)), 6) AS weight FROM raw""",
)
def tfidf_words(spark, folder):
    weighted, _ = fx.tfidf_words(documents(spark, folder), lower_words(F.col("text")))
    return weighted.select("id", "term", F.round("weight", 6).alias("weight"))


@query(
    "max_abs_scale",
    f"""WITH {TFIDF}, top AS (SELECT term, max(abs(weight)) AS top FROM train GROUP BY term)
        SELECT 'train' AS part, id, term, round(weight / top, 6) AS weight FROM train JOIN top USING (term)
        UNION ALL SELECT 'target', id, term, round(weight / coalesce(top, 1), 6) FROM goal LEFT JOIN top USING (term)""",
)
def max_abs_scale(spark, folder):
    _, _, train, goal = weights(spark, folder)
    train, goal = fx.max_abs_scale(train, goal)
    both = train.withColumn("part", F.lit("train")).unionByName(goal.withColumn("part", F.lit("target")))
    return both.select("part", "id", "term", F.round("weight", 6).alias("weight"))


@query("cosine_similarity", f"WITH {SIMS} SELECT query_id, id, round(sim, 6) AS sim FROM sims")
def cosine_similarity(spark, folder):
    _, _, train, goal = weights(spark, folder)
    return fx.cosine_scores(cut(goal), train).select("query_id", "id", F.round("sim", 6).alias("sim"))


def topk_sql(k: int, ctes: str) -> str:
    return f"""WITH {ctes}, every AS (SELECT b.item_id AS query_id, d.id, coalesce(s.sim, 0.0) AS sim FROM benchmark b CROSS JOIN docs d
        LEFT JOIN sims s ON s.query_id = b.item_id AND s.id = d.id)
      SELECT query_id, id, round(sim, 6) AS sim, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, id) AS rank FROM every QUALIFY rank <= {k}"""


@query("topk_cosine_join", topk_sql(100, SIMS))
def topk_cosine_join(spark, folder):
    doc_ids, goal, train_weights, goal_weights = weights(spark, folder)
    best = fx.topk_cosine_join(goal, goal_weights, train_weights, doc_ids, 100)
    return best.select("query_id", "id", F.round("sim", 6).alias("sim"), "rank")


@query("nearest_documents", topk_sql(3, SIMS.replace("unnest([g3, g4])", "unnest([g3])")))
def nearest_documents(spark, folder):
    return nearest(spark, folder)


@query(
    "similar_training_rows",
    f"WITH best AS ({topk_sql(100, SIMS)}) SELECT DISTINCT d.id, d.text FROM docs_all d JOIN best ON best.id = d.id".replace(
        "WITH best", "WITH docs_all AS (SELECT doc_id AS id, text FROM documents), best"
    ),
)
def similar_training_rows(spark, folder):
    """The training rows near any target, each once."""
    near = cut(topk_cosine_join(spark, folder).select("id").distinct())
    return documents(spark, folder).select("id", "text").join(broadcast_if_small(near), "id", "left_semi")
