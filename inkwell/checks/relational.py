"""Projections, filters, keyed joins, set operations, duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.checks import ESSAYS, GRADED, query
from inkwell.functions.numeric import affine_blend, threshold_label
from inkwell.functions.text import newline_to_space
from inkwell.operators import relational as rel
from inkwell.operators.aggregates import top_n_categories
from inkwell.operators.order import range_index
from inkwell.sources.tables import documents, essays, graded_scores, table, targets

# Class names, and the prompt names of two prompt ids.
CLASS_NAMES = {0: "real", 1: "fake"}
PROMPT_NAMES = {1: "Does the electoral college work?", 0: "Car-free cities"}
EXCLUDED = ["fr", "de"]


@query("select_cols", "SELECT doc_id AS id, text FROM documents")
def select_cols(spark, folder):
    return documents(spark, folder).select("id", "text")


@query("drop_cols", "SELECT doc_id, lang, source FROM documents")
def drop_cols(spark, folder):
    return table(spark, folder, "documents").drop("text", "n_chars")


@query("rename_cols", "SELECT doc_id AS id, lang AS prompt_name, source AS model FROM documents")
def rename_cols(spark, folder):
    return (
        table(spark, folder, "documents")
        .withColumnsRenamed({"doc_id": "id", "lang": "prompt_name", "source": "model"})
        .select("id", "prompt_name", "model")
    )


@query("add_constant", "SELECT doc_id AS id, 'train_essay' AS source, 1 AS label FROM documents")
def add_constant(spark, folder):
    return documents(spark, folder).select("id").withColumns({"source": F.lit("train_essay"), "label": F.lit(1)})


@query("copy_col", f"WITH {ESSAYS} SELECT id, generated, generated AS label FROM essays")
def copy_col(spark, folder):
    return essays(spark, folder).select("id", "generated").withColumn("label", F.col("generated"))


@query(
    "map_values",
    f"WITH {ESSAYS} SELECT id, CASE generated WHEN 0 THEN 'real' WHEN 1 THEN 'fake' END AS name FROM essays",
)
def map_values(spark, folder):
    return essays(spark, folder).select("id", rel.map_values("generated", CLASS_NAMES).alias("name"))


FIRST_SEEN = """SELECT d.doc_id AS id, d.source, f.aux_label FROM documents d JOIN (
  SELECT source, row_number() OVER (ORDER BY min(doc_id), source) - 1 AS aux_label FROM documents GROUP BY source
) f ON f.source = d.source"""


@query("encode_first_seen", FIRST_SEEN)
def encode_first_seen(spark, folder):
    docs = documents(spark, folder).select("id", "source")
    return rel.encode_first_seen(docs, "source", "id", "aux_label").select(
        "id", "source", F.col("aux_label").cast("bigint").alias("aux_label")
    )


@query(
    "case_category",
    """SELECT doc_id AS id, CASE doc_id % 3 WHEN 1 THEN 'Does the electoral college work?'
       WHEN 0 THEN 'Car-free cities' END AS prompt_name FROM documents""",
)
def case_category(spark, folder):
    coded = documents(spark, folder).select("id", (F.col("id") % 3).alias("prompt_id"))
    return coded.select("id", rel.case_category("prompt_id", PROMPT_NAMES).alias("prompt_name"))


@query(
    "composite_key",
    f"WITH {ESSAYS} SELECT id, coalesce(generated::VARCHAR, 'nan') || source AS stratify FROM essays",
)
def composite_key(spark, folder):
    return essays(spark, folder).select("id", rel.composite_key("generated", "source").alias("stratify"))


@query("filter_eq", "SELECT doc_id AS id, source FROM documents WHERE source = 'src3'")
def filter_eq(spark, folder):
    return documents(spark, folder).where(F.col("source") == "src3").select("id", "source")


@query("filter_ne", f"WITH {ESSAYS} SELECT id, generated FROM essays WHERE generated IS DISTINCT FROM 1")
def filter_ne(spark, folder):
    return essays(spark, folder).where(rel.differs("generated", 1)).select("id", "generated")


NULLED = "nulled AS (SELECT doc_id AS id, nullif(lang, 'es') AS prompt_name, text FROM documents)"


def nulled(spark, folder):
    """Documents whose category is missing for one language."""
    return documents(spark, folder).withColumn("prompt_name", F.nullif("prompt_name", F.lit("es")))


@query(
    "filter_category_or_null",
    f"WITH {NULLED} SELECT id, prompt_name FROM nulled WHERE prompt_name = 'fr' OR prompt_name IS NULL",
)
def filter_category_or_null(spark, folder):
    return nulled(spark, folder).where(rel.equals_or_null("prompt_name", "fr")).select("id", "prompt_name")


@query("filter_single_category", f"WITH {NULLED} SELECT id, prompt_name FROM nulled WHERE prompt_name = 'fr'")
def filter_single_category(spark, folder):
    return nulled(spark, folder).where(F.col("prompt_name") == "fr").select("id", "prompt_name")


@query(
    "filter_not_in",
    f"WITH {NULLED} SELECT id, prompt_name FROM nulled WHERE prompt_name IS NULL OR prompt_name NOT IN ('fr', 'de')",
)
def filter_not_in(spark, folder):
    return nulled(spark, folder).where(rel.not_in("prompt_name", EXCLUDED)).select("id", "prompt_name")


TOP_TWO = "top AS (SELECT lang FROM documents GROUP BY lang ORDER BY count(*) DESC, lang LIMIT 2)"


@query("filter_in_dynamic", f"WITH {TOP_TWO} SELECT doc_id AS id, lang AS prompt_name FROM documents WHERE lang IN (FROM top)")
def filter_in_dynamic(spark, folder):
    docs = documents(spark, folder).select("id", "prompt_name")
    top = top_n_categories(docs, "prompt_name", 2)
    return docs.join(F.broadcast(top), "prompt_name", "left_semi").select("id", "prompt_name")


@query(
    "fill_null",
    f"WITH {NULLED} SELECT id, coalesce(prompt_name, '') AS prompt_name FROM nulled",
)
def fill_null(spark, folder):
    return nulled(spark, folder).na.fill("", ["prompt_name"]).select("id", "prompt_name")


@query(
    "update_subset",
    "SELECT doc_id AS id, CASE WHEN source <> 'src0' THEN replace(text, chr(10), ' ') ELSE text END AS text FROM documents",
)
def update_subset(spark, folder):
    text = F.when(F.col("source") != "src0", newline_to_space(F.col("text"))).otherwise(F.col("text"))
    return documents(spark, folder).select("id", text.alias("text"))


@query(
    "cast_col",
    f"WITH {ESSAYS} SELECT id, n_chars::INTEGER AS n, generated::DOUBLE AS y, id::VARCHAR AS s FROM essays",
)
def cast_col(spark, folder):
    return essays(spark, folder).select(
        "id", F.col("n_chars").cast("int").alias("n"), F.col("generated").cast("double").alias("y"),
        F.col("id").cast("string").alias("s"),
    )


@query(
    "threshold_label",
    f"""WITH {GRADED} SELECT id, (score_a > 0.5)::INTEGER AS label,
        CASE WHEN score_a > 0.5 THEN 'fake' ELSE 'real' END AS name FROM graded""",
)
def threshold(spark, folder):
    labelled = graded_scores(spark, folder).select("id", threshold_label(F.col("score_a")).alias("label"))
    return labelled.withColumn("name", rel.map_values("label", CLASS_NAMES))


@query(
    "assign_row_id",
    "SELECT row_number() OVER (ORDER BY source, doc_id) - 1 AS row_index, doc_id AS id, source FROM documents",
)
def assign_row_id(spark, folder):
    return range_index(documents(spark, folder).select("id", "source"), ["source", "id"])


@query("affine_blend", f"WITH {GRADED} SELECT id, round(0.65 * score_a + 0.35 * score_b, 6) AS score FROM graded")
def blend(spark, folder):
    score = affine_blend((0.65, F.col("score_a")), (0.35, F.col("score_b")))
    return graded_scores(spark, folder).select("id", F.round(score, 6).alias("score"))


@query("final_blend", f"WITH {GRADED} SELECT id, round(0.8 * score_a + 0.2 * score_b, 6) AS generated FROM graded")
def final_blend(spark, folder):
    score = affine_blend((0.8, F.col("score_a")), (0.2, F.col("score_b")))
    return graded_scores(spark, folder).select("id", F.round(score, 6).alias("generated"))


@query(
    "bind_scores",
    f"WITH {GRADED} SELECT d.doc_id AS id, d.source, g.score_a AS score FROM documents d JOIN graded g ON g.id = d.doc_id",
)
def bind_scores(spark, folder):
    docs = documents(spark, folder).select("id", "source")
    scores = graded_scores(spark, folder).select("id", F.col("score_a").alias("score"))
    return rel.bind_scores(docs, scores)


@query(
    "update_join",
    f"""WITH {GRADED} SELECT g.id, coalesce(CASE WHEN l.toxic = 0 THEN l.quality::DOUBLE END, g.score_a) AS score
        FROM graded g LEFT JOIN labels l ON l.doc_id = g.id""",
)
def update_join(spark, folder):
    scores = graded_scores(spark, folder).select("id", F.col("score_a").alias("score"))
    new = F.when(F.col("toxic") == 0, F.col("quality").cast("double"))
    updates = table(spark, folder, "labels").select(F.col("doc_id").alias("id"), new.alias("score"))
    return rel.update_join(scores, updates)


@query(
    "lookup_join",
    """WITH codes AS (SELECT lang, row_number() OVER (ORDER BY lang) AS code FROM (SELECT DISTINCT lang FROM documents))
       SELECT d.doc_id AS id, d.lang AS prompt_name, c.code FROM documents d LEFT JOIN codes c ON c.lang = d.lang""",
)
def lookup_join(spark, folder):
    docs = documents(spark, folder).select("id", "prompt_name")
    codes = range_index(docs.select("prompt_name").distinct(), ["prompt_name"], "code", start=1)
    return rel.lookup_join(docs, codes, "prompt_name").select("id", "prompt_name", "code")


@query(
    "semi_join_top_prompts",
    f"""WITH {TOP_TWO}, {ESSAYS} SELECT id, prompt_name, generated FROM essays WHERE prompt_name IN (FROM top)""",
)
def semi_join_top_prompts(spark, folder):
    train = essays(spark, folder).select("id", "prompt_name", "generated")
    top = top_n_categories(documents(spark, folder), "prompt_name", 2)
    return train.join(F.broadcast(top), "prompt_name", "left_semi").select("id", "prompt_name", "generated")


@query(
    "union_all",
    """SELECT doc_id AS id, text, lang AS prompt_name FROM documents
       UNION ALL SELECT item_id, text, NULL FROM benchmark UNION ALL SELECT conv_id, text, NULL FROM conversations""",
)
def union_all(spark, folder):
    chats = table(spark, folder, "conversations").select(F.col("conv_id").alias("id"), "text")
    docs = documents(spark, folder).select("id", "text", "prompt_name")
    return rel.union_all(docs, targets(spark, folder), chats)


@query(
    "weighted_union",
    """SELECT doc_id AS id, source FROM documents UNION ALL SELECT doc_id, source FROM documents WHERE source = 'src8'
       UNION ALL SELECT doc_id, source FROM documents WHERE source = 'src9'
       UNION ALL SELECT doc_id, source FROM documents WHERE source = 'src9'""",
)
def weighted_union(spark, folder):
    return rel.weighted_union(documents(spark, folder).select("id", "source"), "source", {"src8": 2, "src9": 3})


@query(
    "dedup_key_first",
    """SELECT doc_id AS id, text, source FROM documents
       QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""",
)
def dedup_key_first(spark, folder):
    return rel.dedup_key_first(documents(spark, folder).select("id", "text", "source"), "text", "id")


@query("dedup_rows", "SELECT DISTINCT text, source FROM documents")
def dedup_rows(spark, folder):
    return rel.dedup_rows(documents(spark, folder).select("text", "source"))


@query(
    "append_pseudo_labels",
    f"""WITH {ESSAYS}, {GRADED} SELECT text, generated AS label FROM essays WHERE generated IS NOT NULL
        UNION ALL SELECT e.text, (g.score_a > 0.5)::INTEGER FROM essays e JOIN graded g ON g.id = e.id
        WHERE e.generated IS NULL""",
)
def append_pseudo_labels(spark, folder):
    train = essays(spark, folder)
    guesses = graded_scores(spark, folder).select("id", threshold_label(F.col("score_a")).alias("label"))
    pseudo = rel.bind_scores(train.where("generated IS NULL").select("id", "text"), guesses).select("text", "label")
    known = train.where("generated IS NOT NULL").select("text", F.col("generated").alias("label"))
    return rel.union_all(known, pseudo)


@query(
    "concat_arrays",
    """SELECT doc_id AS id, 'train' AS part, array_to_string(string_split_regex(text, ' +'), '|') AS tokens FROM documents
       UNION ALL SELECT item_id, 'target', array_to_string(string_split_regex(text, ' +'), '|') FROM benchmark""",
)
def concat_arrays(spark, folder):
    """Token lists of two corpora, one after the other."""
    parts = rel.union_all(
        documents(spark, folder).select("id", F.lit("train").alias("part"), F.split("text", " +").alias("tokens")),
        targets(spark, folder).select("id", F.lit("target").alias("part"), F.split("text", " +").alias("tokens")),
    )
    return parts.select("id", "part", F.array_join("tokens", "|").alias("tokens"))
