"""The registered queries of the operators, one each, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.llm import (
    bm25_search,
    hnsw_search,
    html_extraction,
    near_dedup,
    packing,
    prefix_trie,
    quality,
    sentencepiece_bpe,
    sharding,
    substring_dedup,
    token_files,
    toxicity,
    vector_codes,
)
from inkwell.llm.common import table

SHARDS = 24


def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's token ids in sequences of at most 1024, by the configuration program."""
    return packing.pack_documents(table(spark, folder, "documents"))


def op2_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded and decoded with the 32k piece model."""
    out = sentencepiece_bpe.encode_documents(table(spark, folder, "documents"), "piece_bpe_32k.model", full=False)
    return out.select("doc_id", "n_tokens", F.col("ids").alias("ids_sha256"), F.col("decoded").alias("decoded_sha256"))


def op3_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's main text by templates of its host."""
    return html_extraction.extract_pages(table(spark, folder, "pages"))


def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the words of 35-word windows that start anywhere else."""
    out = substring_dedup.remove_repeats(table(spark, folder, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


def op5_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The 10 documents best by BM25 for the whole text of every 20th document."""
    docs = table(spark, folder, "documents")
    out = bm25_search.search(docs, docs.where(F.col("doc_id") % 20 == 0), 10)
    return out.withColumn("score", F.round("score", 6))


#: Scores are rounded before they are ranked, so sums in another order give the same rows.
OP5_SQL = r"""WITH words AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')) AS term
    FROM documents),
  tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
  len AS (SELECT doc_id, count(*) AS dl FROM words GROUP BY doc_id),
  stat AS (SELECT (SELECT count(*) FROM documents) AS n, (SELECT count(*) FROM words) / (SELECT count(*) FROM documents) AS mean),
  idf AS (SELECT term, ln(1 + (n - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM tf, stat GROUP BY term, n),
  scored AS (
    SELECT q.doc_id AS query_id, d.doc_id, round(sum(q.tf * idf * d.tf * 2.2 / (d.tf + 1.2 * (0.25 + 0.75 * dl / mean))), 9) AS score
    FROM tf q JOIN tf d ON q.term = d.term AND q.doc_id <> d.doc_id JOIN idf ON idf.term = q.term JOIN len ON len.doc_id = d.doc_id, stat
    WHERE q.doc_id % 20 = 0 GROUP BY q.doc_id, d.doc_id),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM scored)
  SELECT query_id, rank, doc_id, round(score, 6) AS score FROM ranked WHERE rank <= 10"""


def op6_hnsw(spark: SparkSession, folder: str) -> DataFrame:
    """The 5 vectors nearest to every 50th, by one graph per shard."""
    rows = table(spark, folder, "embeddings")
    return hnsw_search.nearest(rows, rows.where(F.col("vec_id") % 50 == 0), "vec_id", "embedding")


def op7_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's group of near copies."""
    return near_dedup.near_groups(table(spark, folder, "documents"))


def op8_histogram_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Every document in one of 24 shards of near equal bytes."""
    docs = table(spark, folder, "documents")
    rows = docs.select("doc_id", "text", F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"))
    out = sharding.shard_by_bytes(rows, "doc_id", "text", SHARDS)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's toxicity, learned by weak supervision from the rows that are not held out."""
    docs = table(spark, folder, "documents")
    model = toxicity.fit_toxicity(docs, table(spark, folder, "labels"))
    return toxicity.score_toxicity(docs, model).select("doc_id", "held_out", "score", "predicted")


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's quality by the co-trained classifiers."""
    docs = table(spark, folder, "documents")
    model = quality.fit_quality(docs, table(spark, folder, "labels"))
    return quality.score_quality(docs, model).select("doc_id", "score", "predicted")


def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Every usable vector as 16 codes of 64-entry codebooks after two rounds."""
    out = vector_codes.compress(table(spark, folder, "embeddings"))
    return out.select(F.col("id").alias("vec_id"), "code", "error", "label_error", "codebooks_sha256")


def _assigned(book: int) -> str:
    """Distance and index of each part's nearest entry as one number, ties to the lower index."""
    return f"""near{book} AS (SELECT vec_id, p, any_value(v) AS v,
      min((list_inner_product(v, v) - 2 * list_inner_product(v, b.c) + list_inner_product(b.c, b.c)) * 64 + b.e)::BIGINT AS m
    FROM parts JOIN book{book} b USING (p) GROUP BY vec_id, p)"""


def _refitted(book: int) -> str:
    """The entries after a round."""
    return f"""mean{book} AS (SELECT p, e, list(f ORDER BY i) AS c FROM (SELECT p, m % 64 AS e, i, floor(sum(v[i]) / count(*)) AS f
      FROM near{book}, (SELECT unnest(range(1, 1 + (SELECT any_value(len(v)) FROM parts))) AS i) GROUP BY ALL) GROUP BY p, e),
  book{book + 1} AS (SELECT b.p, b.e, coalesce(n.c, b.c) AS c FROM book{book} b LEFT JOIN mean{book} n USING (p, e))"""


OP11_SQL = f"""WITH kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS u FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  parts AS (SELECT vec_id, p, u[p * (len(u) // 16) + 1 : (p + 1) * (len(u) // 16)] AS v FROM kept, (SELECT unnest(range(16)) AS p)),
  first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY e < 64),
  book0 AS (SELECT p, e, v AS c FROM parts JOIN first USING (vec_id)),
  {_assigned(0)}, {_refitted(0)}, {_assigned(1)}, {_refitted(1)}, {_assigned(2)},
  coded AS (SELECT vec_id, string_agg(printf('%02x', m % 64), '' ORDER BY p) AS code, sum(m // 64)::BIGINT AS error FROM near2 GROUP BY vec_id),
  digest AS (SELECT sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256
    FROM (SELECT p, e, unnest(c) AS x, generate_subscripts(c, 1) AS i FROM book2))
  SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
  FROM coded JOIN kept USING (vec_id), digest"""


def op12_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's place and digest in bit-packed files of its token ids, read back from them."""
    return token_files.token_rows(token_files.write_tokens(table(spark, folder, "documents")))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations."""
    return prefix_trie.prefix_trie(table(spark, folder, "conversations")).drop("turn_conv")


#: The checksum table follows from its polynomial; prefixes are lists of turns.
OP13_SQL = r"""WITH own AS (
    SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS s
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
  crc AS (SELECT list(x ORDER BY i) AS t FROM (SELECT i,
      list_reduce([i] || range(8), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS x FROM range(256) r(i))),
  headed AS (SELECT conv_id, s, xor(4294967295, list_reduce([4294967295] || list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
      lambda x, y: xor(x >> 8, t[(xor(x, y) & 255) + 1]))) % 4 AS h FROM own, crc),
  rebuilt AS (SELECT c.conv_id, coalesce(b.s[1:h], []) || c.s[h + 1:] AS s FROM headed c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20),
  members AS (SELECT conv_id, d, s[1:d] AS k, len(s) = d AS ends FROM (SELECT *, unnest(range(len(s) + 1)) AS d FROM rebuilt)),
  nodes AS (SELECT k, d, min(conv_id) AS conv_id, count(*) AS n, coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS ids,
      (count(*) - 1) * coalesce(any_value(len(regexp_extract_all(k[d].text, '[^ 	-
]+'))), 0) AS saved FROM members GROUP BY k, d),
  children AS (SELECT k[1:d - 1] AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
  below AS (SELECT u.k[1:u.a] AS k, sum(saved)::BIGINT AS saved, count(*) FILTER (WHERE c.n IS NULL) AS leaves
    FROM (SELECT *, unnest(range(d + 1)) AS a FROM nodes) u LEFT JOIN children c ON c.k = u.k GROUP BY ALL)
  SELECT v.conv_id, v.d AS depth, up.conv_id AS parent_conv_id, v.n AS n_convs, coalesce(c.n, 0) AS n_children, b.leaves AS n_leaves,
    b.saved AS saved_tokens, sha256(v.ids) AS ends_sha256
  FROM nodes v JOIN below b ON b.k = v.k LEFT JOIN children c ON c.k = v.k LEFT JOIN nodes up ON v.d > 0 AND up.d = v.d - 1 AND up.k = v.k[1:v.d - 1]"""


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_html_extraction": op3_html_extraction,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_exact_topk": op5_exact_topk,
    "op6_hnsw": op6_hnsw,
    "op7_near_dedup": op7_near_dedup,
    "op8_histogram_sharding": op8_histogram_sharding,
    "op9_toxicity": op9_toxicity,
    "op10_quality": op10_quality,
    "op11_vector_codes": op11_vector_codes,
    "op12_token_files": op12_token_files,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLES: dict[str, str] = {"op5_exact_topk": OP5_SQL, "op11_vector_codes": OP11_SQL, "op13_prefix_trie": OP13_SQL}
