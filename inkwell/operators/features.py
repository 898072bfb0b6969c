"""N-gram TF-IDF in long form ``(id, term, weight)``, scaling, cosine top-k.

No document-term matrix is built: counts, idf and norms are aggregates over rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.functions.arrays import token_ngrams
from inkwell.operators.relational import join_frequent
from inkwell.operators.tallies import tally
from inkwell.session import SMALL_MB, cut, hold, is_small, row_bytes

SALTS = 16
FREQUENT = 1_000
FILTER_WORDS = 1 << 20
FILTER_TERMS = 8
FILTER_HASHES = 4
SLACK = 1e-8
KNOWN_MB = 16


def grams(df: DataFrame, tokens: Column, low: int, high: int, key: str = "id") -> DataFrame:
    """``id, term``: one row per n-gram occurrence."""
    return df.select(key, F.explode(token_ngrams(tokens, low, high)).alias("term"))


def vocab_table(terms: DataFrame, min_df: int = 1) -> DataFrame:
    """``term``: distinct terms, optionally only those in at least ``min_df`` documents."""
    if min_df <= 1:
        return terms.select("term").distinct()
    pairs = terms.distinct()
    return pairs.groupBy("term").agg(F.count("*").alias("_df")).where(F.col("_df") >= min_df).select("term")


def _filter_bits(words: int) -> tuple[Column, Column]:
    """A term's word in the filter and its bits there."""
    place = F.xxhash64("term").bitwiseAND(F.lit(words - 1))
    other = F.xxhash64("term", F.lit(1))
    one = F.lit(1).cast("bigint")
    bits = [F.call_function("shiftleft", one, F.shiftright(other, 6 * k).bitwiseAND(F.lit(63)).cast("int")) for k in range(FILTER_HASHES)]
    return place, reduce(Column.bitwiseOR, bits)


def vocab_filter(vocab: DataFrame) -> tuple[DataFrame, int]:
    """A Bloom filter of a written vocabulary, ``_word, _bits``, and its number of words.

    All bits of a term lie in one 64-bit word, so a lookup is one equality. The words are put together
    by a partial aggregate and are at most ``FILTER_WORDS`` whatever the vocabulary, about eight bits a
    term up to eight million terms; a larger vocabulary lets more strangers through, never fewer members.
    """
    wanted = max(1, vocab.count() // FILTER_TERMS)
    words = min(FILTER_WORDS, 1 << (wanted - 1).bit_length())
    place, bits = _filter_bits(words)
    return cut(vocab.select(place.alias("_word"), bits.alias("_own")).groupBy("_word").agg(F.bit_or("_own").alias("_bits"))), words


def pass_filter(terms: DataFrame, vocab: DataFrame) -> DataFrame:
    """The occurrences whose term may be in the vocabulary: all that are, and a few more. Nothing is shuffled."""
    found, words = vocab_filter(vocab)
    place, bits = _filter_bits(words)
    marked = terms.withColumn("_place", place).withColumn("_own", bits)
    known = (F.col("_place") == F.col("_word")) & (F.col("_bits").bitwiseAND(F.col("_own")) == F.col("_own"))
    return marked.join(F.broadcast(found), known, "left_semi").drop("_place", "_own")


def vocab_restrict(terms: DataFrame, vocab: DataFrame, small_mb: int = SMALL_MB) -> DataFrame:
    """Keep the occurrences of terms of ``vocab``, a written table.

    A vocabulary proved small is broadcast, so the filter runs inside the scan of the texts. For a
    larger one a filter of bounded size does the same, and what gets through it is joined by shuffle.
    """
    if is_small(vocab, small_mb):
        return terms.join(F.broadcast(vocab), "term", "left_semi")
    return pass_filter(terms, vocab).join(vocab, "term", "left_semi")


def term_counts(terms: DataFrame, key: str = "id", vocab: DataFrame | None = None, small_mb: int = SMALL_MB) -> DataFrame:
    """``id, term, tf``, restricted to ``vocab``, a written table, if one is given.

    Beyond a small vocabulary, equal terms of a document that pass the filter are counted before the exact join.
    """
    if vocab is None:
        return terms.groupBy(key, "term").agg(F.count("*").alias("tf"))
    if is_small(vocab, small_mb):
        return term_counts(terms.join(F.broadcast(vocab), "term", "left_semi"), key)
    return term_counts(pass_filter(terms, vocab), key).join(vocab, "term", "left_semi").select(key, "term", "tf")


def text_counts(texts: DataFrame, tokens: Column, key: str = "id") -> DataFrame:
    """``id, term, tf`` of the tokens of each text.

    The texts are dealt by id before they are cut into tokens, so that only texts move: what is made of the counts per id,
    as a norm or a join with rows of the same ids, finds them in one partition.
    """
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return term_counts(texts.repartition(parts, key).select(key, F.explode(tokens).alias("term")), key)


def idf_table(counts: DataFrame, n_docs: Column, vocab: DataFrame | None = None) -> DataFrame:
    """``term, idf, df`` with idf = ln((1 + n) / (1 + df)) + 1.

    ``counts`` holds each document and term once. A vocabulary term that occurs in no
    document gets df 0.
    """
    df = counts.groupBy("term").agg(F.count("*").alias("df"))
    if vocab is not None:
        df = vocab.join(df, "term", "left").na.fill(0, ["df"])
    return df.select("term", (F.log((n_docs + 1) / (F.col("df") + 1)) + 1).alias("idf"), "df")


def weigh(counts: DataFrame, idf: DataFrame, sublinear: bool, key: str = "id", small_mb: int = SMALL_MB) -> DataFrame:
    """``id, term, weight``: tf times idf, a written table, each document scaled to length 1.

    Beyond a small table of idf, terms of many documents are broadcast and only the others are shuffled.
    """
    tf = F.log("tf") + 1 if sublinear else F.col("tf").cast("double")
    if is_small(idf, small_mb) or "df" not in idf.columns:
        met = counts.join(F.broadcast(idf) if is_small(idf, small_mb) else idf, "term")
    else:
        met = join_frequent(counts, idf, ["term"], "df")
    raw = met.withColumn("_raw", tf * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("_raw") * F.col("_raw")).over(Window.partitionBy(key)))
    return raw.select(key, "term", (F.col("_raw") / norm).alias("weight"))


def known_counts(
    texts: DataFrame, split: Callable[[str], list[str]], low: int, high: int, vocab: DataFrame, key: str = "id"
) -> DataFrame:
    """``id, term, tf`` of the n-grams of ``vocab``, a written table proved small, in each text.

    The vocabulary goes to the texts, so that an n-gram outside it is never a row; ``split`` gives the tokens of a text.
    """
    known = frozenset(vocab.toArrow().column("term").to_pylist())

    def count(text: str) -> dict[str, int]:
        tokens, found = split(text), {}
        for n in range(low, high + 1):
            for term in filter(known.__contains__, map(" ".join, zip(*[tokens[i:] for i in range(n)]))):
                found[term] = found.get(term, 0) + 1
        return found

    return tally(texts, count, key).groupBy(key, "term").agg(F.sum("n").alias("tf"))


def tfidf_pair(
    train: DataFrame,
    target: DataFrame,
    tokens: Column,
    low: int,
    high: int,
    vocab_from: DataFrame | None = None,
    min_df: int = 1,
    key: str = "id",
    split: Callable[[str], list[str]] | None = None,
    known_mb: int = KNOWN_MB,
) -> tuple[DataFrame, DataFrame]:
    """Weights of ``train`` and ``target``; vocabulary from the target side, idf from train.

    ``vocab_from`` is the table the vocabulary is taken from, ``target`` by default. The
    counts that are left after the restriction are written once, so the n-grams of the
    training texts are made in one pass. If ``split`` gives the same ``tokens`` of a row's ``text`` in Python
    and the vocabulary takes at most ``known_mb``, they are counted there.
    """
    source = target if vocab_from is None else vocab_from
    vocab = cut(vocab_table(grams(source, tokens, low, high, key), min_df))
    n_docs = train.agg(F.count("*")).scalar()
    if split is not None and is_small(vocab, known_mb):
        counts = lambda df: known_counts(df, split, low, high, vocab, key)
    else:
        counts = lambda df: term_counts(grams(df, tokens, low, high, key), key, vocab)
    train_counts, target_counts = cut(counts(train)), cut(counts(target))
    idf = cut(idf_table(train_counts, n_docs, vocab))
    return weigh(train_counts, idf, True, key), weigh(target_counts, idf, True, key)


def tfidf_words(
    train: DataFrame, words: Column, other: DataFrame | None = None, key: str = "id", dealt: bool = True
) -> tuple[DataFrame, DataFrame | None]:
    """Word TF-IDF with raw counts; vocabulary and idf both from ``train``.

    Texts are ``dealt`` by id before they are counted. Without that their words are, and rows come in another order, on
    which the row samples of Spark's trees depend.
    """
    counts = cut(text_counts(train, words, key) if dealt else term_counts(train.select(key, F.explode(words).alias("term")), key))
    idf = cut(idf_table(counts, train.agg(F.count("*")).scalar()))
    weights = weigh(counts, idf, False, key)
    if other is None:
        return weights, None
    other_counts = term_counts(other.select(key, F.explode(words).alias("term")), key)
    return weights, weigh(other_counts, idf, False, key)


def max_abs_scale(train: DataFrame, *others: DataFrame, small_mb: int = SMALL_MB) -> list[DataFrame]:
    """Divide each feature by its largest absolute weight in ``train``.

    A feature that never occurs in ``train`` keeps its weight. The largest weights are written before
    their size is tested; beyond a small table, terms of many documents are broadcast.
    """
    top = cut(train.groupBy("term").agg(F.max(F.abs("weight")).alias("_top"), F.count("*").alias("_times")))
    small = is_small(top, small_mb)
    scale = F.coalesce(F.when(F.col("_top") > 0, F.col("_top")), F.lit(1.0))
    met = lambda df: df.join(F.broadcast(top), "term", "left") if small else join_frequent(df, top, ["term"], "_times", "left")
    return [met(df).withColumn("weight", F.col("weight") / scale).drop("_top", "_times") for df in (train, *others)]


def cosine_scores(queries: DataFrame, docs: DataFrame, key: str = "id") -> DataFrame:
    """``query_id, id, sim`` of all pairs that share a term; both sides have unit rows.

    Query postings proved small are broadcast: a document's postings then meet them inside
    one task and products are added up before the shuffle. Otherwise both sides are
    shuffled by term, with terms of many documents cut into slices of documents. Sums are rounded to nine
    places, so equal texts tie whatever order their products were added in.
    """
    q = queries.select(F.col(key).alias("query_id"), "term", F.col("weight").alias("_q"))
    d = docs.select(key, "term", F.col("weight").alias("_d"))
    if is_small(q):
        pairs = d.join(F.broadcast(q), "term")
    else:
        times = cut(d.groupBy("term").agg(F.count("*").alias("_times")))
        often = cut(times.orderBy(F.desc("_times")).limit(FREQUENT).select("term", F.lit(True).alias("_often")))
        sliced = d.join(F.broadcast(often), "term", "left").withColumn(
            "_slice", F.when(F.col("_often"), F.pmod(F.xxhash64(key), F.lit(SALTS))).otherwise(F.lit(0).cast("bigint"))
        )
        every = F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))
        copies = q.join(F.broadcast(often), "term", "left")
        copies = copies.withColumn("_slice", F.explode(F.when(F.col("_often"), every).otherwise(F.array(F.lit(0).cast("bigint")))))
        pairs = sliced.drop("_often").join(copies.drop("_often"), ["term", "_slice"])
    return pairs.groupBy("query_id", key).agg(F.round(F.sum(F.col("_q") * F.col("_d")), 9).alias("sim"))


def _best_of(scored: DataFrame, k: int, key: str) -> DataFrame:
    """``query_id, id, sim, rank``: the ``k`` best of every query; each task hands on ``k`` rows of a query at most."""
    order = Window.partitionBy("query_id").orderBy(F.desc("sim"), key)
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def bounded_terms(queries: DataFrame, docs: DataFrame) -> DataFrame:
    """``query_id, term, _q, _up, _rest``: the most a term can add to a similarity, and the most that it and all
    lesser terms of its query can add together."""
    top = docs.groupBy("term").agg(F.max("_d").alias("_top"))
    met = queries.join(top, "term").withColumn("_up", F.col("_q") * F.col("_top"))
    lesser = Window.partitionBy("query_id").orderBy("_up", "term").rowsBetween(Window.unboundedPreceding, 0)
    return met.withColumn("_rest", F.sum("_up").over(lesser)).select("query_id", "term", "_q", "_up", "_rest")


def similar_pairs(terms: DataFrame, docs: DataFrame, k: int, key: str = "id") -> DataFrame:
    """``query_id, id, sim, rank``: the ``k`` most similar documents of every query that share a term with it.

    ``terms`` are queries with bounds, small enough to broadcast; ``docs`` (key, ``term, _d``) lie whole in one
    partition each, so products are added up there. First the strong terms of a query, which hold half of
    its bound, give ``k`` documents and with them a similarity that the ``k`` best reach. A document that
    holds only terms which together stay below it cannot be among them, so candidates are looked
    for by the other terms only, kept if what they may still gain is enough, and then scored in full.
    """
    whole = terms.groupBy("query_id").agg(F.max("_rest").alias("_whole"))
    strong = terms.join(whole, "query_id").where(2 * F.col("_rest") > F.col("_whole")).select("query_id", "term", "_q")
    add_up = lambda met: met.groupBy("query_id", key).agg(F.round(F.sum(F.col("_q") * F.col("_d")), 9).alias("sim"))
    sure = _best_of(add_up(docs.join(F.broadcast(strong), "term")), k, key).where(F.col("rank") == k)
    floor = cut(whole.join(sure.select("query_id", F.col("sim").alias("_floor")), "query_id", "left").na.fill(0.0, ["_floor"]))
    bounded = cut(terms.join(floor, "query_id").withColumn("_needed", F.col("_rest") >= F.col("_floor") - SLACK))
    needed = bounded.where("_needed").select("query_id", "term", "_q")
    left = bounded.where("NOT _needed").groupBy("query_id").agg(F.max("_rest").alias("_left"))
    reach = floor.join(left, "query_id", "left").select("query_id", (F.col("_floor") - F.coalesce("_left", F.lit(0.0)) - SLACK).alias("_least"))
    found = add_up(docs.join(F.broadcast(needed), "term")).join(F.broadcast(reach), "query_id").where(F.col("sim") >= F.col("_least"))
    met = docs.join(found.select("query_id", key), key).join(F.broadcast(bounded.select("query_id", "term", "_q")), ["query_id", "term"])
    return _best_of(add_up(met), k, key)


def topk_cosine_join(
    query_ids: DataFrame, queries: DataFrame, docs: DataFrame, doc_ids: DataFrame, k: int, key: str = "id", block_bytes: int = SMALL_MB << 20
) -> DataFrame:
    """``query_id, id, sim, rank``: the ``k`` most similar documents of every query.

    Queries are taken in blocks that fit a broadcast; the documents' weights are dealt by document once.
    Ties go to the smaller id. A query with fewer than ``k`` similar documents is filled up
    with the smallest ids it is not similar to, at similarity 0. As a query short of ``k``
    has fewer than ``k`` partners, its fill lies within the ``2k`` smallest ids.
    """
    spark = docs.sparkSession
    q = cut(queries.select(F.col(key).alias("query_id"), "term", F.col("weight").alias("_q")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = terms_asked(docs.select(key, "term", F.col("weight").alias("_d")), q)
    held = hold(cut(wanted), parts, key)
    terms = cut(bounded_terms(q, held))
    blocks = max(1, -(-(terms.agg(F.sum(row_bytes(terms))).first()[0] or 0) // block_bytes))
    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks))
    best = reduce(DataFrame.unionByName, [cut(similar_pairs(terms.where(block == b), held, k, key)) for b in range(blocks)])
    held.unpersist()
    found = best.groupBy("query_id").agg(F.count("*").alias("_found"))
    short = query_ids.select(F.col(key).alias("query_id")).join(found, "query_id", "left").na.fill(0, ["_found"])
    short = short.where(F.col("_found") < k)
    first_ids = [r[0] for r in doc_ids.select(key).orderBy(key).limit(2 * k).collect()]
    if not first_ids:
        return best
    dtype = dict(doc_ids.dtypes)[key]
    fill = short.withColumn(key, F.explode(F.array(*[F.lit(i).cast(dtype) for i in first_ids])))
    fill = fill.join(best.select("query_id", key), ["query_id", key], "left_anti")
    nth = F.row_number().over(Window.partitionBy("query_id").orderBy(key))
    fill = fill.withColumn("_nth", nth).where(F.col("_nth") <= k - F.col("_found"))
    filled = fill.select("query_id", key, F.lit(0.0).alias("sim"), (F.col("_found") + F.col("_nth")).alias("rank"))
    return best.select("query_id", key, "sim", F.col("rank").cast("bigint")).unionByName(filled)


def terms_asked(docs: DataFrame, queries: DataFrame) -> DataFrame:
    """The documents' weights of terms that some query holds."""
    return vocab_restrict(docs, cut(queries.select("term").distinct()))
