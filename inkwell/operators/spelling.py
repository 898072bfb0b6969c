"""Spell repair: unknown words, near dictionary words, one repeated letter error per text."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.functions.text import plain_word_count, token_finder, word_finder
from inkwell.operators.tallies import tally
from inkwell.session import SMALL_MB, broadcast_if_small, cut, is_small

MIN_TOKEN = 3
MAX_SUBSTITUTIONS = 9
WRONG_SHARE = 0.06
FREQUENT_WORDS = 100_000


def deletion_keys(word: Column) -> Column:
    """The word and each form with one character left out."""
    cut_out = lambda i: F.concat(
        F.substr(word, F.lit(1), i - 1), F.substr(word, i + 1, F.length(word))
    )
    shorter = F.transform(F.sequence(F.lit(1), F.length(word)), cut_out)
    return F.array_distinct(F.concat(F.array(word), shorter))


def edit_distance_join(tokens: DataFrame, dictionary: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """``token, word, freq, dist``: dictionary words within one edit of each distinct token.

    ``keys`` are the written deletion keys of the dictionary, if several corpora are compared with it.

    Two words one edit apart share the form that lacks the edited character. A form is
    shared by no more words than there are characters to put back, so no key grows with the
    data. A token that is itself a word keeps that word only.
    """
    left = tokens.select("token").distinct().withColumn("key", F.explode(deletion_keys(F.col("token"))))
    right = dictionary.select("word", "freq", F.explode(deletion_keys(F.col("word"))).alias("key")) if keys is None else keys
    near = left.join(right, "key").select("token", "word", "freq").distinct()
    near = near.withColumn("dist", F.levenshtein("token", "word", 1)).where("dist >= 0")
    exact = dictionary.select(F.col("word").alias("_exact"))
    return near.join(exact, (F.col("token") == F.col("_exact")) & (F.col("dist") == 1), "left_anti")


def substitution(token: Column, word: Column) -> Column:
    """The letter pair ``(from, to)`` in which two words of one length differ at one place."""
    places = F.sequence(F.lit(1), F.length(token))
    at = F.element_at(F.filter(places, lambda i: F.substr(token, i, F.lit(1)) != F.substr(word, i, F.lit(1))), 1)
    pair = F.struct(F.substr(token, at, F.lit(1)).alias("from"), F.substr(word, at, F.lit(1)).alias("to"))
    return F.when((F.length(token) == F.length(word)) & (token != word), pair)


def unknown_tokens(texts: DataFrame, dictionary: DataFrame, small_mb: int = SMALL_MB) -> DataFrame:
    """``id, token, times``: tokens of three characters or more that are no dictionary word.

    The most frequent words, which most occurrences hold, are known where the texts are counted, so that only
    counts of other tokens leave them. A dictionary proved small is broadcast to these; a larger one meets
    them by shuffle after they are added up.
    """
    often = frozenset(r[0] for r in dictionary.orderBy(F.desc("freq"), "word").limit(FREQUENT_WORDS).select("word").collect())
    find = word_finder()

    def seldom(text: str) -> dict[str, int]:
        return {t: n for t, n in Counter(find(text)).items() if len(t) >= MIN_TOKEN and t not in often}

    tokens = tally(texts, seldom).withColumnRenamed("term", "token")
    counted = lambda df: df.groupBy("id", "token").agg(F.sum("n").alias("times"))
    words = dictionary.select(F.col("word").alias("token"))
    if is_small(words, small_mb):
        return counted(tokens.join(F.broadcast(words), "token", "left_anti"))
    return counted(tokens).join(words, "token", "left_anti").select("id", "token", "times")


def dictionary_keys(dictionary: DataFrame) -> DataFrame:
    """``key, word, freq``: the deletion keys of the dictionary, written once for all texts it is used on."""
    return cut(dictionary.select("word", "freq", F.explode(deletion_keys(F.col("word"))).alias("key")))


def substitution_argmax(unknown: DataFrame, near: DataFrame) -> DataFrame:
    """``id, from, to, n``: the most frequent letter pair of each text, the smallest on a tie."""
    changed = near.where("dist = 1").withColumn("pair", substitution(F.col("token"), F.col("word")))
    per_token = changed.where("pair IS NOT NULL").groupBy("token", "pair").agg(F.count("*").alias("words"))
    counts = unknown.join(per_token, "token").groupBy("id", "pair").agg(F.sum(F.col("times") * F.col("words")).alias("n"))
    best = counts.groupBy("id").agg(F.min(F.struct((-F.col("n")).alias("low"), "pair")).alias("best"))
    return best.select("id", "best.pair.from", "best.pair.to", (-F.col("best.low")).alias("n"))


def weighted_edit_join(wanted: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Words that differ from a token by one letter pair only, at one to nine places.

    ``wanted`` holds distinct ``token, from, to``. With every ``from`` turned into ``to``
    both sides become equal, which is the join key; the places are then compared. Only words
    that hold the letter ``to`` of a pair in use can match it.
    """
    tokens = wanted.select("token", "from", "to").distinct().where(F.contains("token", F.col("from")))
    pairs = tokens.select("from", "to").distinct()
    spelled = dictionary.withColumn("to", F.explode(F.array_distinct(F.split("word", ""))))
    words = spelled.join(broadcast_if_small(pairs), "to")
    words = words.withColumn("key", F.replace("word", F.col("from"), F.col("to")))
    keyed = tokens.withColumn("key", F.replace("token", F.col("from"), F.col("to")))
    met = keyed.join(words, ["from", "to", "key"])
    same = F.zip_with(
        F.split("token", ""), F.split("word", ""),
        lambda x, y: F.when(x == y, 0).when((x == F.col("from")) & (y == F.col("to")), 1).otherwise(MAX_SUBSTITUTIONS + 1),
    )
    changes = F.aggregate(same, F.lit(0), lambda acc, x: acc + x)
    kept = met.where(F.length("token") == F.length("word")).withColumn("changes", changes)
    return kept.where(F.col("changes").between(1, MAX_SUBSTITUTIONS)).select("token", "from", "to", "word", "freq", "changes")


def _first_word() -> Column:
    """The most frequent word, the first in the alphabet on a tie."""
    return F.min(F.struct((-F.col("freq")).alias("low"), "word"))["word"].alias("word")


def corrections(texts: DataFrame, dictionary: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """``id, token, word`` for every token of a text that is to be replaced.

    The unknown tokens, their neighbours and the tokens that are looked up again are written once, as several later
    steps use them.
    """
    unknown = cut(unknown_tokens(texts, dictionary))
    near = cut(edit_distance_join(unknown, dictionary, keys))
    first = near.groupBy("token").agg(_first_word())
    wrong = unknown.join(first, "token")
    lengths = texts.select("id", plain_word_count(F.col("text")).alias("n_words"))
    main = substitution_argmax(unknown, near).join(lengths, "id").where(F.col("n") > WRONG_SHARE * F.col("n_words"))
    again = cut(wrong.select("id", "token").join(main.select("id", "from", "to"), "id"))
    found = weighted_edit_join(again, dictionary).groupBy("token", "from", "to").agg(_first_word())
    better = again.join(found, ["token", "from", "to"]).select("id", "token", F.col("word").alias("better"))
    return wrong.join(better, ["id", "token"], "left").select("id", "token", F.coalesce("better", "word").alias("word"))


def put_together(find: Callable[[str], list[str]]):
    """A column function: the tokens of a text in their order, those in its second argument as the third has them."""

    @F.pandas_udf("string")
    def repaired(texts: pd.Series, wrong: pd.Series, right: pd.Series) -> pd.Series:
        out = []
        for text, before, after in zip(texts, wrong, right):
            if text is None:
                out.append(None)
                continue
            fixes = {} if before is None else dict(zip(before, after))
            out.append("".join([fixes.get(t, t) for t in find(text)]))
        return pd.Series(out, dtype=object)

    return repaired


def spell_repair(texts: DataFrame, dictionary: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """``texts`` with repaired text: known tokens stay, wrong ones are replaced.

    Only wrong tokens are shuffled. They come back as one list of pairs per text, and each
    text is put together again inside its row, every token by one look-up.
    """
    fixes = corrections(texts, dictionary, keys)
    per_text = fixes.groupBy("id").agg(F.collect_set(F.struct("token", "word")).alias("_fixes"))
    joined = texts.join(per_text, "id", "left")
    text = put_together(token_finder())("text", "_fixes.token", "_fixes.word")
    return joined.select(*[text.alias("text") if c == "text" else F.col(c) for c in texts.columns])
