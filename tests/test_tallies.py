"""Words and counts made by Python are those of Spark's patterns; spell repair looks a token up by one step."""

import random

from pyspark.sql import functions as F

from inkwell.functions import text as tx
from inkwell.operators import features as fx
from inkwell.operators import spelling
from inkwell.operators.relational import dedup_key_first, first_orders
from inkwell.operators.tallies import tally, totals

ODD = [
    "Plain words, and_more. 3rd\tline\n", "", " ", "naïve ünïcode — „quoted“ wörter", "a\0b\0\0c, d.\0", "𝒳𝒴 astral 𝟘 ١٢ ½ ² é",
    "\x1c\x85\xa0 x", None, "".join(chr(33 + i % 7000) for i in range(0, 9000, 3)),
]


def table(spark):
    draw = random.Random(5)
    more = ["".join(chr(draw.choice([draw.randrange(32, 127), draw.randrange(0xA0, 0xD800), draw.randrange(0x10000, 0x20000)])) for _ in range(60)) for _ in range(200)]
    return spark.createDataFrame(list(enumerate(ODD + more)), "id bigint, text string")


def test_python_finds_the_tokens_of_the_pattern(spark):
    words, tokens = tx.word_finder(), tx.token_finder()
    for r in table(spark).select("text", tx.regex_tokens(F.col("text")).alias("t"), tx.word_count(F.col("text")).alias("n"), tx.plain_word_count(F.col("text")).alias("own")).collect():
        assert r.n == r.own
        if r.text is not None:
            assert [t for t in tokens(r.text) if t] == r.t
            assert words(r.text) == [t for t in r.t if t not in ".," + tx.SPACE_CHARS]


def test_counts_of_texts(spark):
    df = spark.createDataFrame([(1, "a b a"), (None, "b"), (1, "a"), (2, None), (3, "")], "id bigint, text string")
    each = sorted((r.id or 0, r.term, r.n) for r in tally(df, lambda t: {w: t.split().count(w) for w in t.split()}).collect())
    assert each == [(0, "b", 1), (1, "a", 1), (1, "a", 2), (1, "b", 1)]
    summed = totals(df, str.split).groupBy("term").agg(F.sum("n").alias("n")).collect()
    assert {r.term: r.n for r in summed} == {"a": 3, "b": 2}


def test_repair_searches_no_map_and_reads_no_pattern(spark):
    dictionary = spark.createDataFrame([("hand", 4), ("sand", 3), ("the", 9)], "word string, freq bigint")
    df = spark.createDataFrame([(1, "the hend, send"), (1, "the hend, send"), (None, "hend"), (2, None)], "id bigint, text string")
    fixed = spelling.spell_repair(df, dictionary)
    assert sorted((r.id or 0, r.text) for r in fixed.where("text IS NOT NULL").collect()) == [(0, "hend"), (1, "the hand, sand"), (1, "the hand, sand")]
    assert fixed.where("id = 2").first().text is None
    plan = fixed._jdf.queryExecution().optimizedPlan().toString()
    assert "element_at" not in plan and "regexp_extract_all" not in plan


def test_near_words_are_compared_once(spark):
    dictionary = spark.createDataFrame([("hand", 4), ("sand", 3), ("send", 9)], "word string, freq bigint")
    tokens = spark.createDataFrame([("send",), ("hend",), ("zzz",)], "token string")
    near = spelling.edit_distance_join(tokens, dictionary)
    assert sorted(map(tuple, near.collect())) == [("hend", "hand", 4, 1), ("hend", "send", 9, 1), ("send", "send", 9, 0)]
    assert near._jdf.queryExecution().optimizedPlan().toString().count("levenshtein") <= 2


def test_ngrams_of_a_small_vocabulary_are_counted_where_the_texts_lie(spark):
    texts = table(spark).unionByName(spark.createDataFrame([(0, "x y z x y z x"), (0, "x y z"), (None, "x y z w"), (9999, "x  y\tz\nw")], "id bigint, text string"))
    goal = spark.createDataFrame([(1, "x y z x"), (2, "y z w"), (3, "and_more. 3rd line"), (4, None)], "id bigint, text string")
    words = tx.words(F.col("text"))

    def rows(**more):
        return [sorted((str(r.id), r.term, round(r.weight, 9)) for r in part.collect()) for part in fx.tfidf_pair(texts, goal, words, 2, 3, **more)]

    assert rows(split=str.split) == rows() == rows(split=str.split, known_mb=-1)
    vocab = fx.vocab_table(fx.grams(goal, words, 2, 3))
    plan = fx.known_counts(texts, str.split, 2, 3, vocab)._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" not in plan and "regexp_extract_all" not in plan


def test_the_ids_of_first_rows_need_no_text(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, None), (5, None), (4, ""), (None, "b"), (7, "c"), (None, "c")], "id bigint, text string")
    ids = first_orders(df, "text", "id")
    assert sorted(str(r.id) for r in ids.collect()) == sorted(str(r.id) for r in dedup_key_first(df, "text", "id").collect())
    assert "min_by" not in ids._jdf.queryExecution().optimizedPlan().toString()
