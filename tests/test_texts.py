"""Subwords, spelling, similarity and learners against brute force; file readers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkwell.functions import text as tx
from inkwell.operators import features as fx
from inkwell.operators import learners as ln
from inkwell.operators import spelling
from inkwell.operators import subword as sw
from inkwell.sources import readers, sinks

TEXTS = [
    "the thin thing thinks the thought", "then there they them, théâtre naïve ﬁne", "aaaa aaa aa a baaab", "", " leading blank\n\nand lines",
    "ünder über über grüße 😀😀 tail", "the the the the other",
]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id bigint, text string")


def merge_once(symbols, pair):
    """Join every place of a pair, from left to right."""
    out = []
    for symbol in symbols:
        if out and (out[-1], symbol) == pair and not getattr(out[-1], "joined", False):
            out[-1] = Joined(out[-1] + symbol)
        else:
            out.append(symbol)
    return [str(s) for s in out]


class Joined(str):
    """A symbol made in this pass, which takes no further part in it."""

    joined = True


def one_at_a_time(pieces, wanted):
    merges = []
    for _ in range(wanted):
        counts = {}
        for symbols, n in pieces:
            for pair in zip(symbols, symbols[1:]):
                counts[pair] = counts.get(pair, 0) + n
        if not counts:
            break
        best = min(counts, key=lambda p: (-counts[p], len(p[0] + p[1]), p))
        merges.append(best)
        pieces = [(merge_once(symbols, best), n) for symbols, n in pieces]
    return merges


def test_rounds_of_merges_equal_one_at_a_time(spark, texts):
    pieces = texts.select(F.explode(sw.byte_level_pretokenize(F.col("text"))).alias("p")).groupBy("p").count().collect()
    letters = {c for r in pieces for c in r["p"]}
    model = sw.bpe_train(texts, len(sw.SPECIAL_TOKENS) + len(letters) + 25, one_task_bytes=0)
    assert model == sw.bpe_train(texts, len(sw.SPECIAL_TOKENS) + len(letters) + 25)
    assert model.merges == one_at_a_time([(list(r["p"]), r["count"]) for r in pieces], len(model.merges))
    assert len(model.vocab) == len(sw.SPECIAL_TOKENS) + len(letters) + 25
    encoded = sw.bpe_encode(texts, model).select("text", "tokens", "ids", sw.bpe_decode(F.col("tokens")).alias("back"))
    for r in encoded.collect():
        assert r.back in (r.text, " " + r.text)
        assert [model.vocab[i] for i in r.ids] == r.tokens


def test_word_pieces_join_to_the_words(spark, texts):
    vocab = sw.wordpiece_train(texts, 80)
    assert [r.token for r in vocab.orderBy("token_id").limit(2).collect()] == sw.WORDPIECE_RESERVED
    for r in sw.wordpiece_encode(texts, vocab).collect():
        assert "[UNK]" not in r.tokens
        assert "".join(t.removeprefix("##") for t in r.tokens) == "".join(r.text.split())
    assert sw.longest_match("xyz", {"x": 0}, "[UNK]") == ["[UNK]"]


def test_python_and_spark_agree_on_white_space(spark):
    import sys

    spaces = [chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()]
    assert sorted(tx.SPACE_CHARS) == sorted(spaces)
    df = spark.createDataFrame([("".join(f"a{s}" for s in spaces),)], "text string")
    assert df.select(tx.word_count(F.col("text"))).first()[0] == len(spaces)


def test_one_repeated_letter_error_is_undone(spark):
    dictionary = spark.createDataFrame(
        [(w, f) for f, w in enumerate("banana cebenes bend panama cabana hand sand land and the was".split(), 1)], "word string, freq bigint"
    )
    df = spark.createDataFrame([(1, "the cebene was hend, send lend benene"), (2, "xx the qqqqq!"), (3, "")], "id bigint, text string")
    # a word with no neighbour at one edit, like the last one, is never looked up again
    fixed = {r.id: r.text for r in spelling.spell_repair(df, dictionary).collect()}
    assert fixed == {1: "the cabana was hand, sand land benene", 2: "xx the qqqqq", 3: ""}


def test_similarity_fill_and_the_large_path(spark, texts, monkeypatch):
    queries = spark.createDataFrame([(100, "the thin thing other"), (101, "nothing shared here")], "id bigint, text string")
    words = tx.words(F.col("text"))

    def run():
        docs, goal = fx.tfidf_pair(texts, queries, words, 1, 2)
        return sorted(tuple(r) for r in fx.topk_cosine_join(queries, goal, docs, texts, 3).collect())

    small = run()
    assert [r[:2] + r[3:] for r in small if r[0] == 101] == [(101, 0, 1), (101, 1, 2), (101, 2, 3)]
    assert all(0 <= r[2] <= 1 for r in small)
    monkeypatch.setattr(fx, "is_small", lambda df, *a: False)
    assert run() == small


@pytest.fixture(scope="module")
def matrix(spark):
    rng = np.random.default_rng(7)
    x = rng.random((30, 8)) * (rng.random((30, 8)) < 0.5)
    x[3] = 0
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    y = (x[:, 0] + 0.3 * rng.random(30) > 0.35).astype(int)
    cells = [(i, f"t{j}", float(x[i, j])) for i in range(30) for j in range(8) if x[i, j]]
    weights = spark.createDataFrame(cells, "id bigint, term string, weight double")
    labels = spark.createDataFrame([(i, int(v)) for i, v in enumerate(y)], "id bigint, label int")
    return x, y, weights, labels


def test_ridge_equals_the_closed_form(spark, matrix):
    x, y, weights, labels = matrix
    model = ln.ridge_fit(weights, labels, 1.0, tol=1e-8)
    centred = x - x.mean(0)
    coef = np.linalg.solve(centred.T @ centred + np.eye(8), centred.T @ (y - y.mean()))
    got = {r.term: r.coef for r in model.coefficients.collect()}
    assert np.allclose([got.get(f"t{j}", 0.0) for j in range(8)], coef, atol=1e-6)
    assert abs(model.intercept - (y.mean() - x.mean(0) @ coef)) < 1e-6


def test_margin_learner_reaches_a_flat_point(spark, matrix):
    x, y, weights, labels = matrix
    model = ln.modified_huber_fit(weights, labels, l2=0.05)
    coef = np.zeros(8)
    for r in model.coefficients.collect():
        coef[int(r.term[1:])] = r.coef
    sign = 2 * y - 1
    margin = sign * (x @ coef + model.intercept)
    slope = sign * np.where(margin >= 1, 0, np.where(margin >= -1, -2 * (1 - margin), -4))
    assert np.abs(x.T @ slope / 30 + 0.05 * coef).max() < 0.02
    assert abs(slope.mean()) < 0.02


def test_csv_with_line_breaks_and_quotes(spark, tmp_path):
    path = tmp_path / "prompts.csv"
    path.write_text('prompt_id,prompt_name\n0,"Car-free\ncities ""now"""\n1,plain\n')
    rows = readers.read_csv(spark, str(path), "prompt_id INT, prompt_name STRING").orderBy("prompt_id").collect()
    assert [tuple(r) for r in rows] == [(0, 'Car-free\ncities "now"'), (1, "plain")]


def test_labelled_folders(spark, tmp_path):
    for name, text in (("pos/a.txt", "good\nfilm"), ("neg/b.txt", "bad"), ("unsup/c.txt", "?")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    got = readers.read_labelled_folders(spark, str(tmp_path), exclude=["unsup"])
    assert sorted((r.class_name, r.text, r.label) for r in got.collect()) == [("neg", "bad", 0), ("pos", "good\nfilm", 1)]
    assert readers.list_files(spark, str(tmp_path), "*.txt").count() == 3


def test_fallback_only_for_small_tables(spark):
    ids = spark.createDataFrame([(1,), (2,)], "id bigint")
    scores = ids.withColumn("generated", F.lit(0.3))
    assert {r.generated for r in sinks.constant_fallback(scores, ids, 1.0, 3).collect()} == {1.0}
    assert {r.generated for r in sinks.constant_fallback(scores, ids, 1.0, 2).collect()} == {0.3}


def test_encoders_are_fast_on_long_pieces():
    import random
    import time

    from inkwell.operators.subword import longest_match, merge_by_rank

    rng = random.Random(1)
    letters = "abcdefgh"
    ranks = {(a, b): i for i, (a, b) in enumerate((a, b) for a in letters for b in letters)}
    word = "".join(rng.choice(letters) for _ in range(100_000))
    began = time.perf_counter()
    assert "".join(merge_by_rank(list(word), ranks)) == word
    assert longest_match(word, dict.fromkeys([*letters, *("##" + c for c in letters)], 0), "[UNK]")[0] == word[0]
    assert time.perf_counter() - began < 3


def test_merges_are_those_of_one_pass_per_merge():
    import random

    from inkwell.operators.subword import merge_by_rank

    rng = random.Random(2)
    parts = ["a", "b", "c", "ab", "bc", "abc", "ca", "aa"]
    for _ in range(300):
        pairs = [(a, b) for a in parts for b in parts if rng.random() < 0.5]
        ranks = {pair: i for i, pair in enumerate(pairs)}
        symbols = [rng.choice("abc") for _ in range(rng.randrange(1, 14))]
        want = list(symbols)
        while len(want) > 1:
            best = min(zip(want, want[1:]), key=lambda pair: ranks.get(pair, len(ranks)))
            if best not in ranks:
                break
            want = merge_once(want, best)
        assert merge_by_rank(symbols, ranks) == want


def test_ngrams_are_summed_up_where_their_text_lies(spark, tmp_path):
    import hashlib
    import re

    from inkwell.checks.texts import token_ngrams

    rows = [(1, "a b c d e f"), (2, "x y\tz x y z x"), (2, "x y z q"), (2, "x y z q"), (3, "one two"), (4, None), (None, "a b c"), (None, "b c d a b c")]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in rows]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    grams = {}
    for i, text, *_ in rows:
        words = (text or "").split()
        grams.setdefault(i, []).extend(" ".join(words[p : p + n]) for n in (3, 4, 5) for p in range(len(words) - n + 1))
    wanted = {i: (len(g), len(set(g)), sum(int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in g)) for i, g in grams.items() if g}
    found = token_ngrams(spark, str(tmp_path))
    assert {r["id"]: (r["n"], r["terms"], r["digest"]) for r in found.collect()} == wanted
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(id#\w+, term", plan)


def test_words_are_those_of_the_plain_classes(spark):
    odd = "".join(map(chr, [*range(0x300), *range(0x1670, 0x1690), *range(0x1FF0, 0x2070), 0x3000, 0x3001, 0x1F600, *range(0x660, 0x670)]))
    rows = [(odd,), ("".join(c + "xY9" for c in odd),), ("".join(c + "é" for c in odd),), (" a  b c ",), ("",), (None,)]
    df = spark.createDataFrame(rows, "text string")
    plain = F.regexp_extract_all("text", F.lit(f"[^{tx.SPACE_CLASS}]+"), F.lit(0))
    lower = F.regexp_extract_all(F.lower("text"), F.lit(f"[{tx.WORD_CLASS}]{{2,}}"), F.lit(0))
    text = F.col("text")
    for row in df.select(tx.words(text), plain, tx.lower_words(text), lower, tx.word_count(text), F.when(text.isNotNull(), F.size(plain))).collect():
        assert row[0] == row[1] and row[2] == row[3] and row[4] == row[5]


def test_histogram_and_density_work_a_value_out_once(spark):
    from inkwell.operators import aggregates as agg

    values = [1, 1, 2, 5, 9, 9, 9, None, 3, 4]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    for run in (lambda d: agg.histogram_fixed_bins(d, "n", 4), lambda d: agg.kernel_density(d, "n", 5)):
        calls = spark.sparkContext.accumulator(0)

        def seen(v, calls=calls):
            calls.add(1)
            return v

        out = run(df.select(F.udf(seen, "int")("v").alias("n"))).collect()
        assert calls.value == len(values)
    x = np.array([v for v in values if v is not None], dtype=float)
    width = x.std(ddof=1) * len(x) ** -0.2
    for row in out:
        assert row["density"] == pytest.approx(np.exp(-(((row["x"] - x) / width) ** 2) / 2).sum() / (len(x) * width * np.sqrt(2 * np.pi)))
    bins = agg.histogram_fixed_bins(df, "v", 4).orderBy("bin").collect()
    assert [r["n"] for r in bins] == np.histogram(x, 4)[0].tolist()
