"""The vocabulary filter and the exact similarity search, on both of their paths."""

import random

import pytest
from pyspark.sql import functions as F

from inkwell.operators import features as fx
from inkwell.session import cut


@pytest.fixture(scope="module")
def grams(spark):
    rng = random.Random(4)
    rows = [(i, f"w{int(rng.paretovariate(0.7)) % 400}") for i in range(200) for _ in range(30)]
    return cut(spark.createDataFrame(rows, "id bigint, term string"))


def test_both_vocabulary_paths_agree(spark, grams):
    vocab = cut(spark.createDataFrame([(f"w{i}",) for i in range(0, 400, 3)], "term string"))
    key = lambda rows: sorted(map(tuple, rows))
    assert key(fx.vocab_restrict(grams, vocab, 0).collect()) == key(fx.vocab_restrict(grams, vocab).collect())
    assert key(fx.term_counts(grams, vocab=vocab, small_mb=0).collect()) == key(fx.term_counts(grams, vocab=vocab).collect())
    passed = fx.pass_filter(grams, vocab)
    assert passed.count() >= fx.vocab_restrict(grams, vocab).count()
    assert fx.vocab_restrict(grams, vocab.limit(0), 0).count() == 0
    assert fx.vocab_restrict(grams.limit(0), vocab, 0).count() == 0


def test_filter_is_bounded_and_lets_few_strangers_through(spark, monkeypatch):
    vocab = cut(spark.range(20_000).select(F.concat(F.lit("in"), "id").alias("term")))
    found, words = fx.vocab_filter(vocab)
    assert words == 4096 and found.count() <= words
    strangers = spark.range(20_000).select(F.col("id"), F.concat(F.lit("out"), "id").alias("term"))
    assert fx.pass_filter(strangers, vocab).count() < 0.1 * 20_000
    members = spark.range(20_000).select("id", F.concat(F.lit("in"), "id").alias("term"))
    assert fx.pass_filter(members, vocab).count() == 20_000
    monkeypatch.setattr(fx, "FILTER_WORDS", 64)
    assert fx.vocab_filter(vocab)[1] == 64
    assert fx.pass_filter(members, vocab).count() == 20_000


def test_large_path_filters_before_the_shuffle(spark, grams):
    vocab = cut(spark.createDataFrame([("w1",), ("w2",)], "term string"))
    plan = fx.term_counts(grams, vocab=vocab, small_mb=0)._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    semi = next(i for i, line in enumerate(lines) if "BroadcastHashJoin" in line and "_place" in line)
    first_exchange = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    assert first_exchange < semi  # the plan prints from the top, so the filter lies below every exchange of counts
    assert not any("Exchange hashpartitioning" in line for line in lines[semi : semi + 2])


def weights_of(spark, rows):
    counted = {}
    for i, term in rows:
        counted.setdefault(i, {}).setdefault(term, 0)
        counted[i][term] += 1
    flat = []
    for i, terms in counted.items():
        norm = sum(n * n for n in terms.values()) ** 0.5
        flat += [(i, t, n / norm) for t, n in terms.items()]
    return cut(spark.createDataFrame(flat, "id bigint, term string, weight double")), counted


def brute(queries, docs, ids, k):
    unit = lambda terms: {t: n / sum(m * m for m in terms.values()) ** 0.5 for t, n in terms.items()}
    sides = {i: unit(t) for i, t in docs.items()}
    out = []
    for q, terms in queries.items():
        mine = unit(terms)
        sims = {i: round(sum(w * sides.get(i, {}).get(t, 0.0) for t, w in mine.items()), 9) for i in ids}
        out += [(q, i, sims[i], r) for r, i in enumerate(sorted(ids, key=lambda i: (-sims[i], i))[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("k, block_bytes", [(1, 1 << 26), (5, 2_000), (60, 1 << 26)])
def test_search_against_brute_force(spark, k, block_bytes):
    rng = random.Random(k)
    word = lambda: f"w{int(rng.paretovariate(0.6)) % 60}"
    doc_rows = [(i, "common") for i in range(50)] + [(i, word()) for i in range(50) for _ in range(rng.randrange(1, 12))]
    doc_rows += [(60, "only"), (61, "only"), (62, "only")]
    query_rows = [(100 + q, "common") for q in range(8)] + [(100 + q, word()) for q in range(8) for _ in range(6)] + [(120, "only"), (121, "nowhere")]
    (docs, counted), (queries, asked) = weights_of(spark, doc_rows), weights_of(spark, query_rows)
    ids = [*range(50), 60, 61, 62, 70]  # 70 holds no term
    every = spark.createDataFrame([(i,) for i in ids], "id bigint")
    wanted = spark.createDataFrame([(q,) for q in asked] + [(130,)], "id bigint")
    got = fx.topk_cosine_join(wanted, queries, docs, every, k, block_bytes=block_bytes).collect()
    want = brute({**asked, 130: {}}, counted, ids, k)
    assert [(r["query_id"], r["id"], r["rank"]) for r in sorted(got, key=lambda r: (r["query_id"], r["rank"]))] == [(q, i, r) for q, i, _, r in sorted(want, key=lambda w: (w[0], w[3]))]
    assert all(abs(a["sim"] - b[2]) < 1e-8 for a, b in zip(sorted(got, key=lambda r: (r["query_id"], r["rank"])), sorted(want, key=lambda w: (w[0], w[3]))))


def test_all_pairs_by_shuffle(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(i, f"w{rng.randrange(12)}") for i in range(40) for _ in range(5)]
    docs, _ = weights_of(spark, rows)
    small = {(r["query_id"], r["id"]): r["sim"] for r in fx.cosine_scores(docs, docs).collect()}
    monkeypatch.setattr(fx, "is_small", lambda *a: False)
    monkeypatch.setattr(fx, "FREQUENT", 3)
    assert {(r["query_id"], r["id"]): r["sim"] for r in fx.cosine_scores(docs, docs).collect()} == small
