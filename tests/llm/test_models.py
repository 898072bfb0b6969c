"""Toxicity and quality by accuracy on rows that were not learned from, and their label model."""

import random
import zlib

import numpy as np
import pytest

from inkwell.llm import quality, toxicity


def texts(n=900, seed=11):
    """Plain, toxic and junk texts of invented words, with labels for most."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(("ta", "ri", "mo", "ne", "lu", "ka", "so")) for _ in range(rng.randrange(1, 4)))
    rows = []
    for i in range(n):
        words = [word() for _ in range(rng.randrange(20, 120))]
        toxic, good = int(rng.random() < 0.2), int(rng.random() < 0.8)
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(("idiot", "moron", "scum", "grobian" + word())))
        if not good:
            words = [w.upper() + "!!" for w in words] if i % 2 else words[:5] * 12
        rows.append((i, " ".join(words), "en", f"src{i % 7}", toxic if i % 10 else None, good if i % 10 else None))
    return rows + [(n, None, None, None, None, None), (None, "idiot moron", "en", "src1", None, None), (n + 1, "", "en", None, 0, 1), (5, rows[5][1], "en", "src5", None, None)]


@pytest.fixture(scope="module")
def tables(spark):
    rows = texts()
    docs = spark.createDataFrame([r[:4] + ("x",) for r in rows], "doc_id long, text string, lang string, source string, score string")
    labels = spark.createDataFrame([(r[0], r[5], r[4]) for r in rows if r[0] is not None], "doc_id long, quality int, toxic int")
    return rows, docs, labels


def held(rows):
    return {r[0]: r for r in rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 1 and r[4] is not None}


def test_toxicity_on_held_out_rows(tables):
    rows, docs, labels = tables
    model = toxicity.fit_toxicity(docs, labels)
    out = toxicity.score_toxicity(docs, model).toPandas()
    assert len(out) == len(rows) and out.score.between(0, 1).all() and not out[out.doc_id.isna()].held_out.any()
    known = held(rows)
    own = out[out.held_out & out.doc_id.isin(known)]
    truth = np.array([known[i][4] for i in own.doc_id])
    assert (own.predicted.to_numpy() == truth).mean() > 0.95
    assert out[out.text.isna()].predicted.tolist() == [0]
    assert toxicity.score_toxicity(docs.limit(0), model).count() == 0


def test_label_model_finds_accuracies_and_correlation():
    rng = np.random.default_rng(3)
    truth = rng.random(20_000) < 0.1
    votes = np.array([(rng.random(20_000) < np.where(truth, hit, miss)) for hit, miss in ((0.9, 0.01), (0.6, 0.02), (0.5, 0.0))]).T.astype(float)
    votes = np.column_stack([votes, votes[:, 1]])  # a voter that repeats another
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    known = np.array([(~truth[:2000]).sum(), truth[:2000].sum()], dtype=float), np.column_stack([votes[:2000][~truth[:2000]].sum(0), votes[:2000][truth[:2000]].sum(0)])
    model = toxicity.fit_label_model(patterns, counts.astype(float), known)
    assert abs(model.hit[0, 1] - 0.9) < 0.05 and abs(model.hit[2, 1] - 0.5) < 0.05
    assert model.damping[1] < 0.75 and model.damping[0] > model.damping[1]
    assert ((model.posterior(votes) >= 0.5) == truth).mean() > 0.97


def test_toxicity_without_labels(spark, tables):
    _, docs, labels = tables
    out = toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, labels.limit(0)))
    assert out.where("score is null").count() == 0


def test_quality_on_held_out_rows(tables):
    rows, docs, labels = tables
    model = quality.fit_quality(docs, labels)
    out = quality.score_quality(docs, model).toPandas()
    assert len(out) == len(rows) and out.score.between(0, 1).all()
    known = held(rows)
    own = out[out.doc_id.isin(known)]
    assert (own.predicted.to_numpy() == np.array([known[i][5] for i in own.doc_id])).mean() > 0.97
    assert quality.score_quality(docs.limit(0), model).count() == 0
    plain = quality.score_quality(docs.select("doc_id", "text"), quality.fit_quality(docs.select("doc_id", "text"), labels.limit(0)))
    assert plain.where("score is null").count() == 0


def test_content_reads_a_long_word_to_its_end():
    view = lambda text: [x.tolist() for x in quality.Shapes().content(text.split())]
    start = "ab" * 32
    assert view(start + "x" * 300) != view(start + "X9-" * 100)
    assert view(start + "x" * 300 + "!") != view(start + "x" * 300)
    assert view("one " + start + "9") == view("one " + start + " 9")
    assert view("") == [[], []]


@pytest.mark.parametrize("bits", [toxicity.BITS, toxicity.SIGN_BITS])
def test_places_are_those_of_every_sign(bits):
    batch = ["Idiot idiots! you IDIOT", "", "a ab abc abcd abcde abcdef abcdefg", "you are a moron ??", "the moron left us all to you", "\u00c9t\u00e9 E\u0301te\u0301 x_9y"]
    want = set()
    for i, text in enumerate(batch):
        for word in toxicity.word_list(text):
            signs = ["=" + word, *("<" + word[:n] for n in toxicity.PREFIXES if len(word) >= n)]
            want |= {(i, zlib.crc32(sign.encode()) % (1 << bits)) for sign in signs}
    group = np.array([zlib.crc32(b"<abcd") % (1 << toxicity.SIGN_BITS)])
    reader = toxicity.Reader(group)
    for _ in range(2):
        rows, words, votes = reader.read(batch)
        at, place = reader.places(rows, words, bits)
        assert len(at) == len(want) and set(zip(at.tolist(), place.tolist())) == want
        assert votes[:, :4].tolist() == [[1, 1, 1, 0], [0, 0, 0, 0], [0, 0, 0, 0], [1, 0, 1, 1], [1, 0, 0, 0], [0, 0, 0, 0]]
        assert votes[:, 4:].sum(axis=1).tolist() == [0, 0, 1, 0, 0, 0] and votes[2, 4 + group[0] % toxicity.GROUPS] == 1
        assert (toxicity.votes_of(toxicity.pattern_of(votes)) == votes).all()
        reader.forget()


def test_repeated_rows_of_an_id_teach_once(spark, tables):
    rows, docs, labels = tables
    one = docs.where("doc_id = 7")
    many = docs.union(one.crossJoin(spark.range(60)).drop("id"))
    for fit, score in ((toxicity.fit_toxicity, toxicity.score_toxicity), (quality.fit_quality, quality.score_quality)):
        plain = {r["doc_id"]: r["score"] for r in score(docs, fit(docs, labels)).collect()}
        out = score(many, fit(many, labels)).collect()
        assert len(out) == len(rows) + 60
        assert len({r["score"] for r in out if r["doc_id"] == 7}) == 1
        assert sum(abs(plain[r["doc_id"]] - r["score"]) for r in out) / len(out) < 0.02


def test_sparse_rows_are_dense_rows():
    rng = np.random.default_rng(5)
    dense = np.where(rng.random((60, 20)) < 0.2, rng.random((60, 20)), 0.0)
    y = (dense[:, 3] + dense[:, 5] > 0.3).astype(float)
    rows = [(np.flatnonzero(r), r[np.flatnonzero(r)]) for r in dense]
    sparse, view, other = quality.Sparse.of(rows, 20), quality.View(20), quality.View(20)
    view.fit(sparse, y)
    other.fit(dense, y)
    assert np.allclose(view.odds(sparse), other.odds(dense)) and np.allclose(view.odds(sparse[np.array([4, 2, 59])]), other.odds(dense)[[4, 2, 59]])
