"""Graph search by recall, and sharding, against brute force."""

import numpy as np

from inkwell.llm import hnsw_search, sharding


def test_nearest_has_recall_and_exact_scores(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 24))
    vectors = centres[rng.integers(0, 20, 1500)] + 0.4 * rng.normal(size=(1500, 24))
    vectors[100:400] = vectors[100]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    odd = [(9001, None), (9002, []), (9003, [0.0] * 24), (9004, [float("nan")] * 24), (None, vectors[0].tolist()), (9050, [1.0, 2.0]), (9051, [2.0, 1.0])]
    df = spark.createDataFrame(rows + odd + rows[:3], "id long, v array<double>")
    out = hnsw_search.nearest(df, df.where("id % 50 = 0"), "id", "v", shard_vectors=400).toPandas()
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 1500, 50):
        scores = np.round(unit @ unit[q], 12)
        scores[q] = -9
        want = np.lexsort((np.arange(1500), -scores))[:5]
        own = out[out.query_id == q].sort_values("rank")
        assert list(own["rank"]) == [1, 2, 3, 4, 5]
        assert np.allclose(own.score, unit[own.vec_id] @ unit[q], atol=1e-12)
        hits += len(set(want) & set(own.vec_id))
        if 100 <= q < 400:
            assert list(own.vec_id) == list(want)
    assert hits >= 0.9 * 150
    assert list(out[out.query_id == 9050].vec_id) == [9051]
    assert hnsw_search.nearest(df.limit(0), df.limit(0), "id", "v").count() == 0


def test_shards_are_even_and_slots_gapless(spark, frame):
    rng = np.random.default_rng(4)
    rows = [(i, "x" * int(rng.integers(0, 200))) for i in range(3000)] + [(3000 + i, "copy of one text " * 5) for i in range(1500)]
    rows += [(None, None), (1, "x"), (1, "x")]
    docs = frame([(i, t, 9) for i, t in rows], "doc_id long, text string, slot int")
    out = sharding.shard_by_bytes(docs, "doc_id", "text", 24, range_rows=50).toPandas()
    assert len(out) == len(rows) and (out["size"] == [len(t or "") + 8 for t in out.text.where(out.text.notna(), "")]).all()
    sizes = out.groupby("shard")["size"].sum()
    assert len(sizes) == 24 and sizes.max() - sizes.min() <= 2 * out["size"].max()
    for _, own in out.groupby("shard"):
        assert sorted(own.slot) == list(range(len(own)))
    assert sharding.shard_by_bytes(docs.limit(0), "doc_id", "text").count() == 0
    one = sharding.shard_by_bytes(frame([(1, "a")] * 30), "doc_id", "text").toPandas()
    assert len(one) == 30
