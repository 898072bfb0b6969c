"""The corpus pipeline: every stage's result against plain versions of it on its own input."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from inkwell.llm.common import written


def documents():
    """Made-up texts; some toxic, some junk, some near copies, some sharing a passage; ids without text."""
    rng = random.Random(23)
    word = lambda: "".join(rng.choice(("ta", "ri", "mo", "ne", "lu", "ka", "so")) for _ in range(rng.randrange(1, 5)))
    passage, rows = [word() for _ in range(60)], []
    for i in range(500):
        words = [word() for _ in range(rng.randrange(40, 120))]
        kind = i % 10
        if kind == 1:
            words[5:5] = ["idiot", "you", "moron"]
        elif kind == 2:
            words = [w.upper() + "!!" for w in words]
        elif kind == 3 and rows:
            words = rows[-3][1].split() + ["end"]  # a near copy of a plain text
        elif kind == 4:
            words[20:20] = passage
        text = " ".join(words)
        rows.append((i, text, "en", f"src{i % 7}", len(text), "s"))
    return rows + [(500, None, None, None, None, None), (501, "", "en", "src1", 0, "s")]


def labels_of(rows):
    return [(i, int(i % 10 != 2), int(i % 10 == 1)) for i, *_ in rows if i < 500]

WORD = re.compile("[^\\x20\\x09-\\x0D]+")


def sets(text):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def test_stages(spark, tmp_path):
    rows = documents()
    schema = "doc_id long, text string, lang string, source string, n_chars long, spans string"
    folder = str(tmp_path)
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels_of(rows), "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs = corpus_pipeline.table(spark, folder, "documents")
    kept = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, folder), "stage-" + name.replace(" ", "-"))
        assert docs.columns == [c.strip().split()[0] for c in schema.split(",")]
        kept.append(docs.collect())
    first, calm, good, single, cut = kept
    truth = {r[0]: r for r in labels_of(rows)}
    gone = {r["doc_id"] for r in first} - {r["doc_id"] for r in calm}
    assert gone and sum(truth[i][2] == 1 for i in gone) >= 0.9 * len(gone)
    assert sum(r["doc_id"] in truth and truth[r["doc_id"]][2] == 1 for r in calm) <= 0.1 * len(gone)
    gone = {r["doc_id"] for r in calm} - {r["doc_id"] for r in good}
    assert gone and sum(truth[i][1] == 0 for i in gone) >= 0.9 * len(gone)
    # one of each group of linked texts, by brute force
    group = {r["doc_id"]: r["doc_id"] for r in good}
    found = [(r["doc_id"], sets(r["text"])) for r in good]
    for i, (a, x) in enumerate(found):
        for b, y in found[:i]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                low, high = sorted((group[a], group[b]))
                group = {k: low if v == high else v for k, v in group.items()}
    assert sorted(r["doc_id"] for r in single) == sorted(set(group.values()))
    assert len(single) < len(good)
    # words of windows that start elsewhere, by brute force
    words = {r["doc_id"]: WORD.findall(r["text"] or "") for r in single}
    counts = Counter(tuple(w[i : i + 35]) for w in words.values() for i in range(len(w) - 34))
    texts = {r["doc_id"]: r for r in cut}
    assert sorted(texts) == sorted(words)
    changed = 0
    for key, w in words.items():
        out = [False] * len(w)
        for i in range(len(w) - 34):
            if counts[tuple(w[i : i + 35])] > 1:
                out[i : i + 35] = [True] * 35
        assert WORD.findall(texts[key]["text"] or "") == [x for x, g in zip(w, out) if not g]
        changed += any(out)
        if any(out):
            assert texts[key]["n_chars"] == len(texts[key]["text"])
    assert changed
    packed = corpus_pipeline.run(spark, folder)
    again = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    keys = ["doc_id", "piece", "length", "ids_crc32"]
    assert sorted(map(tuple, packed.select(*keys).collect())) == sorted(map(tuple, again.select(*keys).collect()))
    sums = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).collect()
    assert all(r["n"] == r["end"] <= 1024 for r in sums)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == set(texts)
